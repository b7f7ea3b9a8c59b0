"""Secret scan: a wide pattern finds candidates, a random forest removes the false ones.

Every candidate is described by its length, its character transitions, how much of it is
dictionary words, and by the words and the path around it. The forest is trained by
Spark ML on labelled findings and written out as SQL, so a scan is one projection over
the documents: no join, no shuffle, no Python.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A run of 12 or more key characters with a digit, what a key word assigns, or the password in a URL. Each
#: alternative starts at an edge, so long runs are walked once.
CANDIDATE = r"""(?<![A-Za-z0-9+/_~.-])(?=[A-Za-z+/_~.-]*[0-9])([A-Za-z0-9+/_~.-]{12,}={0,2})|(?i:(?<![a-z])(?:password|passwd|pwd|secret|token|api_?key)["']?[:=]["']?)([^\s"']{8,})|://[^\s/@:"']{0,64}:([^\s/@:"']{4,})(?=@)"""
KEY_WORDS = r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private)"
#: A key word and its = or : or "is", or a command's option of that name, at the end of what stands before a word.
ASSIGNS = KEY_WORDS + r"""(?:[_-]?keys?|s)?(?:["'`)\]]{0,3}(?:\s*[:=]{1,3}>?|\s+is:?)|(?<=(?:\A|\s)--?[\w-]{1,40})\s)\s*\z"""
#: What tokens of well-known services start with (fixed values).
ISSUED = r"\A(?:AKIA|ASIA|AIza|gh[oprsu]_|github_pat_|glpat-|sk[-_]|xox[abprs]-|npm_|hf_|SG\.|eyJ)"
#: A URL up to the password in it.
URL_USER = r"""://[^\s/@:"']*:\z"""
#: What such a word is given: up to its closing quote, or without the marks that close a clause.
ASSIGNED = r"""\A[:=]{0,3}>?(?:"([^\s"]{8,})|'([^\s']{8,})|([^\s"']\S{7,}?)["',;.)}\]]{0,3}\z)"""
PLAIN_WORDS = r"(?i)(?:commit|sha\d*|md5|checksum|digest|hash|etag|uuid|guid|version|revision|build|order|invoice|isbn|phone|card|mail|file|path|see|page|module)"
TEST_PATHS = r"(?i)(?:test|example|sample|fixture|mock|demo|doc)"
#: English letter pairs that words hold and random keys rarely do (fixed values).
PAIRS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|le|me|co|io|ra|om|ma|ro|li|ic|ne"
#: Words whose share of a candidate is measured (fixed values).
DICTIONARY = "example|sample|test|your|token|secret|password|key|user|name|file|data|index|module|src|main|page|image|version|release|mail|info|http|www|com|org|net|html|json|section|chapter|value|string|change|placeholder|dummy|insert|here|get|set|list|item|report|model|service|config|default"

FEATURES = ("length", "transitions", "digits", "pairs", "dictionary", "variety", "separators", "hex", "filler", "assigned", "key_before", "plain_before", "plain_after", "test_path", "upper", "issued", "url_user")
TREES, DEPTH = 15, 8


def features(value: Column, before: Column, after: Column, path: Column) -> list[Column]:
    """The numbers of one candidate, in the order of FEATURES."""
    n = F.greatest(F.length(value), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / n

    def flag(of: Column, pattern: str) -> Column:
        return of.rlike(pattern).cast("double")

    return [
        F.least(n, F.lit(200.0)),
        share("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]|(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"),
        share("[0-9]"),
        F.regexp_count(F.lower(value), F.lit(f"(?={PAIRS})")) / n,
        1 - F.length(F.regexp_replace(F.lower(value), DICTIONARY, "")) / n,
        F.size(F.array_distinct(F.split(value, ""))) / F.least(n, F.lit(32.0)),
        share("[-_./~]"),
        flag(value, r"\A(?:[0-9a-f]+|[0-9A-F]+)\z"),
        flag(value, r"(.)\1{4}|1234|abcd|(?i:x{4}|example|your|changeme|placeholder|dummy)"),
        flag(before, r"""[=:]\s*["']?\z"""),
        flag(before, KEY_WORDS),
        flag(before, PLAIN_WORDS),
        flag(after, PLAIN_WORDS),
        flag(path, TEST_PATHS),
        share("[A-Z]"),
        flag(value, ISSUED),
        flag(before, URL_USER),
    ]


def labelled_findings(spark: SparkSession, rows: int = 8_000, seed: int = 0) -> DataFrame:
    """(value, before, after, path, label): findings as reviewers label them, made from a rule for each kind.

    Half are secrets (keys and passwords after their key word or option, tokens of known services anywhere,
    passwords in URLs), half what such patterns hit by mistake: digests, identifiers, paths, hosts, ports,
    addresses, dates, numbers, placeholders, names that start like tokens and plain words after a key word.
    """
    i = F.col("id")

    def pick(salt: int, many: int) -> Column:
        return F.pmod(F.xxhash64(i, F.lit(seed), F.lit(salt)), F.lit(many)).cast("int")

    def one(salt: int, *values: str) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), pick(salt, len(values)) + 1)

    digest = F.sha2(F.concat_ws("-", i.cast("string"), F.lit(seed).cast("string")), 512)
    hexes, mixed = F.col("hexes"), F.col("mixed")
    word = F.concat(one(1, "user", "report", "order", "page", "main", "data", "image", "thing", "parse", "northern", "reading"), one(2, "_", "-", ".", ""), one(3, "name", "index", "value", "section", "handler", "station", "there", "model"))
    number = pick(4, 100_000).cast("string")
    plain = one(5, "the", "and that", "on of", "in der", "la que", "see", "was here")
    keyed = F.concat(plain, F.lit(" "), one(6, "password", "token", "secret", "api_key", "API_KEY", "auth_token", "passwd", "access_key", "private_key"), one(7, "=", " = ", ": ", ' = "', '="', ": '", " is ", " "))
    letters = F.substring(F.translate(hexes, "0123456789abcdef", "qzxvwkjtyplmucbg"), F.lit(1), pick(15, 17) + 8)
    chosen = F.concat(one(16, "dragon", "sunshine", "hunter", "Summer", "monkey", "Kestrel", "tr0mbone", "Velvet"), (pick(17, 9_900) + 100).cast("string"), one(18, "", "!", "#x", "$Q"))
    prose = one(19, "required", "available", "something", "incorrect", "different", "somewhere", "disabled", "property", "everything", "northern", "understanding", "forgotten", "necessary", "completely", "stored", "unknown").alias("value")
    held = [F.substring(hexes, 1, 18), F.substring(hexes, 1, 32), F.substring(hexes, 1, 40), F.substring(hexes, 1, 64), F.substring(mixed, 1, 16), F.substring(mixed, 1, 24), F.substring(mixed, 1, 40), letters, chosen, F.substring(F.translate(hexes, "abcdef", "123456"), 1, 8)]
    issued = [
        F.concat(one(20, "AKIA", "ASIA"), F.upper(F.substring(mixed, 1, 16))),
        F.concat(one(20, "ghp_", "gho_", "ghs_", "npm_", "hf_"), F.substring(mixed, 1, 36)),
        F.concat(one(20, "sk-", "sk-proj-", "sk_live_", "glpat-", "AIza"), F.substring(mixed, 1, pick(21, 29) + 20)),
        F.concat(one(20, "xoxb-", "xoxp-"), F.translate(F.substring(hexes, 1, 12), "abcdef", "123456"), F.lit("-"), F.substring(mixed, 1, 24)),
        F.concat(F.lit("eyJ"), F.substring(mixed, 1, 33), F.lit("."), F.substring(mixed, 34, 40), F.lit("."), F.substring(mixed, 5, 43)),
    ]
    url_user = F.concat(plain, F.lit(" "), one(22, "postgres", "mysql", "amqp", "redis", "https", "ftp", "mongodb"), F.lit("://"), one(23, "admin", "root", "", "app", "svc_user", "reader"), F.lit(":"))
    beside = F.concat(plain, one(24, "", " token", " key:", " header Bearer", " with", " use", ' "', " url ="))
    real = F.array(
        *[F.struct(v.alias("value"), keyed.alias("before")) for v in [*held, *issued]],
        *[F.struct(v.alias("value"), beside.alias("before")) for v in [*issued, *issued]],
        *[F.struct(v.alias("value"), url_user.alias("before")) for v in (chosen, letters, F.substring(mixed, 1, pick(25, 20) + 8))],
    )
    false = F.array(
        F.struct(F.substring(hexes, 1, 40).alias("value"), F.concat(plain, F.lit(" "), one(9, "commit", "revision", "sha1", "see commit", "etag:")).alias("before")),
        F.struct(F.substring(hexes, 1, 64).alias("value"), F.concat(plain, F.lit(" "), one(9, "sha256:", "checksum", "digest =", "file hash:")).alias("before")),
        F.struct(F.substring(hexes, 1, 32).alias("value"), F.concat(plain, F.lit(" "), one(9, "md5", "etag", "build", "checksum =")).alias("before")),
        F.struct(F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4), F.substring(hexes, 13, 4), F.substring(hexes, 17, 4), F.substring(hexes, 21, 12)).alias("value"), F.concat(plain, F.lit(" "), one(9, "uuid", "id", "guid:", "order")).alias("before")),
        F.struct(F.concat(word, F.lit("_"), word, number).alias("value"), plain.alias("before")),
        F.struct(F.concat(F.lit("src/"), word, F.lit("/"), word, number, one(9, ".py", ".html", ".txt")).alias("value"), plain.alias("before")),
        F.struct(F.concat(one(9, "mail", "www", "host"), number, one(10, ".example.com", ".example.org", ".sample.net")).alias("value"), F.concat(plain, F.lit(" "), word, number, F.lit("@")).alias("before")),
        F.struct(F.concat(F.lit("20"), F.lpad(pick(9, 30).cast("string"), 2, "0"), F.lit("-11-"), F.lpad(pick(10, 28).cast("string"), 2, "0"), F.lit("T10")).alias("value"), plain.alias("before")),
        F.struct(F.translate(F.substring(hexes, 1, 16), "abcdef", "123456").alias("value"), F.concat(plain, one(9, "", " card", " phone", " invoice")).alias("before")),
        F.struct(one(9, "xxxxxxxxxxxxxxxx1", "your-api-key-1234", "changeme12345", "EXAMPLEKEY0000000", "insert_token_here_1", "example-secret-123", "<your-password-1>", "dummy0000000000", "test-token-12345678", "abcdefghijklmnop", "abcdefgh12345678", "qrstuvwxyzabcdefgh").alias("value"), keyed.alias("before")),
        F.struct(F.concat(word, F.lit("-"), word, F.lit("-"), word).alias("value"), keyed.alias("before")),
        F.struct(F.concat(word, word, number).alias("value"), plain.alias("before")),
        F.struct(prose, keyed.alias("before")),
        F.struct(F.concat(one(20, "sk-", "sk_", "npm_", "hf_", "ghs_", "sk-"), word, one(9, "-", "_", "."), word, one(10, "", "-1.", "_v", "-")).alias("value"), beside.alias("before")),
        F.struct(F.concat(one(20, "ghp_", "sk-", "AKIA", "npm_", "xoxb-"), one(9, "xxxxxxxxxxxxxxxxxxx1", "your-token-here-1", "EXAMPLE0EXAMPLE0", "00000000000000000000", "placeholder-12345")).alias("value"), beside.alias("before")),
        F.struct(F.substring(F.translate(hexes, "abcdef", "123456"), F.lit(1), pick(21, 9) + 12).alias("value"), F.concat(plain, one(24, "", ".", ",", " a", " card", " 12")).alias("before")),
        F.struct(F.substring(F.translate(hexes, "abcdef", "123456"), F.lit(1), F.lit(16)).alias("value"), F.concat(plain, one(24, "", ".", ",", " est", " in", " la")).alias("before")),
        F.struct(F.concat_ws(".", *[(pick(k, 245) + 10).cast("string") for k in (26, 27, 28, 29)]).alias("value"), beside.alias("before")),
        F.struct(F.concat((pick(9, 9_000) + 1_000).cast("string"), F.lit("/"), word, F.lit("/"), word, number).alias("value"), F.concat(plain, one(10, " http://", " https://", " ws://"), word, F.lit(":")).alias("before")),
    )
    base = spark.range(rows).withColumn("hexes", digest).withColumn("mixed", F.translate(F.base64(F.unhex("hexes")), "+/=", "kQ7")).withColumn("label", (pick(11, 2) == 0).cast("double"))
    # One table a label: each gets compiled code of its own.
    right, wrong = F.element_at(real, pick(8, 28) + 1), F.element_at(false, pick(12, 19) + 1)
    path = one(13, "src/app/settings.py", "web/page.html", "src0", "src7", "config/prod.yml", "notes.txt", "tests/fixtures/a.json", "docs/sample.md")
    after = one(14, "", "and the", '" that', "of in", "est la", "pages")
    # A placeholder or digest may lie anywhere; a live key in a test folder is rare.
    live = F.when(path.rlike(TEST_PATHS), F.lit("src3")).otherwise(path)
    made = [
        base.filter(f"label = {label}").select("label", kind.alias("kind"), after.alias("after"), where.alias("path")).select("kind.value", "kind.before", "after", "path", "label")
        for label, kind, where in ((1, right, live), (0, wrong, path))
    ]
    return made[0].unionByName(made[1])


def _tree_sql(lines: list[str]) -> str:
    """One tree of Spark ML's printed forest as a CASE over ``x.f``; consumes its lines."""
    line = lines.pop(0).strip()
    if line.startswith("Predict"):
        return line.split(":")[1].strip() + "D"
    number, cut = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = _tree_sql(lines)
    lines.pop(0)
    return f"CASE WHEN x.f[{number}] <= {float(cut)!r}D THEN {low} ELSE {_tree_sql(lines)} END"


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> str:
    """A forest trained on labelled findings, as the SQL of its share of votes for "secret" over an array ``x.f``."""
    x = findings.coalesce(1).select("label", *[c.alias(n) for c, n in zip(features(F.col("value"), F.col("before"), F.col("after"), F.col("path")), FEATURES, strict=True)])
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(x).select("features", "label")
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(assembled)
    printed = model.toDebugString.split("\n")[1:]
    starts = [k for k, line in enumerate(printed) if line.strip().startswith("Tree ")]
    votes = [_tree_sql([line for line in printed[a + 1 : b] if line.strip()]) for a, b in zip(starts, [*starts[1:], len(printed)], strict=True)]
    return f"({' + '.join(votes)}) / {len(votes)}D"


def scan(docs: DataFrame, text: str, path: str | None, forest: str, least: float = 0.5, out: str = "findings") -> DataFrame:
    """The documents with ``out``: array of (word, value, before, after, score, secret), in order.

    ``word`` counts the text's words from 0; ``before`` holds the two words before and what precedes the
    candidate in its own; ``secret`` is score >= ``least``. Null and empty texts have an empty array; a null
    path is empty; candidates that repeat are listed each time. A column already named ``out`` gives way.
    """
    passed = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    where = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")) if path else F.lit("")
    # Only texts with a candidate are taken apart.
    words = F.when(body.rlike(CANDIDATE) | body.rlike(ASSIGNS.removesuffix(r"\z")), F.split(body, r"\s+")).otherwise(F.array().cast("array<string>"))
    split = docs.select(*passed, words.alias("__words"), where.alias("__path"))
    w = F.col("__words")

    def word(at: Column) -> Column:
        return F.when(at >= 0, F.coalesce(F.get(w, at), F.lit(""))).otherwise(F.lit(""))

    def assigned(p: Column) -> Column:
        """Whether the one or two words before, or they and the word's own : or =, assign to a key word."""
        own = F.regexp_extract(p["s"], r"\A[:=]{0,3}>?", 0)
        return (F.length(p["s"]) >= 8) & p["s"].rlike(ASSIGNED) & F.concat_ws(" ", p["a"], p["b"], own).rlike(ASSIGNS)

    def given(p: Column) -> Column:
        """The word's assigned value, unless the pattern has the same."""
        value = F.concat(*[F.regexp_extract(p["s"], ASSIGNED, g) for g in (1, 2, 3)])
        return F.when(p["given"], F.array(value)).otherwise(F.array().cast("array<string>"))

    def found(p: Column) -> Column:
        held = F.concat(*[F.regexp_extract_all(p["s"], F.lit(CANDIDATE), F.lit(g)) for g in (1, 2, 3)])
        return F.concat(held, F.filter(given(p), lambda v: ~F.array_contains(held, v)))

    # Each word beside the two before it by shifted copies: looking them up would take the text apart again for
    # every word where Spark puts the split in the place of its name.
    none = F.lit("")
    two = F.zip_with(F.concat(F.array(none, none), w), F.concat(F.array(none), w), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    beside = F.zip_with(w, two, lambda s, ab: F.struct(s.alias("s"), ab["a"].alias("a"), ab["b"].alias("b")))
    marked = F.transform(beside, lambda p, i: F.struct(i.alias("i"), p["s"].alias("s"), F.coalesce(assigned(p), F.lit(False)).alias("given")))
    hits = F.filter(marked, lambda p: p["given"] | p["s"].rlike(CANDIDATE))
    values = F.flatten(
        F.transform(
            hits,
            lambda p: F.transform(
                F.filter(found(p), lambda v: v != ""),
                lambda v: F.struct(
                    p["i"].alias("word"),
                    v.alias("value"),
                    F.concat_ws(" ", word(p["i"] - 2), word(p["i"] - 1), F.substring(p["s"], F.lit(1), F.position(v, p["s"]) - 1)).alias("before"),
                    word(p["i"] + 1).alias("after"),
                ),
            ),
        )
    )
    described = split.withColumn("__hits", values)
    measured = described.withColumn("__hits", F.transform("__hits", lambda x: F.struct(x["word"].alias("word"), x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after"), F.array(*features(x["value"], x["before"], x["after"], F.col("__path"))).alias("f"))))
    scored = measured.withColumn("__hits", F.expr(f"transform(__hits, x -> named_struct('word', x.word, 'value', x.value, 'before', x.before, 'after', x.after, 'score', {forest}))"))
    final = F.transform("__hits", lambda x: F.struct(x["word"].alias("word"), x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after"), x["score"].alias("score"), (x["score"] >= least).alias("secret")))
    return scored.withColumn(out, final).drop("__words", "__path", "__hits")


def redact(docs: DataFrame, text: str, path: str | None, forest: str, least: float = 0.5, mark: str = "[SECRET]") -> DataFrame:
    """The documents, same columns, with every secret that ``scan`` reports replaced by ``mark`` wherever it stands."""
    fresh = "__findings"
    while fresh in docs.columns:
        fresh += "_"
    scanned = scan(docs, text, path, forest, least, fresh)
    # Longest first: a secret may hold another one.
    secrets = F.array_distinct(F.transform(F.filter(fresh, lambda x: x["secret"]), lambda x: F.struct((-F.length(x["value"])).alias("n"), x["value"].alias("value"))))
    clean = F.aggregate(F.array_sort(secrets), F.col(f"`{text}`"), lambda acc, s: F.replace(acc, s["value"], F.lit(mark)))
    return scanned.withColumn(text, F.when(F.size(secrets) > 0, clean).otherwise(F.col(f"`{text}`"))).select(*[f"`{c}`" for c in docs.columns])
