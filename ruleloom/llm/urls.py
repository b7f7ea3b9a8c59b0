"""URL filter: host-suffix and path-prefix expressions against hashed rules.

A rule is a host, a path prefix and an action. A URL is expanded into every
(host suffix, path prefix) pair that a rule could have; pairs and rules meet in
an equi-join on the first hex digits of a SHA-256, the whole digest confirms, and
the longest rule decides. Hosts hold no ``/`` and paths start with one, so the
text host + path names a pair without doubt.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleloom.llm.rows import named

#: Hex digits of the digest that the join compares.
PREFIX_DIGITS = 8
#: Rules are broadcast up to so many; beyond that the join shuffles.
BROADCAST_RULES = 100_000
#: A URL with more than one row in so many is frequent; there are fewer of them than this, whatever the table.
FREQUENT = 2_000


def after_scheme(url: Column) -> Column:
    """The part after the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."))) + 1


def frequent_urls(kept: DataFrame) -> DataFrame:
    """(h, salts): the hashes of frequent URLs and the number of pieces to deal their rows over."""
    spark, rows = kept.sparkSession, kept.count()
    top = kept.groupBy(F.xxhash64("url").alias("h")).count().orderBy(F.desc("count")).limit(FREQUENT).collect()
    return spark.createDataFrame([(r["h"], -(-r["count"] * FREQUENT // rows)) for r in top if r["count"] * FREQUENT > rows], "h long, salts int")


def judge_urls(pages: DataFrame, url: str, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The input's columns and host, path, rule, verdict for every row.

    ``rules`` has host, path and action (allow or block); rows with a null host or
    action are no rules, a null path is empty. The rule with the longest host + path
    wins, among equally long ones a block, then the smaller text. Without a rule the
    verdict is ``default``. A null URL and one without ``://`` has an empty host and path
    and fits no rule. Input columns named like a result column give way to it. Equal
    URLs are judged once, the rows of frequent ones dealt over pieces; an empty table gives
    an empty result.
    """
    names = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    # The input's columns are numbered, so that none can clash with one of the joins.
    kept = pages.select(*[named(c).alias(f"c{i}") for i, c in enumerate(names)], F.coalesce(named(url).cast("string"), F.lit("")).alias("url"))
    rules = rules.filter(F.col("host").isNotNull() & F.col("action").isNotNull()).select(F.col("host"), F.coalesce("path", F.lit("")).alias("path"), "action")
    whole = F.concat("host", "path")
    keyed = rules.select(
        whole.alias("rule"),
        (F.col("action") == "block").alias("blocks"),
        F.sha2(whole, 256).alias("rule_digest"),
        F.substring(F.sha2(whole, 256), 1, PREFIX_DIGITS).alias("rule_prefix"),
    )
    # One number per path length that a rule has: bounded by the longest path, not by the rules.
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    # One number per count of labels that a rule's host has: bounded by the longest host.
    sizes = sorted(r[0] for r in rules.select(_labels(F.col("host"))).distinct().collect())
    if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        keyed = F.broadcast(keyed)

    rest = after_scheme(F.col("url"))
    urls = kept.select("url").distinct().select("url", host_of(rest).alias("host"), path_of(rest).alias("path"))
    suffixes = F.filter(
        F.array(*[F.when(_labels(F.col("host")) >= n, F.substring_index("host", ".", -n)) for n in sizes]) if sizes else F.array().cast("array<string>"),
        lambda s: s.isNotNull(),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring(F.col("path"), 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>"),
        lambda p: p.isNotNull(),
    )
    said = (
        urls.select("url", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("url", "suffix", F.explode("prefixes").alias("prefix"))
        .select("url", F.sha2(F.concat("suffix", "prefix"), 256).alias("digest"))
        .join(keyed, (F.substring("digest", 1, PREFIX_DIGITS) == F.col("rule_prefix")) & (F.col("digest") == F.col("rule_digest")))
        .groupBy("url")
        .agg(F.min(F.struct((-F.length("rule")).alias("n"), (~F.col("blocks")).alias("allows"), F.col("rule"))).alias("best"))
    )
    frequent = F.broadcast(frequent_urls(kept))
    salts = F.coalesce("salts", F.lit(1))
    # Rows of a frequent URL are dealt by their other columns and the task that reads them.
    hashable = [f.name for f in kept.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    piece = F.pmod(F.xxhash64(*hashable, F.spark_partition_id()), salts).cast("int")
    h = F.xxhash64("url") == F.col("h")
    dealt = kept.join(frequent, h, "left").withColumn("piece", piece).drop("h", "salts")
    said = said.join(frequent, h, "left").select("url", "best", F.explode(F.sequence(F.lit(0), salts - 1)).alias("piece"))
    found = dealt.join(said, ["url", "piece"], "left")
    rest = after_scheme(F.col("url"))
    verdict = F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.allows"), "allow").otherwise("block")
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    return found.select(*own, host_of(rest).alias("host"), path_of(rest).alias("path"), F.col("best.rule").alias("rule"), verdict.alias("verdict"))
