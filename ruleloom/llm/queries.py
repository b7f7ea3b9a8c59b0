"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleloom.llm import audit, chat, decontam, jaccard, merkle, neighbours, packing, quality, secret_scan, sharding, toxicity, urls, vafile
from ruleloom.llm.labels import crc_of

#: The rules that the URL query judges by: host, path, action (fixed values).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_leaks(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = secret_scan.train(secret_scan.labelled_findings(spark))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secret_scan.scan(docs, "text", "source", forest).select("doc_id", F.explode("findings").alias("x"))
    return found.select("doc_id", F.col("x.word").cast("long").alias("word"), F.sha2("x.value", 256).alias("value_sha256"), "x.score", "x.secret")


def op4_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_records(docs, "doc_id", "text", [1.0] * SHARDS).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").withColumnRenamed("conversation", "conv_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_of("doc_id") % 3 == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), "url", rules).select("page_id", "host", "path", "rule", "verdict")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_of("doc_id") % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_classes(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 100 == 0)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    lowered = F.translate("text", audit.CAPITALS, audit.CAPITALS.lower())
    tampered = F.when(crc_of("doc_id") % 3 == 0, merkle.record_hash(["doc_id", "source", "lang", "n_chars", lowered]))
    leaf = merkle.record_hash(["doc_id", "source", "lang", "n_chars", "text"])
    found = merkle.manifest(docs, leaf, "lang", "doc_id", [F.when(F.col("doc_id").isNotNull(), tampered).alias("tampered")])
    folded = found.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "digest"), F.col("witness")))
    return folded.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(merkle.siblings(F.col("witness")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"), "doc_id", "text", "lang")


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.greatest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_secret_scan": op3_secret_scan,
    "op4_rendezvous": op4_rendezvous,
    "op5_perspectives": op5_perspectives,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_quality": op8_quality,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_nearest": op10_nearest,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_filter_audit": op12_filter_audit,
    "op13_exact_top_k": op13_exact_top_k,
}

_URL_VALUES = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)

#: Levels that the manifest's SQL climbs: up to 8**7 documents of a language, 8**3 languages.
_LEAF_LEVELS, _GROUP_LEVELS = 7, 3


def _record_sql(columns: list[str]) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns) + ")"


def _climb_sql(nodes: str, way: str, name: str, levels: int) -> str:
    """CTEs from ``nodes`` (tree, pos, n, h) to its roots and from ``way`` (row, tree, pos, acc, proof) to the folded ones."""
    out, run = [], "OVER (PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN "
    for k in range(levels):
        here, path = (nodes, way) if k == 0 else (f"{name}{k}", f"{name}_way{k}")
        out.append(f"{name}_side{k} AS (SELECT tree, pos, n, coalesce(string_agg(h, '') {run}UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') {run}1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {here})")
        out.append(f"{name}{k + 1} AS (SELECT tree, pos // 8 AS pos, (max(n) + 7) // 8 AS n, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {here} GROUP BY tree, pos // 8)")
        out.append(f"{name}_way{k + 1} AS (SELECT w.row, w.tree, w.pos // 8 AS pos, CASE WHEN n = 1 THEN acc ELSE sha256(l || acc || r) END AS acc, proof || l || r AS proof FROM {path} w JOIN {name}_side{k} s ON w.tree = s.tree AND w.pos = s.pos)")
    return ",\n".join(out)


_ORDERS = ", ".join(
    f"('{''.join(o)}', {step + 1}, '{f}', {1 << 'ABCDE'.index(f)}, {sum(1 << 'ABCDE'.index(g) for g in o[:step])})" for o in permutations("ABCDE") for step, f in enumerate(o)
)

ORACLE_SQL: dict[str, str] = {
    "op5_perspectives": f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS who, coalesce(text, '') AS said,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS nth FROM conversations),
people AS (SELECT DISTINCT conv_id, who AS perspective FROM turns WHERE who <> 'system'),
seen AS (SELECT t.conv_id, perspective, CAST(floor(nth / {chat.PART_TURNS}) AS BIGINT) AS part, nth, who,
       CASE WHEN who = 'system' THEN '<|system|>' WHEN who = perspective THEN '<|assistant|>' ELSE '<|user name=' || who || '|>' END || chr(10) AS head,
       said || '<|end|>' || chr(10) AS body FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
cut AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part ORDER BY nth) AS upto FROM seen)
SELECT conv_id, perspective, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY nth) AS text,
       coalesce(string_agg(CASE WHEN who = perspective THEN (upto - length(body)) || '-' || upto END, ',' ORDER BY nth), '') AS loss_spans
FROM cut GROUP BY conv_id, perspective, part""",
    "op7_url_filter": f"""
WITH rules(h, p, act) AS (VALUES {_URL_VALUES}),
parts AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
cut AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
best AS (SELECT page_id, host, path, (SELECT arg_max(h || p || ' ' || act, length(h || p)) FROM rules
         WHERE (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)) AS found FROM cut)
SELECT page_id, host, path, split_part(found, ' ', 1) AS rule, coalesce(split_part(found, ' ', 2), 'allow') AS verdict FROM best""",
    "op11_merkle_manifest": f"""
WITH crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), i)) AS t),
crc AS (SELECT doc_id, xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
        lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 3 = 0 AS marked FROM (SELECT DISTINCT doc_id FROM documents), crc_table),
leaves AS (SELECT row_number() OVER () AS row, d.doc_id, coalesce('1' || lang, '0') AS tree, {_record_sql(["d.doc_id", "source", "lang", "n_chars", "text"])} AS h,
        CASE WHEN marked THEN {_record_sql(["d.doc_id", "source", "lang", "n_chars", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"])} END AS tampered
        FROM documents d LEFT JOIN crc ON d.doc_id = crc.doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
way AS (SELECT row, tree, pos, coalesce(tampered, h) AS acc, '' AS proof FROM placed),
{_climb_sql("placed", "way", "leaf", _LEAF_LEVELS)},
groups AS (SELECT '' AS tree, tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM leaf{_LEAF_LEVELS}),
rise AS (SELECT row, '' AS tree, g.pos, acc, proof FROM leaf_way{_LEAF_LEVELS} w JOIN groups g ON w.tree = g.name),
{_climb_sql("groups", "rise", "upper", _GROUP_LEVELS)}
SELECT doc_id, p.h AS leaf, g.h AS subroot, u.h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = u.h AS verified
FROM placed p JOIN upper_way{_GROUP_LEVELS} w ON p.row = w.row JOIN groups g ON p.tree = g.name CROSS JOIN upper{_GROUP_LEVELS} u""",
    "op12_filter_audit": f"""
WITH flags AS (SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
said AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
masks AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
        + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN s.doc_id > min(s.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM said s LEFT JOIN flags f ON s.doc_id = f.doc_id),
counts AS (SELECT part, mask, good, toxic, count(*) AS c FROM masks GROUP BY ALL),
orders(filter_order, step, letter, bit, earlier) AS (VALUES {_ORDERS}),
steps AS (SELECT part, filter_order, step, letter,
        coalesce(sum(c) FILTER (WHERE mask & bit = 0 AND mask & earlier = 0), 0) AS kept, coalesce(sum(c) FILTER (WHERE mask & bit <> 0 AND mask & earlier = 0), 0) AS removed,
        coalesce(sum(c) FILTER (WHERE mask & bit <> 0 AND mask & earlier <> 0), 0) AS redundant, coalesce(sum(c) FILTER (WHERE mask = bit), 0) AS unique_fails,
        coalesce(sum(c) FILTER (WHERE mask & bit <> 0 AND mask & earlier = 0 AND good), 0) AS good_lost, coalesce(sum(c) FILTER (WHERE mask & bit <> 0 AND mask & earlier = 0 AND toxic), 0) AS toxic_lost
        FROM counts CROSS JOIN orders GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM steps""",
    "op13_exact_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS c FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_inner_product(q.c, v.c) AS BIGINT) AS score FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20""",
}
