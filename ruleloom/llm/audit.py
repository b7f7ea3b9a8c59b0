"""What filters do to a corpus in every order they could run in.

The documents pass as a stream of files, in micro-batches. Each document gets a mask of the
filters it fails on its own text; the last filter, for texts that a smaller id has too, needs
the others: a table keyed by text holds the least id seen so far and the rows that bear it. When a
smaller one arrives, what was counted for the earlier rows is taken back and counted again
as a copy. Counts by mask are all that the orders of the filters need.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleloom.llm.rows import named
from ruleloom.session import shared_path
from ruleloom.streaming.stream import parquet_stream

#: Characters between words, besides the blank, and the two alphabets (fixed values).
SPACES = "\t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Micro-batches that the files are dealt into.
BATCHES = 4
STATE = "text_key string, part string, good boolean, toxic boolean, mask int, least long, copies long"
COUNTS = "part string, mask int, good boolean, toxic boolean, documents long"


def text_filters(text: str) -> dict[str, Column]:
    """Failure of each filter that looks at the document alone; null texts are empty."""
    t = F.coalesce(named(text).cast("string"), F.lit(""))
    words = F.array_remove(F.split(F.translate(t, SPACES, " " * len(SPACES)), " "), "")
    capitals = F.length(t) - F.length(F.translate(t, CAPITALS, ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(t),
        "D": t.rlike(r"[#$%&*|]"),
    }


def label_flags(labels: DataFrame, key: str) -> DataFrame:
    """(label_key, good, toxic): of several labels of a key any that says so counts; null keys have none."""
    flags = labels.filter(named(key).isNotNull()).groupBy(named(key).alias("label_key"))
    return flags.agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))


def masked(docs: DataFrame, key: str, text: str, part: str, flags: DataFrame) -> DataFrame:
    """(text_key, part, good, toxic, mask, id) of every document; bit i of the mask is the i-th filter's failure."""
    bits = [F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(text_filters(text).values())]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    own = docs.select(
        F.sha2(F.coalesce(named(text).cast("string"), F.lit("")), 256).alias("text_key"),
        F.coalesce(named(part).cast("string"), F.lit("")).alias("part"),
        mask.alias("mask"),
        named(key).cast("long").alias("id"),
    )
    found = own.join(flags, own["id"] == flags["label_key"], "left").drop("label_key")
    return found.withColumns({"good": F.coalesce("good", F.lit(False)), "toxic": F.coalesce("toxic", F.lit(False))})


def absorb(rows: DataFrame, state: DataFrame, copy_bit: int) -> tuple[DataFrame, DataFrame]:
    """(changes of the counts, rows that now bear their text's least id) of one micro-batch.

    ``state`` holds all rows that bore the least id of their text when they came; those of
    a text whose id is no longer the least were taken back before. A text that holds a
    third of all rows is counted before it is brought together.
    """
    kind = ["text_key", "part", "good", "toxic", "mask"]
    same = rows.groupBy(*kind, "id").agg(F.count(F.lit(1)).alias("n"))
    named = same.filter(F.col("id").isNotNull()).groupBy(*kind).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("first"))
    new = named.select(*kind, F.col("first.id").alias("least"), F.col("first.n").alias("copies"), "n", F.lit(False).alias("old"))
    old = state.select(*kind, "least", "copies", F.col("copies").alias("n"), F.lit(True).alias("old"))
    ends = old.unionByName(new).groupBy("text_key").agg(F.min("least").alias("now"), F.min(F.when(F.col("old"), F.col("least"))).alias("before"), F.max(~F.col("old")).alias("touched"))
    met = old.unionByName(new).join(ends.filter("touched"), "text_key")
    first = F.col("least") == F.col("now")
    copy = F.col("mask").bitwiseOR(F.lit(copy_bit))
    passed = F.when(F.col("old"), F.when(first, F.lit(0)).when(F.col("least") == F.col("before"), -F.col("n")).otherwise(F.lit(0))).otherwise(F.when(first, F.col("copies")).otherwise(F.lit(0)))
    failed = F.when(F.col("old"), -F.col("passed")).otherwise(F.col("n") - F.col("passed"))
    moved = met.withColumn("passed", passed.cast("long")).withColumn("failed", failed.cast("long"))
    each = moved.select("part", "good", "toxic", F.explode(F.array(F.struct("mask", F.col("passed").alias("n")), F.struct(copy.alias("mask"), F.col("failed").alias("n")))).alias("x"))
    loose = same.filter(F.col("id").isNull()).select("part", "good", "toxic", "mask", "n")
    changes = each.select("part", "good", "toxic", "x.mask", "x.n").unionByName(loose)
    changes = changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("documents")).filter("documents <> 0")
    return changes, met.filter(~F.col("old") & first).select("text_key", "part", "good", "toxic", "mask", "least", "copies")


def mask_counts(stream: DataFrame, key: str, text: str, part: str, flags: DataFrame, folder: str | None = None) -> DataFrame:
    """(part, mask, good, toxic, documents) of a stream of documents, drained.

    Batch n writes ``state/batch=n`` and ``counts/batch=n`` and reads the state of the batches
    before it, so a batch that is run again after a failure replaces what it wrote; the stream's own progress
    lies beside them, and a later run over the same ``folder`` goes on with new files only.
    """
    spark = stream.sparkSession
    folder = folder or shared_path(spark, "filter-audit")
    copy_bit = 1 << len(text_filters(text))

    def batch(docs: DataFrame, n: int) -> None:
        session = docs.sparkSession
        earlier = [f"{folder}/state/batch={b}" for b in range(n)]
        state = session.read.schema(STATE).parquet(*earlier) if earlier else session.createDataFrame([], STATE)
        seen = f"{folder}/seen/batch={n}"
        masked(docs, key, text, part, flags).write.mode("overwrite").parquet(seen)
        changes, first = absorb(session.read.schema("text_key string, part string, mask int, id long, good boolean, toxic boolean").parquet(seen), state, copy_bit)
        first.write.mode("overwrite").parquet(f"{folder}/state/batch={n}")
        changes.write.mode("overwrite").parquet(f"{folder}/counts/batch={n}")

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()
    return _summed(spark, folder)


def _summed(spark: SparkSession, folder: str) -> DataFrame:
    kept = spark.read.schema(COUNTS + ", batch int").option("recursiveFileLookup", "false").parquet(f"{folder}/counts")
    return kept.groupBy("part", "mask", "good", "toxic").agg(F.sum("documents").alias("documents")).filter("documents > 0")


def orders(filters: Sequence[str]) -> Column:
    """All (filter_order, step, letter, bit, earlier): the filter of each step and the bits of those before it."""
    bit = {f: 1 << i for i, f in enumerate(sorted(filters))}
    rows = []
    for order in permutations(sorted(filters)):
        for step, f in enumerate(order):
            rows.append(f"{''.join(order)},{step + 1},{f},{bit[f]},{sum(bit[g] for g in order[:step])}")
    parts = F.transform(F.split(F.lit(";".join(rows)), ";"), lambda r: F.split(r, ","))
    return F.transform(parts, lambda p: F.struct(p[0].alias("filter_order"), p[1].cast("int").alias("step"), p[2].alias("letter"), p[3].cast("int").alias("bit"), p[4].cast("int").alias("earlier")))


def interactions(counts: DataFrame, filters: Sequence[str] = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step, from counts by mask.

    ``kept`` documents stand after the step, ``removed`` ones fall in it, ``redundant`` ones fail its filter
    but fell before, ``unique_fails`` fail it alone, ``good_lost`` and ``toxic_lost`` are labelled ones
    among the removed, and ``shapley`` sums the removed of the step's filter over all orders.
    """
    spread = counts.withColumn("at", F.explode(orders(filters))).select("part", "mask", "good", "toxic", "documents", "at.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("earlier")) != 0

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("documents")).otherwise(F.lit(0))).cast("long").alias(name)

    steps = spread.groupBy("part", "filter_order", "step", "letter").agg(
        total(~fails & ~gone, "kept"),
        total(fails & ~gone, "removed"),
        total(fails & gone, "redundant"),
        total(F.col("mask") == F.col("bit"), "unique_fails"),
        total(fails & ~gone & F.col("good"), "good_lost"),
        total(fails & ~gone & F.col("toxic"), "toxic_lost"),
    )
    shares = steps.groupBy("part", "letter").agg(F.sum("removed").cast("long").alias("shapley"))
    return steps.join(shares, ["part", "letter"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(spark: SparkSession, path: str, labels: DataFrame, key: str, text: str, part: str, batches: int = BATCHES) -> DataFrame:
    """:func:`interactions` of the Parquet documents at ``path``, streamed in about ``batches`` micro-batches.

    Filters A to D look at the text (fewer than 200 words; fewer than half of them distinct; more than
    3 % capitals; any of ``# $ % & * |``), E fails a document whose text a smaller id has too, kept or not.
    Null texts are empty, a null ``part`` is the empty one. Rows that repeat an id count each; those of the
    least id pass E together. A row without id passes E and makes no other fail it, and has no
    labels. Other columns are not read, whatever their names; an empty table gives an empty result.
    """
    files = len(spark.read.parquet(path).inputFiles())
    stream = parquet_stream(spark, path, max_files=max(1, -(-files // batches)))
    return interactions(mask_counts(stream.select(named(key), named(text), named(part)), key, text, part, label_flags(labels, key)))
