"""Weighted rendezvous sharding.

Every (record key, shard) pair has a hash, read as a uniform number u; a record
goes to the shard with the least ``-ln(u) / weight``. Adding a shard changes
nothing between the old ones, so a record either stays or moves to the new
shard; a shard gets a share of the keys in proportion to its weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleloom.llm.rows import keep

#: Rows that one numbering block holds on average.
BLOCK_ROWS = 100_000


def pull(key: str, shard: int, weight: float) -> Column:
    """A record's distance to a shard: exponential with rate ``weight``, from the key's hash alone."""
    named = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null"))
    u = (F.shiftrightunsigned(F.xxhash64(named, F.lit(shard)), 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
    return -F.log(u) / F.lit(float(weight))


def nearest(key: str, weights: Sequence[float]) -> Column:
    """The shard of least distance (ties: the smaller number); shards of weight 0 or less get nothing."""
    live = [F.struct(pull(key, s, w).alias("d"), F.lit(s).alias("s")) for s, w in enumerate(weights) if w > 0]
    if not live:
        raise ValueError("no shard has a positive weight")
    return F.array_min(F.array(*live))["s"]


def number_within(df: DataFrame, group: str, order: list[str], out: str, salt: str) -> DataFrame:
    """Number the rows of each group gaplessly from 0 without bringing a group together.

    Rows are numbered inside blocks (group, ``salt``), then shifted by the rows of the
    group's earlier blocks. ``df`` has to give the same rows each time it is read.
    """
    sizes = df.groupBy(group, salt).agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(_before(group, salt)) - F.col("__rows")
    starts = sizes.select(F.col(group).alias("__g"), F.col(salt).alias("__s"), before.alias("__start"))
    inner = F.row_number().over(Window.partitionBy(group, salt).orderBy(*order)) - 1
    joined = df.join(starts, (F.col(group) == F.col("__g")) & (F.col(salt) == F.col("__s")))
    return joined.withColumn(out, (F.col("__start") + inner).cast("long")).drop("__g", "__s", "__start")


def _before(group: str, salt: str):
    return Window.partitionBy(group).orderBy(salt).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def shard_records(df: DataFrame, key: str, text: str, weights: Sequence[float], grown_weight: float | None = None) -> DataFrame:
    """Shard of every row: ``key``, size, text_crc32, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 8, ``slot`` the row's place in its shard,
    ``grown_shard`` its shard if one of weight ``grown_weight`` (default: the last
    shard's) were added. A null key is a key of its own; a null text counts as
    empty; rows of one key share a shard and differ in slot; an empty table gives
    an empty result. Other columns are not returned.
    """
    grown = weights[-1] if grown_weight is None else grown_weight
    rows = df.count()
    blocks = max(1, rows // (len(weights) * BLOCK_ROWS))
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    # Copies of one key spread over blocks by the partition they were read in.
    salt = F.pmod(F.xxhash64(F.col(key), F.spark_partition_id()), F.lit(blocks))
    placed = df.select(
        F.col(key),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        nearest(key, weights).cast("int").alias("shard"),
        nearest(key, [*weights, grown]).cast("int").alias("grown_shard"),
        salt.alias("__salt"),
    )
    placed = keep(placed, "shards")
    return number_within(placed, "shard", [key, "size", "text_crc32"], "slot", "__salt").drop("__salt")
