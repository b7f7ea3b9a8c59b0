"""Exact order statistics without bringing a key, or the table, together (A1, A3).

Everything rests on one step: rows are dealt by ranges of an order and written
with the number of their range; the counts of the ranges (one small row each) then tell
every range where it begins. No window runs over a whole key or table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

#: Parts that each key is dealt into before its best rows are compared.
PARTS = 32


def _named(columns: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(f"`{c}`").alias(f"{prefix}{i}") for i, c in enumerate(columns)]


def _ordering(columns: Sequence[str], prefix: str) -> list[Column]:
    """Sort expressions for ``name`` or ``-name`` (descending); null first ascending, last descending."""
    return [F.col(f"{prefix}{i}").desc() if c.startswith("-") else F.col(f"{prefix}{i}").asc() for i, c in enumerate(columns)]


def row_positions(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """A3: ``df`` with each row's place in the order, gapless from 1.

    ``order`` names columns, ``-name`` for descending; nulls come first ascending and last
    descending. Rows equal in all of them get neighbouring places in no particular order, and may
    be a third of the table: they are dealt over ranges like others. A column named ``out``
    gives way.
    """
    kept = [c for c in df.columns if c != out]
    plain = [c.removeprefix("-") for c in order]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), *_named(plain, "o"), F.monotonically_increasing_id().alias("tie"))
    sort = [*_ordering(order, "o"), F.col("tie")]
    dealt = written(rows.repartitionByRange(*sort).withColumn("range", F.spark_partition_id()), "positions")
    inner = F.row_number().over(Window.partitionBy("range").orderBy(*sort))
    # One count a range: as many as there are shuffle partitions.
    counts = sorted(dealt.groupBy("range").count().collect())
    starts, before = [], 0
    for number, count in counts:
        starts.append((number, before))
        before += count
    begins = df.sparkSession.createDataFrame(starts, "range int, begins long")
    placed = dealt.withColumn("place", inner).join(F.broadcast(begins), "range")
    return placed.select("row.*", (F.col("begins") + F.col("place")).cast("long").alias(out))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, out: str = "rank") -> DataFrame:
    """A3 a key: its first ``k`` rows in the order, with their rank from 1.

    Every key is dealt into parts first, each part keeps ``k`` rows, and only these are
    compared, so a hot key costs a task ``PARTS * k`` rows, whatever ``k``. ``order`` as in
    :func:`row_positions`; give enough columns for a total order where ties matter. A column
    named ``out`` gives way; null keys are a key; fewer than ``k`` rows are all returned.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    kept = [c for c in df.columns if c != out]
    plain = [c.removeprefix("-") for c in order]
    own = [f"k{i}" for i in range(len(keys))]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), *_named(keys, "k"), *_named(plain, "o"), F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).alias("part"))
    sort = _ordering(order, "o")
    best = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*own, "part").orderBy(*sort))).filter(F.col("nth") <= k)
    ranked = best.withColumn("nth", F.row_number().over(Window.partitionBy(*own).orderBy(*sort))).filter(F.col("nth") <= k)
    return ranked.select("row.*", F.col("nth").alias(out))


def exact_statistics(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """A1: distinct values, mode and median of ``value`` per key, exactly.

    Columns: ``keys``, ``n_rows``, ``n_values`` (non-null), ``n_distinct``, ``mode`` (the most
    frequent value, ties: the least), ``median_low`` and ``median_high`` (the middle value, or the
    two), and for numbers ``median``, half their sum as a double. A key without values has nulls; null keys
    are a key; at least one key column is needed. Rows are counted by (key, value) first, so repeated values are no load; the
    middle is found among counted ranges of values, so neither are many different ones.
    """
    if not keys:
        raise ValueError("at least one key column is needed")
    own = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*_named(keys, "k"), F.col(f"`{value}`").alias("v"))
    counted = rows.groupBy(*own, "v").agg(F.count(F.lit(1)).alias("n"))
    sort = [F.col(c) for c in [*own, "v"]]
    dealt = written(counted.repartitionByRange(*sort).withColumn("range", F.spark_partition_id()), "counted")
    known = dealt.filter(F.col("v").isNotNull())
    mode = F.min(F.when(F.col("v").isNotNull(), F.struct((-F.col("n")).alias("often"), F.col("v").alias("v"))))["v"]
    valued = F.when(F.col("v").isNotNull(), F.col("n")).otherwise(F.lit(0))
    totals = dealt.groupBy(*own).agg(F.sum("n").alias("n_rows"), F.sum(valued).alias("n_values"), F.count("v").alias("n_distinct"), mode.alias("mode"))
    parts = known.groupBy(*own, "range").agg(F.sum("n").alias("held"))
    by_key = Window.partitionBy(*own).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.sum("held").over(Window.partitionBy(*own))
    begins = parts.select(*own, "range", "held", (F.sum("held").over(by_key) - F.col("held")).alias("begins"), whole.alias("all"))
    # Only ranges that hold one of the two middle places are looked into.
    low, high = F.floor((F.col("all") + 1) / 2), F.floor(F.col("all") / 2) + 1
    middle = begins.filter((F.col("begins") < high) & (F.col("begins") + F.col("held") >= low))
    match = [F.col(f"c.{c}").eqNullSafe(F.col(f"m.{c}")) for c in [*own, "range"]]
    near = known.alias("c").join(middle.alias("m"), match).select("c.*", "m.begins", "m.all")
    upto = F.col("begins") + F.sum("n").over(Window.partitionBy(*own, "range").orderBy("v"))
    near = near.withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("n"))

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("from") < place) & (place <= F.col("upto")), F.col("v")))

    medians = near.groupBy(*own).agg(at(low).alias("median_low"), at(high).alias("median_high"))
    joined = totals.alias("t").join(medians.alias("m"), [F.col(f"t.{c}").eqNullSafe(F.col(f"m.{c}")) for c in own], "left").select("t.*", "median_low", "median_high")
    out = [F.col(f"k{i}").alias(k) for i, k in enumerate(keys)]
    out += [F.col(c) for c in ("n_rows", "n_values", "n_distinct", "mode", "median_low", "median_high")]
    if isinstance(df.schema[value].dataType, T.NumericType):
        out.append(((F.col("median_low").cast("double") + F.col("median_high").cast("double")) / 2).alias("median"))
    return joined.select(*out)
