"""Spans inside a key (A2): sessions cut at pauses, and stretches of a fixed length.

Both work on (key, piece of time) groups, so a key that holds a third of all rows is dealt
over as many tasks as it has pieces. What crosses a piece's edge is settled afterwards from
the edges alone (sessions) or by repeating the rows just before it (stretches).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregate import epoch_micros, minutes_between

_MINUTE = 60_000_000


def _timed(df: DataFrame, keys: list[str], time_col: str, amount_col: str) -> tuple[DataFrame, list[str]]:
    """(k0, k1, …, time, t, amount): the rows with a time, ``t`` in microseconds."""
    own = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    time = F.col(f"`{time_col}`")
    rows = df.filter(time.isNotNull()).select(*own, time.alias("time"), epoch_micros(time, df.schema[time_col].dataType).alias("t"), F.col(f"`{amount_col}`").alias("amount"))
    return rows, [f"k{i}" for i in range(len(keys))]


def _scaled(total: Column, scale: int | None) -> Column:
    return total if scale is None else F.round(total, scale)


def sessions(df: DataFrame, keys: list[str], time_col: str, amount_col: str, gap_minutes: float,
             piece_minutes: float = 1440, amount_scale: int | None = None) -> DataFrame:
    """Runs of a key's events without a pause of more than ``gap_minutes``.

    One row per session: ``keys``, ``session_start``, ``session_end``,
    ``n_events``, ``total_amount`` (rounded to ``amount_scale`` digits, if
    given), ``minutes``. Rows without a time belong to none; null keys are a key; rows
    that repeat count each. ``piece_minutes`` only deals the work: sessions
    may be longer.
    """
    rows, k = _timed(df, keys, time_col, amount_col)
    gap, piece = round(gap_minutes * _MINUTE), round(piece_minutes * _MINUTE)
    rows = rows.withColumn("piece", F.floor(F.col("t") / F.lit(piece)))
    in_piece = Window.partitionBy(*k, "piece").orderBy("t")
    pause = F.col("t") - F.lag("t").over(in_piece) > gap
    numbered = rows.withColumn("new", F.coalesce(pause, F.lit(False)).cast("int")).withColumn("run", F.sum("new").over(in_piece))
    totals = [F.min("time").alias("start"), F.max("time").alias("end"), F.min("t").alias("t0"), F.max("t").alias("t1")]
    parts = numbered.groupBy(*k, "piece", "run").agg(*totals, F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
    # Only the first and the last run of a piece can go on beyond it.
    parts = parts.withColumn("last", F.col("run") == F.max("run").over(Window.partitionBy(*k, "piece")))
    inner = parts.filter(~F.col("last") & (F.col("run") > 0))
    by_key = Window.partitionBy(*k).orderBy("t0")
    goes_on = (F.col("run") == 0) & (F.col("t0") - F.lag("t1").over(by_key) <= gap)
    edges = parts.filter(F.col("last") | (F.col("run") == 0)).withColumn("new", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    edges = edges.withColumn("run", F.sum("new").over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = edges.groupBy(*k, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"), F.sum("total").alias("total"))
    found = whole.drop("run").unionByName(inner.select(*k, "start", "end", "n", "total"))
    kind = df.schema[time_col].dataType
    return found.select(
        *[F.col(f"k{i}").alias(name) for i, name in enumerate(keys)],
        F.col("start").alias("session_start"),
        F.col("end").alias("session_end"),
        F.col("n").alias("n_events"),
        _scaled(F.col("total"), amount_scale).alias("total_amount"),
        minutes_between(F.col("start"), F.col("end"), kind).alias("minutes"),
    )


def stretches(df: DataFrame, keys: list[str], time_col: str, amount_col: str, minutes: float, min_events: int = 1,
              piece_minutes: float = 360, amount_scale: int | None = None) -> DataFrame:
    """Per event, what its key did in the ``minutes`` up to it (both ends included).

    One row per event: ``keys``, ``stretch_end`` (its time), ``n_events``,
    ``total_amount``; only stretches of ``min_events`` or more. Events at the same time see
    each other. Rows without a time are in none; null keys are a key; a null amount adds nothing
    (a stretch without any has the total null). Sums are differences of running sums over a
    piece: no event is added twice, however many lie in a stretch.
    """
    rows, k = _timed(df, keys, time_col, amount_col)
    span, piece = round(minutes * _MINUTE), round(piece_minutes * _MINUTE)
    first = F.floor(F.col("t") / F.lit(piece))
    # A row is repeated, as a witness only, in the pieces that begin less than a stretch after it.
    dealt = rows.withColumn("own", first).withColumn("piece", F.explode(F.sequence(first, F.floor((F.col("t") + span) / F.lit(piece)))))
    upto = Window.partitionBy(*k, "piece").orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*k, "piece").orderBy("t").rangeBetween(Window.unboundedPreceding, -(span + 1))

    def within(value: Column) -> Column:
        return value.over(upto) - F.coalesce(value.over(before), F.lit(0))

    seen = dealt.withColumns({"n_events": within(F.count(F.lit(1))), "valued": within(F.count("amount")), "total": within(F.sum("amount"))})
    total = F.when(F.col("valued") > 0, _scaled(F.col("total"), amount_scale))
    return seen.filter((F.col("piece") == F.col("own")) & (F.col("n_events") >= min_events)).select(
        *[F.col(f"k{i}").alias(name) for i, name in enumerate(keys)], F.col("time").alias("stretch_end"), "n_events", total.alias("total_amount")
    )
