"""Grouped checks (A1–A3): group-by lookups, time spans per key, ordering.

Both aggregations use only algebraic aggregates (count, sum, min, max), so
Spark combines them map-side before the shuffle: a key holding a third of
all rows still sends one partial row per task, not its rows. Values are summed
as they are; a caller may ask for the total of doubles rounded to a scale.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.chain import group_keys
from ..plans.status import RuleError, Status
from .apply import rule_plan


def exact_sum(col: str | Column, scale: int | None = None) -> Column:
    """Sum of the values as they are: exact for integers and decimals.

    Sums of doubles depend in their last digits on the order rows arrive in;
    ``scale`` rounds the finished total (never the values) to that many digits.
    """
    total = F.sum(F.col(col) if isinstance(col, str) else col)
    return total if scale is None else F.round(total, scale)


# Aggregate functions that keep every value of a group (no
# map-side combine to a bounded partial), so a hot key lands in one task.
HOLISTIC_AGGREGATES = ("collect_list", "collect_set", "array_agg", "string_agg", "listagg", "percentile(",
                       "median(", "mode(")


def _warn_holistic(aggs: list[Column]) -> None:
    for c in aggs:
        text = str(c).lower()
        hit = next((f for f in HOLISTIC_AGGREGATES if f in text), None)
        if hit:
            warnings.warn(
                f"aggregate {text} keeps every value of a group ({hit.rstrip('(')}): a key holding a large share "
                "of the rows will be gathered in one task; exact_statistics gives distinct counts, modes and medians without that",
                stacklevel=3,
            )


def group_lookup(df: DataFrame, catalog, rule_id: str, aggs: list[Column] | dict[str, Column], as_of=None) -> DataFrame:
    """A1: the rule's ``group by <keys>`` with the aggregates given here.

    The rule only names the keys (rule documents carry no aggregates), so the
    caller supplies them, e.g. ``{"n_rows": F.count("*")}``.
    """
    plan = rule_plan(catalog, rule_id, as_of=as_of)
    if plan.kind != "group":
        raise RuleError(Status.NOT_APPLICABLE, f"rule {rule_id} is not a group-by lookup")
    if isinstance(aggs, dict):
        aggs = [c.alias(n) for n, c in aggs.items()]
    if not aggs:
        raise RuleError(Status.NOT_APPLICABLE, f"group rule {rule_id} needs at least one aggregate")
    _warn_holistic(aggs)
    keys = group_keys(plan.tail)
    return df.groupBy(*[F.expr(k) for k in keys]).agg(*aggs)


def epoch_micros(col: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970-01-01 00:00, independent of the session zone.

    For wall-clock values (``timestamp_ntz``) this is calendar arithmetic on
    the values themselves (day number and time of day), so no time zone and
    no daylight-saving jump is involved. Instants (``timestamp``) use
    ``unix_micros``.
    """
    if isinstance(dtype, T.TimestampNTZType):
        days = F.datediff(F.to_date(col), F.lit("1970-01-01").cast("date")).cast("long")
        of_day = (
            F.hour(col).cast("long") * 3_600_000_000
            + F.minute(col).cast("long") * 60_000_000
            + (F.date_part(F.lit("SECOND"), col) * 1_000_000).cast("long")
        )
        return days * 86_400_000_000 + of_day
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.DateType):
        return F.unix_micros(F.to_timestamp(col))
    raise TypeError(f"not a time column: {dtype.simpleString()}")


def minutes_between(start: Column, end: Column, dtype: T.DataType) -> Column:
    """Minutes from ``start`` to ``end`` as a double (microsecond precision)."""
    return (epoch_micros(end, dtype) - epoch_micros(start, dtype)) / F.lit(60_000_000.0)


def time_span(
    df: DataFrame,
    keys: list[str],
    time_col: str,
    amount_col: str,
    max_minutes: float,
    per_day: bool = False,
    min_events: int = 1,
    order: bool = False,
    amount_scale: int | None = None,
) -> DataFrame:
    """A2: groups whose events all fall within ``max_minutes`` of each other.

    Output per ``keys`` (and calendar day of ``time_col`` when ``per_day``):
    ``n_events, total_amount, min_time, max_time, minutes``; only groups with
    at least ``min_events`` rows and a span ``<= max_minutes`` are kept.
    ``order`` adds A3 (sorted by the keys); ``amount_scale`` rounds the totals
    (see :func:`exact_sum`). The defaults keep every group: a single event has
    span 0, and a span may cross midnight.
    """
    group = [F.col(k) for k in keys]
    if per_day:
        group.append(F.to_date(F.col(time_col)).alias("day"))
    out = (
        df.groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            exact_sum(amount_col, amount_scale).alias("total_amount"),
            F.min(time_col).alias("min_time"),
            F.max(time_col).alias("max_time"),
        )
        .withColumn("minutes", minutes_between(F.col("min_time"), F.col("max_time"), df.schema[time_col].dataType))
        .filter((F.col("n_events") >= min_events) & (F.col("minutes") <= F.lit(float(max_minutes))))
    )
    return order_by(out, keys + (["day"] if per_day else [])) if order else out


def order_by(df: DataFrame, cols: list[str]) -> DataFrame:
    """A3: a total order on the result (range-partitioned sort)."""
    return df.orderBy(*cols)
