"""Sinks (S5, S6): CSV output and the rule audit log.

Writes are partitioned (one file per task): no ``repartition(1)``, which
would funnel all rows through one task. The audit log is a parquet table
appended to per run, with the predicate text of every call recorded.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.status import RuleResult
from .readers import CSV_NULL, _texts, escape_breaks

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
        T.StructField("rule_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("predicate", T.StringType()),
        T.StructField("n_hits", T.LongType()),
    ]
)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", escaped_breaks: bool = False) -> str:
    """Header CSV, one part file per task.

    With ``escaped_breaks`` line breaks in texts are written escaped, so that
    every record is a line and large files can be read in splits
    (``read_csv(escaped_breaks=True)``).
    """
    if escaped_breaks:
        df = df.select(*_texts(df.schema, escape_breaks))
    options = {"header": True, "quoteAll": True, "quote": '"', "escape": '"', "nullValue": CSV_NULL, "emptyValue": "",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**options).csv(path)
    return path


def new_run_id() -> str:
    return uuid.uuid4().hex


def audit_frame(spark: SparkSession, results: list[RuleResult], run_id: str | None = None) -> DataFrame:
    """One audit row per rule call (status, message, predicate text)."""
    rid = run_id or new_run_id()
    now = _dt.datetime.now(_dt.timezone.utc)
    rows = [(rid, now, r.rule_id, r.status.value, r.message, r.text, None) for r in results]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def hits_audit_frame(hits: DataFrame, results: dict[str, RuleResult], run_id: str) -> DataFrame:
    """S6 for hit counts: joins ``(rule_id, n_hits)`` with each call's status.

    ``hits`` comes from :func:`..operators.actions.rule_hit_counts` (one row
    per rule); the per-rule status / text are literals of the plan.
    """
    status = F.create_map(*[x for rid, r in results.items() for x in (F.lit(rid), F.lit(r.status.value))])
    message = F.create_map(*[x for rid, r in results.items() for x in (F.lit(rid), F.lit(r.message))])
    text = F.create_map(*[x for rid, r in results.items() for x in (F.lit(rid), F.lit(r.text))])
    return hits.select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("logged_at"),
        F.col("rule_id"),
        status[F.col("rule_id")].alias("status"),
        message[F.col("rule_id")].alias("message"),
        text[F.col("rule_id")].alias("predicate"),
        F.col("n_hits").cast("long").alias("n_hits"),
    )


def append_audit(df: DataFrame, path: str, run_id: str) -> str:
    """Add one run's audit rows to the parquet log at ``path``.

    Each run is written to its own ``run_id=<id>`` folder: runs never share a
    job's temporary output (concurrent runs do not clash), a failed run
    leaves no partial rows in other runs, and reading one run prunes to its
    folder. The id is given, so nothing is computed to find it.
    """
    cols = [F.col(f.name).cast(f.dataType) for f in AUDIT_SCHEMA.fields if f.name != "run_id"]
    df.select(*cols).write.mode("errorifexists").parquet(f"{path.rstrip('/')}/run_id={run_id}")
    return path


def read_audit(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """The audit log (all runs, or one run read from its own folder only)."""
    out = spark.read.schema(AUDIT_SCHEMA).parquet(path)
    return out.filter(F.col("run_id") == run_id) if run_id else out
