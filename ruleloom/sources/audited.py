"""Writing a result and its audit in one pass.

The rows each rule hits are counted by ``observe`` while the result is written: the input is
scanned once. The audit of a run is one row, written as one file when the result stands.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.actions import bind_statuses, tag_all
from .sinks import new_run_id

RUN_SCHEMA = "logged_at timestamp, output string, n_rows long, rules array<struct<rule_id: string, status: string, message: string, predicate: string, n_hits: long>>"


@dataclass(frozen=True)
class AuditedRun:
    run_id: str
    output: str
    n_rows: int
    hits: dict[str, int]


def write_tagged(df: DataFrame, catalog, rule_ids, out_path: str, audit_path: str, as_of=None, hits_col: str = "hits",
                 guard: bool = False, run_id: str | None = None) -> AuditedRun:
    """Write ``df`` tagged with all usable rules as parquet, and the run's audit beside it.

    Result and audit lie in folders of their own (``run_id=<id>``); a run that fails
    leaves no audit row, and one that is repeated under the same id is an error. Rules
    that cannot be used on ``df`` are audited with their status and null hits. Counts
    are those of the tasks whose output stands, as rows are counted in the stage that writes them.
    """
    run_id = run_id or new_run_id()
    output = f"{out_path.rstrip('/')}/run_id={run_id}"
    states = bind_statuses(df, catalog, rule_ids, as_of, guard)
    usable = [at for at, res in states.items() if res.ok]
    met = "__met"
    while met in df.columns:
        met += "_"
    tagged = tag_all(df, catalog, usable, as_of=as_of, hits_col=met, guard=guard, as_array=True)
    seen = Observation()
    # Ids repeat where rules are told apart by address: each counts by its own place.
    named = [states[at].plan.rule_id for at in usable]
    counts = [F.count_if(F.array_contains(met, rid)).alias(f"h{i}") for i, rid in enumerate(named)]
    if len(set(named)) < len(named):
        raise ValueError(f"rules of one id in a run: {sorted({n for n in named if named.count(n) > 1})}")
    tagged = tagged.observe(seen, F.count(F.lit(1)).alias("n_rows"), *counts)
    kept = [F.col(f"`{c}`") for c in df.columns if c != hits_col]
    tagged.select(*kept, F.col(met).alias(hits_col)).write.parquet(output)
    found = seen.get
    hits = {rid: found[f"h{i}"] for i, rid in enumerate(named)}
    rules = [(res.rule_id, res.status.value, res.message, res.text if res.ok else "", hits.get(res.rule_id) if res.ok else None) for res in states.values()]
    row = df.sparkSession.createDataFrame([(_dt.datetime.now(_dt.timezone.utc), output, found["n_rows"], rules)], RUN_SCHEMA)
    row.coalesce(1).write.parquet(f"{audit_path.rstrip('/')}/run_id={run_id}")
    return AuditedRun(run_id, output, found["n_rows"], hits)


def read_runs(spark: SparkSession, audit_path: str, run_id: str | None = None) -> DataFrame:
    """(run_id, logged_at, output, n_rows, rule_id, status, message, predicate, n_hits) of all runs, or of one."""
    runs = spark.read.schema(f"{RUN_SCHEMA}, run_id string").parquet(audit_path)
    if run_id:
        runs = runs.filter(F.col("run_id") == run_id)
    return runs.select("run_id", "logged_at", "output", "n_rows", F.explode("rules").alias("r")).select("run_id", "logged_at", "output", "n_rows", "r.*")
