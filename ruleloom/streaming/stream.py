"""Rules on streaming DataFrames.

A compiled rule is an ordinary Column, so the same filter / tag plans run
unchanged under Structured Streaming: rows are judged one micro-batch at a
time and nothing is kept in state. Progress lives in a checkpoint below the
cluster's shared folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.actions import tag_all
from ..operators.apply import apply_rule
from ..session import shared_path


def parquet_stream(spark: SparkSession, path: str, like: DataFrame | None = None, max_files: int | None = None) -> DataFrame:
    """A file stream over parquet at ``path``; the schema is taken from ``like``
    (or from a static read of the same path)."""
    schema = (like if like is not None else spark.read.parquet(path)).schema
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(_as_glob(path))


def _as_glob(path: str) -> str:
    """A file stream source must be a folder or a glob; a single parquet file
    (``…/events.parquet``, a folder or a file) is read as ``…/{events.parquet}``,
    a glob matching exactly itself."""
    if any(ch in path for ch in "*?[{"):
        return path
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/{{{name}}}" if name else path


def filter_stream(stream: DataFrame, catalog, rule_ids, as_of=None, guard: bool = False) -> DataFrame:
    """Apply rules (stages in order) to a streaming DataFrame."""
    out = stream
    for rid in [rule_ids] if isinstance(rule_ids, str) else rule_ids:
        out = apply_rule(out, catalog, rid, as_of=as_of, guard=guard)
    return out


def tag_stream(stream: DataFrame, catalog, rule_ids, as_of=None, hits_col: str = "hits") -> DataFrame:
    return tag_all(stream, catalog, rule_ids, as_of=as_of, hits_col=hits_col)


def checkpoint_of(out_path: str) -> str:
    """The progress folder that belongs to an output folder (readers skip names with ``_``).

    Bound to the output, a later run over the same output goes on where the
    earlier one stopped: it neither loses new rows nor repeats old ones.
    """
    return f"{out_path.rstrip('/')}/_checkpoint"


def run_to_parquet(stream: DataFrame, out_path: str | None = None, checkpoint: str | None = None,
                   name: str = "rules") -> str:
    """Drain everything available into parquet (append), then stop.

    ``availableNow`` processes the backlog in bounded micro-batches; the
    checkpoint makes the run restartable after an executor or driver loss.
    """
    spark = stream.sparkSession
    out_path = out_path or shared_path(spark, f"stream-out-{name}")
    checkpoint = checkpoint or checkpoint_of(out_path)
    query = (
        stream.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return out_path


def start_to_parquet(stream: DataFrame, out_path: str | None = None, checkpoint: str | None = None,
                     name: str = "rules", every: str = "1 minute"):
    """Run continuously: a micro-batch every ``every``, appended to parquet.

    Returns the ``StreamingQuery`` (stop it with ``.stop()``); the checkpoint
    lets a restarted query continue where this one stopped.
    """
    spark = stream.sparkSession
    out_path = out_path or shared_path(spark, f"stream-out-{name}")
    checkpoint = checkpoint or checkpoint_of(out_path)
    return (
        stream.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=every)
        .start()
    )


def run_with_current_rules(stream: DataFrame, rules_path: str, rule_ids, out_path: str | None = None,
                           checkpoint: str | None = None, as_of=None, name: str = "rules",
                           every: str | None = None):
    """Apply rules that may change while the stream runs.

    Every micro-batch reloads the rule document (one small job) and applies
    ``rule_ids`` as stages, with the validity window checked on the batch's
    day when ``as_of`` is None. Each batch is written to its own
    ``epoch=<id>`` folder with overwrite, so a retried batch replaces its own
    output: results stay exactly-once. A rule that is off, expired or broken
    when a batch begins ends the query with its status as the error, and the
    batch is judged anew after a restart: no row passes unjudged. ``every=None`` drains what is
    available and stops; otherwise the query keeps running (returned).
    """
    from ..plans.catalog import RuleCatalog

    spark = stream.sparkSession
    out_path = out_path or shared_path(spark, f"stream-out-{name}")
    checkpoint = checkpoint or checkpoint_of(out_path)
    ids = [rule_ids] if isinstance(rule_ids, str) else list(rule_ids)

    def batch(df: DataFrame, epoch_id: int) -> None:
        catalog = RuleCatalog.load(df.sparkSession, rules_path)
        out = df
        for rid in ids:
            out = apply_rule(out, catalog, rid, as_of=as_of)
        out.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if every is None:
        writer.trigger(availableNow=True).start().awaitTermination()
        return out_path
    return writer.trigger(processingTime=every).start()
