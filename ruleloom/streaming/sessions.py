"""Sessions of a stream (A2 with state): the pause rule of :func:`..operators.sessions.sessions` under a watermark.

Open sessions are Spark's keyed state; a session is written once, when the
watermark (the latest time seen less ``late_minutes``) has passed its end by
more than the pause, and its state is dropped then. The state so holds no more than the
sessions of the last ``gap + late`` minutes. A row that comes after its time has been
passed by the watermark is late: it is not counted, and the run says how many there were.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregate import epoch_micros, minutes_between
from ..session import shared_path
from .stream import checkpoint_of

_MINUTE = 60_000_000
#: Beyond all event times.
_END = _dt.datetime(9999, 1, 1, tzinfo=_dt.timezone.utc)


@dataclass(frozen=True)
class SessionRun:
    """Where the sessions are, and the rows that came too late to be in one."""

    path: str
    late_rows: int


def sessions_stream(stream: DataFrame, keys: list[str], time_col: str, amount_col: str, gap_minutes: float, late_minutes: float,
                    closing: DataFrame | None = None) -> DataFrame:
    """The streaming aggregation: the columns of ``sessions``, each session once it is closed.

    ``closing`` is a stream of (instant timestamp): a row of it moves the watermark
    and belongs to no session. Times without a zone are taken as they are.
    """
    kind = stream.schema[time_col].dataType
    time = F.col(f"`{time_col}`")
    own = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    instant = F.timestamp_micros(epoch_micros(time, kind))
    rows = stream.filter(time.isNotNull()).select(*own, instant.alias("instant"), time.alias("time"), F.col(f"`{amount_col}`").alias("amount"), F.lit(False).alias("closing"))
    if closing is not None:
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name not in ("instant", "closing")]
        rows = rows.unionByName(closing.select("instant", *empty, F.lit(True).alias("closing")))
    pause = f"{round(gap_minutes * _MINUTE) + 1} microseconds"  # as long a pause as ``gap`` does not end a session
    names = [f"k{i}" for i in range(len(keys))]
    grouped = rows.withWatermark("instant", f"{round(late_minutes * _MINUTE)} microseconds").groupBy(*names, F.session_window("instant", pause))
    found = grouped.agg(F.min("time").alias("start"), F.max("time").alias("end"), F.count_if(~F.col("closing")).alias("n_events"), F.sum("amount").alias("total_amount"))
    # On counts, so that the rows of ``closing`` are not dropped before they move the watermark.
    return found.filter(F.col("n_events") > 0).select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)],
        F.col("start").alias("session_start"), F.col("end").alias("session_end"), "n_events", "total_amount",
        minutes_between(F.col("start"), F.col("end"), kind).alias("minutes"),
    )


def sessions_to_parquet(stream: DataFrame, keys: list[str], time_col: str, amount_col: str, gap_minutes: float, late_minutes: float,
                        out_path: str | None = None, close: bool = False) -> SessionRun:
    """Drain what is available into parquet and stop; a later run over the same ``out_path`` goes on.

    State and progress lie beside the output, in the shared folder: a run that was
    cut off is taken up where it stopped. With ``close`` the sessions still open are
    written too and the output is final: rows that come later are late.
    """
    spark = stream.sparkSession
    out_path = out_path or shared_path(spark, "sessions")
    marks = f"{out_path.rstrip('/')}-closing"
    schema = T.StructType([T.StructField("instant", T.TimestampType())])
    spark.createDataFrame([], schema).write.mode("append").parquet(marks)
    found = sessions_stream(stream, keys, time_col, amount_col, gap_minutes, late_minutes, spark.readStream.schema(schema).parquet(marks))
    late = _drain(found, out_path)
    if close:
        spark.createDataFrame([(_END,)], schema).coalesce(1).write.mode("append").parquet(marks)
        late += _drain(found, out_path)
    return SessionRun(out_path, late)


def _drain(found: DataFrame, out_path: str) -> int:
    query = found.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint_of(out_path)).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
