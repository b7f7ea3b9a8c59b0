"""Session helpers: a local session for tests/bench and the shared folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(set by the cluster). Only when it is unset (local tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ruleloom") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # no Python call-site capture on every Column operation (only feeds
        # error messages); plan building for many rules is py4j-bound
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared working folder (``spark.checkpoint.dir``).

    Read from the session. If it is unset, a local session (one machine, as in
    tests) gets a fresh folder, registered as the checkpoint dir so that later
    calls agree; on a cluster that would be each machine's own disk, so it is
    an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="ruleloom-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared folder; ``unique`` appends a fresh suffix."""
    base = shared_dir(spark).rstrip("/")
    tail = "/".join(p.strip("/") for p in parts if p)
    if unique:
        tail = f"{tail}-{uuid.uuid4().hex[:12]}" if tail else uuid.uuid4().hex[:12]
    return f"{base}/{tail}" if tail else base


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: computed once, whatever reads it or gets lost later."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
