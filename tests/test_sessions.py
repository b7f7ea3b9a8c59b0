"""Sessions and stretches against plain loops; sessions of a stream against the batch's."""

import datetime as dt
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ruleloom.operators.sessions import sessions, stretches
from ruleloom.streaming.sessions import sessions_to_parquet
from ruleloom.streaming.stream import parquet_stream

START = dt.datetime(2024, 3, 9)


def events(seed, n):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), START + dt.timedelta(minutes=rng.randrange(6000)), rng.choice([1.25, 2.5, -1.0, None])) for _ in range(n)]
    # A hot key whose sessions run over several days, pauses of exactly 30 minutes, repeated rows, rows without a time.
    rows += [("hot", START + dt.timedelta(minutes=30 * i), 1.0) for i in range(200)] + [("hot", START + dt.timedelta(minutes=31 * i + 7000), 0.5) for i in range(50)]
    rows += [("same", START, 2.0)] * 30 + [("none", None, 1.0)] * 3 + [("old", dt.datetime(1969, 12, 31, 23, 59, 59, 999999), 1.0), ("old", dt.datetime(1970, 1, 1), 1.0)]
    return rows


def frame(spark, rows, kind="timestamp_ntz"):
    return spark.createDataFrame(rows, "`the key` string, at timestamp_ntz, v double").withColumn("at", F.col("at").cast(kind)).withColumn("n", F.lit("own"))


def by_key(rows):
    out = {}
    for k, t, v in rows:
        if t is not None:
            out.setdefault(k, []).append((t, v))
    return {k: sorted(x, key=lambda r: r[0]) for k, x in out.items()}


def total(values):
    known = [v for v in values if v is not None]
    return round(sum(known), 6) if known else None


def plain_sessions(rows, gap):
    out = []
    for k, x in by_key(rows).items():
        runs = []
        for t, v in x:
            if runs and t - runs[-1][-1][0] <= dt.timedelta(minutes=gap):
                runs[-1].append((t, v))
            else:
                runs.append([(t, v)])
        out += [(k, r[0][0], r[-1][0], len(r), total(v for _, v in r)) for r in runs]
    return sorted(out, key=str)


def found(df):
    return sorted(((r["the key"], r["session_start"], r["session_end"], r["n_events"], None if r["total_amount"] is None else round(r["total_amount"], 6)) for r in df.collect()), key=str)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("gap,piece", [(30, 1440), (30, 7), (0, 60), (5.5, 45)])
def test_sessions_match_a_plain_loop(spark, kind, gap, piece):
    rows = events(3, 300)
    got = sessions(frame(spark, rows, kind).repartition(3), ["the key"], "at", "v", gap, piece)
    assert got.columns == ["the key", "session_start", "session_end", "n_events", "total_amount", "minutes"]
    assert found(got) == plain_sessions(rows, gap)


def test_no_task_gets_a_hot_key_whole(spark):
    """The rows are dealt by key and piece; what is dealt by key alone are at most two runs a piece."""
    df = spark.range(40_000).select(F.expr("id div 1000000").alias("k"), (F.lit(START).cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, cast(id as int), 0)")).alias("at"), F.lit(1.0).alias("v"))
    plan = sessions(df, ["k"], "at", "v", 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k0#" in plan and "piece#" in plan
    assert sessions(df, ["k"], "at", "v", 0.5).count() == 40_000
    assert sessions(df, ["k"], "at", "v", 1).first()["n_events"] == 40_000


@pytest.mark.parametrize("minutes,piece,least", [(30, 360, 1), (30, 10, 2), (0, 60, 1), (90, 45, 3)])
def test_stretches_match_a_plain_loop(spark, minutes, piece, least):
    rows = events(4, 200)
    exp = []
    for k, x in by_key(rows).items():
        for t, _ in x:
            near = [v for u, v in x if t - dt.timedelta(minutes=minutes) <= u <= t]
            if len(near) >= least:
                exp.append((k, t, len(near), total(near)))
    got = stretches(frame(spark, rows), ["the key"], "at", "v", minutes, least, piece)
    assert sorted(((r[0], r[1], r[2], None if r[3] is None else round(r[3], 6)) for r in got.collect()), key=str) == sorted(exp, key=str)


def test_nothing_gives_nothing(spark):
    empty = frame(spark, []).limit(0)
    assert sessions(empty, ["the key"], "at", "v", 30).count() == 0 and stretches(empty, ["the key"], "at", "v", 30).count() == 0


def written(spark, rows, path, cuts):
    """One file per stretch of time, in order, as a stream would get them."""
    ordered = sorted((r for r in rows if r[1] is not None), key=lambda r: r[1])
    size = -(-len(ordered) // cuts)
    for i in range(0, len(ordered), size):
        frame(spark, ordered[i : i + size]).coalesce(1).write.mode("append").parquet(path)


def test_a_drained_stream_equals_the_batch(spark, tmp_path):
    rows = events(5, 300)
    written(spark, rows, f"{tmp_path}/in", 4)
    stream = parquet_stream(spark, f"{tmp_path}/in", max_files=1)
    run = sessions_to_parquet(stream, ["the key"], "at", "v", 30, 60, f"{tmp_path}/out", close=True)
    assert run.late_rows == 0
    assert found(spark.read.parquet(run.path)) == plain_sessions(rows, 30)


def test_a_run_goes_on_and_closed_sessions_are_written_once(spark, tmp_path):
    """Half of the files, a restart with the other half, then a late row."""
    rows = sorted((r for r in events(6, 300) if r[1] is not None and r[0] != "old"), key=lambda r: r[1])
    half = len(rows) // 2
    written(spark, rows[:half], f"{tmp_path}/in", 2)
    stream = parquet_stream(spark, f"{tmp_path}/in", max_files=1)
    first = sessions_to_parquet(stream, ["the key"], "at", "v", 30, 60, f"{tmp_path}/out")
    closed = found(spark.read.parquet(first.path))
    assert set(closed) <= set(plain_sessions(rows, 30)) and len(closed) < len(plain_sessions(rows[:half], 30))
    again = sessions_to_parquet(stream, ["the key"], "at", "v", 30, 60, f"{tmp_path}/out")
    assert found(spark.read.parquet(again.path)) == closed
    written(spark, rows[half:], f"{tmp_path}/in", 2)
    sessions_to_parquet(stream, ["the key"], "at", "v", 30, 60, f"{tmp_path}/out", close=True)
    assert found(spark.read.parquet(f"{tmp_path}/out")) == plain_sessions(rows, 30)
    written(spark, [("late", START, 1.0)], f"{tmp_path}/in", 1)
    assert sessions_to_parquet(stream, ["the key"], "at", "v", 30, 60, f"{tmp_path}/out").late_rows == 1
    assert found(spark.read.parquet(f"{tmp_path}/out")) == plain_sessions(rows, 30)


def test_given_events(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert sessions(ev, ["user_id"], "ts", "value", 30).agg(F.sum("n_events")).first()[0] == ev.count()
