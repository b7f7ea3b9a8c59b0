"""Sinks (S5, S6) and rules on a stream."""

from conftest import AS_OF, SF_SMALL, catalog_of, cond, rule

from ruleloom import apply_rule, evaluate
from ruleloom.session import shared_path
from ruleloom.sources.readers import read_csv
from ruleloom.sources.sinks import append_audit, audit_frame, read_audit, write_csv
from ruleloom.streaming.stream import filter_stream, parquet_stream, run_to_parquet, tag_stream


def test_csv_round_trip_keeps_types_and_rows(spark, orders_small):
    path = write_csv(orders_small, shared_path(spark, "t-csv"))
    back = read_csv(spark, path, orders_small.schema)
    assert back.schema == orders_small.schema
    assert back.exceptAll(orders_small).count() == 0 and orders_small.exceptAll(back).count() == 0


def test_audit_append_and_read(spark):
    cat = catalog_of(spark, [rule("a", [cond("o_totalprice", ">=", "1")]), rule("b", [cond("x", "=", "1")], valid="false")])
    results = [evaluate(cat, "identification", "query_builder", r, "false", as_of=AS_OF) for r in ("a", "b", "zz")]
    path = shared_path(spark, "t-audit")
    append_audit(audit_frame(spark, results, "run1"), path, "run1")
    append_audit(audit_frame(spark, results[:1], "run2"), path, "run2")
    rows = sorted((r["rule_id"], r["status"], r["predicate"]) for r in read_audit(spark, path, "run1").collect())
    assert rows == [("a", "ok", "(o_totalprice) >= 1"), ("b", "off", ""), ("zz", "not_configured", "")]
    assert read_audit(spark, path).count() == 4


def test_stream_filter_equals_batch(spark):
    cat = catalog_of(spark, [rule("e", [cond("event_type", "=", "error", "AND"), cond("value", ">", "100")])])
    src = f"{SF_SMALL}/events.parquet"
    out = run_to_parquet(filter_stream(parquet_stream(spark, src), cat, "e", as_of=AS_OF), name="t-stream")
    batch = apply_rule(spark.read.parquet(src), cat, "e", as_of=AS_OF)
    got = spark.read.parquet(out)
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0


def test_stream_tagging(spark):
    cat = catalog_of(spark, [rule("e", [cond("event_type", "=", "error")]), rule("v", [cond("value", ">", "100")])])
    src = f"{SF_SMALL}/events.parquet"
    out = run_to_parquet(tag_stream(parquet_stream(spark, src), cat, ["e", "v"], as_of=AS_OF), name="t-tag")
    got = spark.read.parquet(out)
    ev = spark.read.parquet(src)
    assert got.filter("hits = 'e,v'").count() == ev.filter("event_type = 'error' and value > 100").count()


def test_stream_resumes_from_checkpoint_exactly_once(spark):
    """A restarted query continues from its checkpoint: new files only, no duplicates."""
    from pyspark.sql import functions as F

    cat = catalog_of(spark, [rule("e", [cond("event_type", "=", "error")])])
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = shared_path(spark, "t-stream-src")
    events.filter("ts < '2024-01-16'").write.parquet(f"{src}/part=a")  # first half of the month
    out, ckpt = shared_path(spark, "t-stream-out"), shared_path(spark, "t-stream-ckpt")

    def drain():
        stream = spark.readStream.schema(events.schema).parquet(f"{src}/*")
        run_to_parquet(filter_stream(stream, cat, "e", as_of=AS_OF), out, ckpt)

    drain()
    first = spark.read.parquet(out).count()
    events.filter("ts >= '2024-01-16'").write.parquet(f"{src}/part=b")  # the rest arrives later
    drain()
    got = spark.read.parquet(out)
    exp = events.filter("event_type = 'error'")
    assert 0 < first < got.count() == exp.count()
    assert got.groupBy("event_id").count().filter(F.col("count") > 1).count() == 0


def test_audit_runs_in_own_folders(spark):
    import os

    cat = catalog_of(spark, [rule("a", [cond("o_totalprice", ">=", "1")])])
    res = [evaluate(cat, "identification", "query_builder", "a", "false", as_of=AS_OF)]
    path = shared_path(spark, "t-audit-runs")
    for run in ("r1", "r2", "r3"):
        append_audit(audit_frame(spark, res, run), path, run)
    assert sorted(d for d in os.listdir(path.replace("file:", "")) if d.startswith("run_id=")) == \
        ["run_id=r1", "run_id=r2", "run_id=r3"]
    one = read_audit(spark, path, "r2")
    assert one.count() == 1 and one.first()["run_id"] == "r2"
    assert "PartitionFilters: [isnotnull(run_id" in one._jdf.queryExecution().executedPlan().toString()


def test_continuous_stream_with_processing_time_trigger(spark):
    from ruleloom.streaming.stream import start_to_parquet

    cat = catalog_of(spark, [rule("e", [cond("event_type", "=", "purchase")])])
    src = f"{SF_SMALL}/events.parquet"
    out, ckpt = shared_path(spark, "t-cont-out"), shared_path(spark, "t-cont-ckpt")
    query = start_to_parquet(filter_stream(parquet_stream(spark, src), cat, "e", as_of=AS_OF), out, ckpt,
                             every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == spark.read.parquet(src).filter("event_type = 'purchase'").count()


def test_stream_picks_up_edited_rules(spark):
    import json
    import os

    from ruleloom.streaming.stream import run_with_current_rules

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    base = shared_path(spark, "t-live-rules").replace("file:", "")
    os.makedirs(base)
    rules_file = os.path.join(base, "rules.json")

    def write_rules(event_type):
        with open(rules_file, "w") as f:
            json.dump({"rules": [rule("live", [cond("event_type", "=", event_type)])]}, f)

    src = shared_path(spark, "t-live-src")
    out, ckpt = shared_path(spark, "t-live-out"), shared_path(spark, "t-live-ckpt")
    events.filter("ts < '2024-01-16'").write.parquet(f"{src}/part=a")
    write_rules("error")
    stream = spark.readStream.schema(events.schema).parquet(f"{src}/*")
    run_with_current_rules(stream, rules_file, ["live"], out, ckpt, as_of=AS_OF)
    events.filter("ts >= '2024-01-16'").write.parquet(f"{src}/part=b")
    write_rules("click")  # the rule changes while the stream runs
    stream = spark.readStream.schema(events.schema).parquet(f"{src}/*")
    run_with_current_rules(stream, rules_file, ["live"], out, ckpt, as_of=AS_OF)
    got = spark.read.parquet(out)
    exp_a = events.filter("ts < '2024-01-16' and event_type = 'error'").count()
    exp_b = events.filter("ts >= '2024-01-16' and event_type = 'click'").count()
    assert got.count() == exp_a + exp_b
    assert {r[0] for r in got.select("event_type").distinct().collect()} == {"error", "click"}


def test_catalog_refresh_reads_edits(spark):
    import json
    import os

    from ruleloom import RuleCatalog, evaluate

    base = shared_path(spark, "t-refresh").replace("file:", "")
    os.makedirs(base)
    path = os.path.join(base, "rules.json")
    with open(path, "w") as f:
        json.dump({"rules": [rule("r", [cond("o_totalprice", ">=", "1")], valid="false")]}, f)
    cat = RuleCatalog.load(spark, path)
    assert evaluate(cat, "identification", "query_builder", "r", "false", as_of=AS_OF).status.value == "off"
    with open(path, "w") as f:
        json.dump({"rules": [rule("r", [cond("o_totalprice", ">=", "1")])]}, f)
    assert evaluate(cat, "identification", "query_builder", "r", "false", as_of=AS_OF).status.value == "off"
    assert evaluate(cat.refresh(), "identification", "query_builder", "r", "false", as_of=AS_OF).ok
