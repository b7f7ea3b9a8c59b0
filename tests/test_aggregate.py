"""Grouped checks (A1–A3) against a pandas brute force."""

import pandas as pd
import pytest
from conftest import AS_OF, SF_SMALL, catalog_of, lookup, rule

from pyspark.sql import functions as F

from ruleloom import RuleError, exact_sum, group_lookup, time_span


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_group_lookup_matches_pandas(spark, orders_small):
    cat = catalog_of(spark, [rule("g", [lookup(" group by o_custkey ")], key="groupby_lookup", lookup="true",
                                  process="filtration")])
    out = group_lookup(orders_small, cat, "g", {"n": F.count(F.lit(1)), "total": exact_sum("o_totalprice")}, as_of=AS_OF)
    got = {r["o_custkey"]: (r["n"], r["total"]) for r in out.collect()}
    pdf = orders_small.toPandas()
    exp = pdf.groupby("o_custkey").agg(n=("o_totalprice", "size"), total=("o_totalprice", "sum"))
    assert len(got) == len(exp)
    for k, row in exp.iterrows():
        assert got[k][0] == row["n"] and got[k][1] == pytest.approx(row["total"], abs=1e-6)


def test_group_lookup_two_keys_and_errors(spark, orders_small):
    cat = catalog_of(spark, [
        rule("g2", [lookup("GROUP BY o_orderstatus, substr(o_orderpriority, 1, 1)")], key="groupby_lookup",
             lookup="true", process="filtration"),
        rule("gbad", [lookup("order by x")], key="groupby_lookup", lookup="true", process="filtration"),
    ])
    out = group_lookup(orders_small, cat, "g2", [F.count(F.lit(1)).alias("n")], as_of=AS_OF)
    assert out.count() == orders_small.select("o_orderstatus", F.substring("o_orderpriority", 1, 1)).distinct().count()
    with pytest.raises(RuleError):
        group_lookup(orders_small, cat, "g2", [], as_of=AS_OF)
    with pytest.raises(RuleError):
        group_lookup(orders_small, cat, "gbad", [F.count(F.lit(1))], as_of=AS_OF)


def test_time_span_matches_brute_force(events):
    out = time_span(events, ["user_id"], "ts", "value", 30, per_day=True, min_events=2, order=True)
    got = [(r["user_id"], r["day"], r["n_events"], r["minutes"]) for r in out.collect()]
    pdf = events.select("user_id", "ts", "value").toPandas()
    pdf["day"] = pdf["ts"].dt.date
    exp = []
    for (u, d), g in pdf.groupby(["user_id", "day"]):
        span = (g["ts"].max() - g["ts"].min()) / pd.Timedelta(minutes=1)
        if len(g) >= 2 and span <= 30:
            exp.append((u, d, len(g), span))
    exp.sort()
    assert [(a, b, c) for a, b, c, _ in got] == [(a, b, c) for a, b, c, _ in exp]
    for g, e in zip(got, exp):
        assert g[3] == pytest.approx(e[3], abs=1e-9)


def test_time_span_without_day(events):
    out = time_span(events, ["user_id", "event_type"], "ts", "value", 60 * 24 * 40, per_day=False)
    # every (user, type) group with 2+ events spans less than 40 days of January
    exp = events.groupBy("user_id", "event_type").count().filter("count >= 2").count()
    assert out.count() == exp


def test_time_span_ignores_session_zone_for_wall_clock_times(spark):
    import datetime as dt

    from pyspark.sql import types as T

    rows = [(1, dt.datetime(2024, 3, 10, 1, 50), 1.0), (1, dt.datetime(2024, 3, 10, 3, 10), 2.0),
            (2, dt.datetime(2024, 3, 10, 1, 0, 0, 250000), 1.0), (2, dt.datetime(2024, 3, 10, 1, 20), 1.5)]
    schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("v", T.DoubleType())])
    df = spark.createDataFrame(rows, schema)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["UTC", "America/New_York"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = {r["u"]: r["minutes"] for r in time_span(df, ["u"], "ts", "v", 1000).collect()}
            assert got[1] == 80.0  # wall clock: 01:50 -> 03:10, whatever the zone's DST jump
            assert got[2] == pytest.approx(19.995833333333334)
            assert [r["u"] for r in time_span(df, ["u"], "ts", "v", 30).collect()] == [2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_group_lookup_warns_on_holistic_aggregates(spark, orders_small):
    cat = catalog_of(spark, [rule("g", [lookup(" group by o_orderstatus")], key="groupby_lookup", lookup="true",
                                  process="filtration")])
    with pytest.warns(UserWarning, match="collect_list"):
        group_lookup(orders_small, cat, "g", {"keys": F.collect_list("o_orderkey")}, as_of=AS_OF)
    import warnings as _w

    with _w.catch_warnings():
        _w.simplefilter("error")
        group_lookup(orders_small, cat, "g", {"n": F.count(F.lit(1)), "a": F.percentile_approx("o_totalprice", 0.5)},
                     as_of=AS_OF)
