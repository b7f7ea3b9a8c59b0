"""Places, top rows and exact statistics against plain sorting, with hot keys, ties and nulls."""

import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ruleloom.operators.ranking import PARTS, exact_statistics, row_positions, top_k


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    made = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-5, 6)]), rng.random(), i) for i in range(600)]
    return made + [("hot", 3, 0.5, 1000)] * 300 + [("none", None, 0.1, 2000), ("one", 4, 0.2, 2001)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "`k.y` string, v int, d double, id int").withColumn("position", F.lit("own")).withColumn("rank", F.lit("own")).repartition(6)


def low_first(x):
    return (x is not None, x if x is not None else 0)


def test_positions_are_those_of_a_sort(spark, df, rows):
    got = row_positions(df, ["v", "-d", "id"])
    assert got.columns == ["k.y", "v", "d", "id", "rank", "position"]
    found = sorted((r["position"], r["v"], r["d"], r["id"]) for r in got.collect())
    exp = sorted(rows, key=lambda r: (low_first(r[1]), -r[2], r[3]))
    assert found == [(i + 1, r[1], r[2], r[3]) for i, r in enumerate(exp)]
    assert row_positions(df.limit(0), ["v"]).count() == 0


def test_positions_need_no_window_over_the_table(df):
    plan = row_positions(df, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "NestedLoop" not in plan


def test_equal_rows_are_dealt_over_ranges(spark):
    same = spark.range(5000).select(F.lit(1).alias("x"))
    got = row_positions(same, ["x"])
    assert sorted(r["position"] for r in got.collect()) == list(range(1, 5001))


@pytest.mark.parametrize("k", [1, 7, 2000])
def test_top_rows_of_every_key(df, rows, k):
    got = top_k(df, ["k.y"], ["-v", "id", "d"], k)
    exp = []
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, -(r[1] or 0), r[3], r[2]))[:k]
        exp += [(key, r[1], r[3], n + 1) for n, r in enumerate(mine)]
    assert sorted(((r["k.y"], r["v"], r["id"], r["rank"]) for r in got.collect()), key=str) == sorted(exp, key=str)
    assert top_k(df.limit(0), ["k.y"], ["v"], k).count() == 0


def test_a_hot_key_is_cut_before_it_is_brought_together(spark):
    """The last window gets at most PARTS * k rows of the key."""
    hot = spark.range(20_000).select(F.expr("id div 1000000").alias("k"), F.xxhash64("id").alias("v"))
    plan = top_k(hot, ["k"], ["v"], 3000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("row_number") >= 2 and "part#" in plan
    assert top_k(hot, ["k"], ["v"], 5).count() == 5 and PARTS * 5 < 20_000
    with pytest.raises(ValueError):
        top_k(hot, ["k"], ["v"], 0)


@pytest.mark.parametrize("value", ["v", "d"])
def test_statistics_match_plain_ones(df, rows, value):
    at = {"v": 1, "d": 2}[value]
    got = {r["k.y"]: r for r in exact_statistics(df, ["k.y"], value).collect()}
    assert set(got) == {r[0] for r in rows}
    for key, r in got.items():
        mine = [x[at] for x in rows if x[0] == key]
        known = [x for x in mine if x is not None]
        assert (r["n_rows"], r["n_values"], r["n_distinct"]) == (len(mine), len(known), len(set(known)))
        if not known:
            assert r["mode"] is None and r["median"] is None and r["median_low"] is None
            continue
        many = Counter(known)
        assert r["mode"] == min(x for x in many if many[x] == max(many.values()))
        assert (r["median_low"], r["median_high"]) == (statistics.median_low(known), statistics.median_high(known))
        assert r["median"] == pytest.approx(statistics.median(known))


def test_statistics_of_texts_several_keys_and_nothing(spark, df):
    got = exact_statistics(df.withColumn("t", F.col("v").cast("string")), ["k.y", "rank"], "t")
    assert "median" not in got.columns
    assert {(r["k.y"], r["median_low"]) for r in got.collect()} >= {("hot", "3"), ("one", "4"), ("none", None)}
    assert exact_statistics(df.limit(0), ["k.y"], "v").count() == 0
    with pytest.raises(ValueError):
        exact_statistics(df, [], "v")


def test_no_list_of_a_key_in_the_plan(df):
    plan = exact_statistics(df, ["k.y"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "collect_" not in plan and "percentile" not in plan and "ObjectHashAggregate" not in plan
