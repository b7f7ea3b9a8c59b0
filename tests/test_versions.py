"""Rules judged at each row's own time: tagging in one pass and the range join agree."""

import datetime as dt
import random

import pytest
from conftest import SF_SMALL, catalog_of, cond, rule
from pyspark.sql import functions as F

from ruleloom import RuleError, tpch
from ruleloom.operators.apply import apply_rule
from ruleloom.operators.versions import hits_in_force, in_force, tag_in_force, version_pieces, versions_frame
from ruleloom.streaming.stream import parquet_stream, run_to_parquet


def day(d):
    return dt.date.fromisoformat(d).strftime("%d/%m/%Y")


def version(rid, first, last, n, **kw):
    return rule(rid, [cond("n", ">=", str(n))], window=(day(first), day(last)), **kw)


RULES = [
    version("a", "2000-01-01", "2000-06-30", 1),
    version("a", "2000-04-01", "2001-12-31", 5),  # from July 2000, the first definition wins before
    version("a", "2000-08-01", "2000-08-31", 9, valid="false"),  # switched off: no version
    version("b", "1900-01-01", "9999-12-31", 3),
    rule("c", [cond("n", "<=", "8")], ("goto", "a"), window=(day("2000-03-01"), day("2002-12-31"))),
    rule("bad", [cond("n", "<=", "8")], window=("no date", "31/12/2999")),
]


@pytest.fixture(scope="module")
def cat(spark):
    return catalog_of(spark, RULES)


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(12), dt.datetime(1999, 12, 1) + dt.timedelta(days=rng.randrange(1200), minutes=rng.randrange(1440))) for i in range(500)]
    rows += [(600, 9, None), (601, 9, dt.datetime(1800, 1, 1)), (602, 9, dt.datetime(9999, 12, 31, 23)), (603, 9, dt.datetime(1900, 1, 1)), (604, 9, dt.datetime(2000, 6, 30, 23, 59, 59))] * 2
    return spark.createDataFrame(rows, "id int, n int, `at.time` timestamp_ntz").repartition(3)


def expected(rows):
    def a(n, d):
        if dt.date(2000, 1, 1) <= d <= dt.date(2000, 6, 30):
            return n >= 1
        return dt.date(2000, 4, 1) <= d <= dt.date(2001, 12, 31) and n >= 5

    out = []
    for r in rows:
        d = r["at.time"].date() if r["at.time"] else None
        found = []
        if d and a(r["n"], d):
            found.append("a")
        if d and d >= dt.date(1900, 1, 1) and r["n"] >= 3:
            found.append("b")
        if d and dt.date(2000, 3, 1) <= d and r["n"] <= 8 and a(r["n"], d):
            found.append("c")
        out.append((r["id"], found))
    return sorted(out)


def test_both_ways_give_what_the_versions_say(spark, cat, facts):
    ids = ["a", "b", "c", "bad"]
    exp = expected(facts.collect())
    tagged = tag_in_force(facts, cat, ids, "at.time", as_array=True)
    assert sorted((r["id"], r["hits"]) for r in tagged.collect()) == exp
    assert sorted((r["id"], r["hits"]) for r in tag_in_force(facts, cat, ids, "at.time").collect()) == [(i, ",".join(h)) for i, h in exp]
    long = hits_in_force(facts.withColumn("rule_id", F.lit("own")), cat, ids, "at.time")
    assert long.columns == ["id", "n", "at.time", "rule_pos", "rule_id", "valid_from", "valid_till"]
    assert sorted((r["id"], r["rule_id"]) for r in long.collect()) == sorted((i, h) for i, hs in exp for h in hs)
    assert tag_in_force(facts.limit(0), cat, ids, "at.time").count() == 0 and hits_in_force(facts.limit(0), cat, ids, "at.time").count() == 0


def test_pieces_are_disjoint_and_follow_the_chain(cat):
    pieces = [(p.rule_id, p.first, p.last) for p in version_pieces(cat, ["a", "b", "c", "bad"])]
    assert pieces == [
        ("a", dt.date(2000, 1, 1), dt.date(2000, 6, 30)), ("a", dt.date(2000, 7, 1), dt.date(2001, 12, 31)), ("b", dt.date(1900, 1, 1), dt.date(9999, 12, 31)),
        ("c", dt.date(2000, 3, 1), dt.date(2000, 6, 30)), ("c", dt.date(2000, 7, 1), dt.date(2001, 12, 31)),
    ]


def test_one_day_agrees_with_the_call_as_of_that_day(spark, cat, facts):
    on = facts.filter("to_date(`at.time`) = date'2000-05-05' or id = 604").withColumn("at.time", F.lit(dt.datetime(2000, 5, 5, 12)).cast("timestamp_ntz"))
    hits = tag_in_force(on, cat, ["a"], "at.time", as_array=True).filter(F.size("hits") == 1).count()
    assert hits == apply_rule(on, cat, "a", as_of=dt.date(2000, 5, 5)).count() > 0


def test_broken_versions_and_unknown_rules_raise(spark):
    cat = catalog_of(spark, [rule("r", [cond("n", "~", "1")]), rule("loop", [cond("n", "=", "1")], ("goto", "loop"))])
    for rid, status in (("r", "bad_operator"), ("loop", "goto_cycle"), ("none", "not_configured")):
        with pytest.raises(RuleError) as found:
            version_pieces(cat, [rid])
        assert found.value.status.value == status


def test_range_join_over_windows_of_all_lengths(spark):
    rng = random.Random(2)
    windows = [(i, dt.date(1990, 1, 1) + dt.timedelta(days=rng.randrange(-9000, 9000)), rng.choice([0, 1, 40, 2047, 2048, 2049, 140_000])) for i in range(120)]
    windows = [(i, a, a + dt.timedelta(days=n)) for i, a, n in windows] + [(900, dt.date(2000, 1, 1), dt.date(1999, 1, 1)), (901, None, dt.date(2000, 1, 1)), (902, dt.date(2000, 1, 1), None)]
    days = [dt.date(1990, 1, 1) + dt.timedelta(days=rng.randrange(-12000, 12000)) for _ in range(200)] + [windows[0][1], windows[0][2], None]
    v = spark.createDataFrame(windows, "w int, valid_from date, valid_till date")
    rows = spark.createDataFrame(list(enumerate(days)), "id int, d date")
    got = in_force(rows, v, "d")
    assert sorted((r["id"], r["w"]) for r in got.collect()) == sorted((i, w) for i, d in enumerate(days) for w, a, b in windows if d and a and b and a <= d <= b)
    with pytest.raises(ValueError, match="both"):
        in_force(rows.withColumnRenamed("id", "W"), v, "d")


def test_no_cross_join_in_the_plan(spark):
    cat = catalog_of(spark, [])
    cat = type(cat).from_json(spark, tpch.versioned_rules(24))
    plan = hits_in_force(spark.read.parquet(f"{SF_SMALL}/orders.parquet"), cat, cat.all_ids(), "o_orderdate")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" in plan and plan.count("Scan parquet") == 1


def test_rows_stay_where_they_are_and_are_judged_once(spark):
    """The rules' pieces are a table of known size: it goes to the rows, which are not shuffled."""
    cat = catalog_of(spark, [])
    cat = type(cat).from_json(spark, tpch.versioned_rules(24))
    orders = spark.createDataFrame([(1, 250_000.0, "2-HIGH", dt.datetime(1996, 5, 5))], "o_orderkey long, o_totalprice double, o_orderpriority string, o_orderdate timestamp_ntz")
    plan = hits_in_force(orders, cat, cat.all_ids(), "o_orderdate")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert plan.count("ArrowEvalPython") == 1


def test_more_rules_than_a_word_has_bits(spark):
    rules = [version(f"r{i}", "2000-01-01", "2000-12-31", i) for i in range(130)]
    cat = catalog_of(spark, rules)
    rows = spark.createDataFrame([(n, dt.date(2000, 1, 1) if n != 64 else None) for n in (-1, 0, 62, 63, 64, 65, 127, 128, 129, None)], "n int, d date")
    got = hits_in_force(rows, cat, cat.all_ids(), "d")
    assert sorted((r["n"], r["rule_pos"]) for r in got.collect()) == [(n, i) for n in (0, 62, 63, 65, 127, 128, 129) for i in range(n + 1)]
    assert {r["rule_id"] == f"r{r['rule_pos']}" and r["valid_from"] == dt.date(2000, 1, 1) and r["valid_till"] == dt.date(2000, 12, 31) for r in got.collect()} == {True}


def test_rules_without_a_version_have_no_hits(spark, cat, facts):
    got = hits_in_force(facts, cat, ["bad"], "at.time")
    assert got.columns[-4:] == ["rule_pos", "rule_id", "valid_from", "valid_till"] and got.count() == 0
    assert versions_frame(cat, ["bad"]).dtypes == [("rule_pos", "int"), ("rule_id", "string"), ("valid_from", "date"), ("valid_till", "date")]


def test_streams_meet_the_same_versions(spark, cat, facts, tmp_path):
    """The tag and the stream-static join on a drained stream equal the batch's."""
    ids = ["a", "b", "c"]
    facts.write.parquet(f"{tmp_path}/facts")
    stream = parquet_stream(spark, f"{tmp_path}/facts", like=facts, max_files=1)
    tagged = spark.read.parquet(run_to_parquet(tag_in_force(stream, cat, ids, "at.time"), f"{tmp_path}/tagged"))
    assert sorted(map(tuple, tagged.collect()), key=str) == sorted(map(tuple, tag_in_force(facts, cat, ids, "at.time").collect()), key=str)
    joined = spark.read.parquet(run_to_parquet(in_force(stream, versions_frame(cat, ids), "at.time"), f"{tmp_path}/joined"))
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, in_force(facts, versions_frame(cat, ids), "at.time").collect()), key=str)
