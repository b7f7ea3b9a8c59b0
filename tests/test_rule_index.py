"""The index over many rules against the rules' own predicates."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import AS_OF, SF_SMALL, catalog_of, cond, lookup, rule
from pyspark.sql import functions as F

from ruleloom import RuleError, rule_hit_counts, tag_all, tpch
from ruleloom.operators import actions
from ruleloom.operators.rule_index import RuleIndex

SCHEMA = "n int, big bigint, d double, f float, m decimal(12,2), s string, code string, day date, at timestamp_ntz, inst timestamp, ok boolean, `odd.name` string"
VALUES = {
    "n": ["5", "-3", "7.5", "7.0", "99999999999999999999", "1e1", "0"],
    "big": ["5", str(2**62), "-0.5"],
    "d": ["1.5", "0", "-0.0", "1e300", "12345678901234567890123", "2"],
    "f": ["1.5", "0.1"],
    "m": ["10.25", "3"],
    "s": ["b", "é", "", "B", "z,z", "7x"],
    "code": ["36", "0036", "100000000000000000000", "AUD"],
    "day": ["2021-05-05", "1960-01-01"],
    "at": ["2021-05-05", "2021-05-05 10:00", "2021-05-05T10:00:00.1234567"],
    "inst": ["2021-05-05 10:00:00"],
    "ok": ["true", "false"],
    "n + big": ["10", "4.5"],
    "upper(s)": ["B", "É"],
}


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(6)
    day = [dt.date(2021, 5, 5), dt.date(1960, 1, 1), dt.date(2030, 1, 1), None]
    at = [dt.datetime(2021, 5, 5), dt.datetime(2021, 5, 5, 10), dt.datetime(2021, 5, 5, 10, 0, 0, 123456), None]
    rows = [(
        rng.choice([5, -3, 7, 8, 0, None]), rng.choice([5, 2**62, 0, -1, None]), rng.choice([1.5, 0.0, -0.0, float("nan"), float("inf"), 2.0, 1e300, 12345678901234567890123.0, None]),
        rng.choice([1.5, 0.1, None]), rng.choice([Decimal("10.25"), Decimal("3.00"), Decimal("4.10"), None]), rng.choice(["b", "B", "é", "z,z", "", "\U0001f600", "￿", "7x", None]),
        rng.choice(["36", "0036", "AUD", "", "100000000000000000000", None]), rng.choice(day), rng.choice(at), rng.choice(at), rng.choice([True, False, None]), "x",
    ) for _ in range(400)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def random_rules(n):
    rng = random.Random(13)
    rules = []
    for i in range(n):
        many = rng.choice([1, 1, 2, 3, 12])
        when = []
        for k in range(many):
            name = rng.choice(list(VALUES))
            ops = ["=", "==", "<=>", "!=", "<>", "<", "<=", ">", ">="] if name != "ok" else ["=", "!="]
            if name in ("s", "code", "n"):
                ops += ["LIKE", "NOT LIKE", "rlike", "ilike"]
            value = rng.choice(VALUES[name])
            when.append(cond(name, rng.choice(ops), value, rng.choice(["AND", "OR"]) if k + 1 < many else ""))
        rules.append(rule(f"r{i}", when, ("flag", "x")))
    return rules


def test_index_agrees_with_predicates(spark, mixed, monkeypatch):
    rules = random_rules(150)
    rules.append(rule("tail", [lookup("where s in ('b', 'é') and n > 2")], key="query_lookup", lookup="true"))
    rules.append(rule("entry", [lookup('{"ok": true, "n": 5}')], ("goto", "r3"), key="conditional", lookup="true"))
    ids = [r["id"] for r in rules]
    cat = catalog_of(spark, rules)
    kept = mixed.withColumn("row", F.xxhash64("n", "big", "d", "s", "code"))
    for guard in (False, True):
        monkeypatch.setattr(actions, "INDEXED_RULES", 1)
        index = tag_all(kept, cat, ids, as_of=AS_OF, as_array=True, guard=guard)
        text = tag_all(kept, cat, ids, as_of=AS_OF, guard=guard)
        counts = rule_hit_counts(kept, cat, ids, as_of=AS_OF, guard=guard)
        assert "ArrowEvalPython" in index._jdf.queryExecution().executedPlan().toString()
        got = sorted((r["row"], *r["hits"]) for r in index.collect())
        assert sorted((r["row"], r["hits"]) for r in text.collect()) == sorted((r[0], ",".join(r[1:])) for r in got)
        found = {r["rule_id"]: r["n_hits"] for r in counts.collect()}
        monkeypatch.setattr(actions, "INDEXED_RULES", 10**9)
        exp = sorted((r["row"], *r["hits"]) for r in tag_all(kept, cat, ids, as_of=AS_OF, as_array=True, guard=guard).collect())
        assert got == exp
        assert found == {r["rule_id"]: r["n_hits"] for r in rule_hit_counts(kept, cat, ids, as_of=AS_OF, guard=guard).collect()}
        assert found == {i: sum(i in r[1:] for r in exp) for i in ids}


def test_plan_does_not_grow_with_the_rules(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    sizes = []
    for n in (200, 2000):
        cat = catalog_of(spark, [])
        cat = type(cat).from_json(spark, tpch.index_rules(n))
        plan = tag_all(li, cat, cat.all_ids(), as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and "Exchange" not in plan
        sizes.append(len(plan))
    assert sizes[1] < 1.05 * sizes[0]


def test_blocks_of_conjunctions(spark, monkeypatch):
    """Rules over several blocks, some with their ways to be met in different blocks."""
    from ruleloom.operators import rule_index

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    cat = type(catalog_of(spark, [])).from_json(spark, tpch.index_rules(60))
    whole = tag_all(li, cat, cat.all_ids(), as_of=AS_OF).select("l_orderkey", "hits")
    monkeypatch.setattr(rule_index, "BLOCK", 16)
    cut = tag_all(li, cat, cat.all_ids(), as_of=AS_OF).select("l_orderkey", "hits")
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))


def test_index_on_empty_tables_and_batches(spark, mixed, monkeypatch):
    cat = catalog_of(spark, random_rules(30))
    monkeypatch.setattr(actions, "INDEXED_RULES", 1)
    assert tag_all(mixed.limit(0), cat, cat.all_ids(), as_of=AS_OF).count() == 0
    assert [r["n_hits"] for r in rule_hit_counts(mixed.limit(0), cat, cat.all_ids(), as_of=AS_OF).collect()] == [0] * 30
    assert rule_hit_counts(mixed, cat, [], as_of=AS_OF).count() == 0
    assert {tuple(r["hits"]) for r in tag_all(mixed, cat, [], as_of=AS_OF, as_array=True).collect()} == {()}


def test_ids_with_commas_need_an_array(spark, mixed):
    cat = catalog_of(spark, [rule("a,b", [cond("n", ">", "0")]), rule("a", [cond("n", "=", "5")])])
    with pytest.raises(RuleError, match="comma"):
        tag_all(mixed, cat, ["a,b", "a"], as_of=AS_OF)
    hits = {tuple(r["hits"]) for r in tag_all(mixed, cat, ["a,b", "a"], as_of=AS_OF, as_array=True).collect()}
    assert hits == {(), ("a,b",), ("a,b", "a")}


def test_unfit_rules_raise_their_status(spark, mixed, monkeypatch):
    monkeypatch.setattr(actions, "INDEXED_RULES", 1)
    for when, status in ((cond("n", "=", "abc"), "bad_value"), (cond("missing", "=", "1"), "bad_field"), (cond("ok", "=", "1"), "bad_value"), (cond("day", "<", "5/5/2021"), "bad_value")):
        with pytest.raises(RuleError) as found:
            tag_all(mixed, catalog_of(spark, [rule("r", [when])]), ["r"], as_of=AS_OF)
        assert found.value.status.value == status


def test_index_is_public(spark, mixed):
    cat = catalog_of(spark, random_rules(3))
    index = actions.rule_index(mixed, cat, ["r0", "r1"], as_of=AS_OF)
    assert isinstance(index, RuleIndex) and index.rule_ids == ["r0", "r1"]
    assert mixed.filter(F.array_contains(index.hits(), "r0")).count() == index.count(mixed).filter("rule_pos = 0").first()["n_hits"]
