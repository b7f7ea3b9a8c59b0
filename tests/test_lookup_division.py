"""Exact JSON lookups, all lookups at once, rule addresses, null guards, texts behind a predicate."""

import json
import random

import pytest
from conftest import AS_OF, catalog_of, cond, lookup, rule
from pyspark.sql import functions as F

from ruleloom import RuleAddress, RuleError, apply_rule, apply_stages, evaluate, match_lookup, match_lookups, rule_statuses, tag_all
from ruleloom.functions.lookups import number_key, number_key_of
from ruleloom.operators.rule_index import RuleIndex
from ruleloom.operators.apply import rule_plan


def values_rule(rid, text, process="identification"):
    return rule(rid, [lookup(text)], key="value_lookup", lookup="true", process=process)


def test_number_keys(spark):
    same = [["9", "9.0", "9e0", "90e-1", "0.9E1", "+9", "09", " 9 "], ["0", "-0", "0.000", "0e99"], ["-1200", "-1.2e3", "-12E+2"],
            ["9.00000000000001", "9.000000000000010"], ["1e28", "1" + "0" * 28], ["123456789012345678901234567890.5"], ["1e-400"], [".5", "0.5", "5e-1"]]
    texts = [(t, n) for n, group in enumerate(same) for t in group] + [(t, None) for t in ("", "abc", "1e", ".", "-", "1 2", "e5", "0x9", None)]
    got = {(r["t"], r["n"]): r["k"] for r in spark.createDataFrame(texts, "t string, n int").select("t", "n", number_key(F.col("t")).alias("k")).collect()}
    assert all(k is None for (t, n), k in got.items() if n is None)
    by_key = {}
    for (t, n), k in got.items():
        if n is not None:
            by_key.setdefault(k, set()).add(n)
    assert len(by_key) == len(same) and all(len(v) == 1 for v in by_key.values())
    for (t, n), k in got.items():
        if n is not None:
            from decimal import Decimal

            assert number_key_of(Decimal(t.strip())) == k


OBJECTS = ['{"n": 9}', '{"n": 9.00000000000001}', '{"n": 9.0}', '{"n": 90e-1}', '{"n": "9"}', '{"n": 1e28}', '{"n": 10000000000000000000000000000}', '{"n": 10000000000000000000000000001}',
           '{"n": null}', '{}', '{"n": true}', '{"n": "true"}', '{"\\u006e": 9}', "{'n': 9}", '{"n": {"a": 1, "b": [2, 3]}}', '{"n": { "a":1,"b":[2,3] }}', '{"n": {"b": [2, 3], "a": 1}}', "[1]", "7", "not json", "", None,
           '{"n": 9, "n": 8}', '{"n": 9, "m": "x/y"}', '{"n": 9, "m": "x\\/y"}', '{"n": 90}', '{"n": "09"}']


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame([(i, o, "own") for i, o in enumerate(OBJECTS)], "id int, o string, rule_id string").repartition(3)


@pytest.mark.parametrize("wanted,found", [
    ("9", {0, 2, 3, 4, 12, 13, 22, 23, 24, 26}), ("9.00000000000001", {1}), ("1e28", {5, 6}), ("10000000000000000000000000001", {7}), ('"9"', {0, 4, 12, 13, 22, 23, 24}),
    ("null", {8}), ("true", {10, 11}), ('{"b": [2, 3], "a": 1}', {14, 15, 16}),
])
def test_exact_values(spark, facts, wanted, found):
    cat = catalog_of(spark, [values_rule("r", f'{{"n": {wanted}}}')])
    assert {r["id"] for r in match_lookup(facts, cat, "r", "o", as_of=AS_OF).collect()} == found
    assert {r["id"] for r in match_lookups(facts, cat, ["r"], "o", as_of=AS_OF).collect()} == found


def test_several_pairs_and_escaped_texts(spark, facts):
    cat = catalog_of(spark, [values_rule("r", '{"n": 9, "m": "x/y"}')])
    assert {r["id"] for r in match_lookup(facts, cat, "r", "o", as_of=AS_OF).collect()} == {23, 24}


def test_division_agrees_with_one_rule_after_another(spark):
    """A third of the rows holds one object; hot pairs; repeated rows; rules that nothing fits."""
    rng = random.Random(5)
    rows = [(i % 350, json.dumps({k: rng.choice([1, 2.0, "1", None, True, [1], {"x": 1}]) for k in rng.sample("abcd", rng.randrange(5))})) for i in range(400)]
    rows += [(i, '{"a": 1, "b": "hot"}') for i in range(1000, 1200)] + [(7, None), (8, "x")]
    df = spark.createDataFrame(rows, "id int, `o.o` string").withColumn("rule_pos", F.lit("theirs"))
    rules = [{k: rng.choice([1, 2, "1", None, True, [1], {"x": 1}, "hot", "absent"]) for k in rng.sample("abcd", rng.randrange(1, 4))} for _ in range(60)]
    cat = catalog_of(spark, [values_rule(f"r{i}", json.dumps(p)) for i, p in enumerate(rules)])
    got = match_lookups(df, cat, cat.all_ids(), "o.o", as_of=AS_OF)
    assert got.columns == ["id", "o.o", "rule_pos", "rule_id"]
    exp = []
    for i in range(len(rules)):
        exp += [(r["id"], r["o.o"], f"r{i}") for r in match_lookup(df, cat, f"r{i}", "o.o", as_of=AS_OF, extract=False).collect()]
    assert sorted((r["id"], r["o.o"], r["rule_id"]) for r in got.collect()) == sorted(exp)
    assert match_lookups(df.limit(0), cat, cat.all_ids(), "o.o", as_of=AS_OF).count() == 0


def test_division_needs_pairs(spark, facts):
    cat = catalog_of(spark, [values_rule("none", "{}"), values_rule("list", "[1]")])
    for rid in ("none", "list", "unknown"):
        with pytest.raises(RuleError):
            match_lookups(facts, cat, [rid], "o", as_of=AS_OF)


def test_null_guard_tests_for_null(spark):
    df = spark.createDataFrame([(1, None), (2, "null"), (3, "a")], "n int, s string")
    cat = catalog_of(spark, [rule("entry", [lookup('{"s": null}')], ("goto", "all"), key="conditional", lookup="true"), rule("all", [cond("n", ">", "0")])])
    res = evaluate(cat, "identification", "conditional", "entry", "true", df=df, apply=True, as_of=AS_OF, guard=True)
    assert [r["n"] for r in res.df.collect()] == [1]
    assert [r["n"] for r in df.filter(res.text).collect()] == [1]
    index = RuleIndex(df, [("entry", rule_plan(cat, "entry", as_of=AS_OF, guard=True))])
    assert [r["n"] for r in df.filter(F.size(index.hits()) == 1).collect()] == [1]


@pytest.mark.parametrize("tail", ["where n = 1 garbage", "where n = 1 as x", "where n = 1) or (n = 2", "where n = 1 and", "where n = 1 order by"])
def test_text_behind_a_predicate_is_an_error(spark, tail):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    cat = catalog_of(spark, [rule("q", [lookup(tail)], key="query_lookup", lookup="true")])
    res = evaluate(cat, "identification", "query_lookup", "q", "true", df=df, apply=True, as_of=AS_OF)
    assert res.status.value == "bad_query" and res.df is None


@pytest.mark.parametrize("tail,n", [("where n = 1 -- a remark", 1), ("where (n = 1) or (n = 2)", 2), ("where n > 0 order by n limit 1", 1), ("WHERE\n n in (1, 2)", 2)])
def test_tails_that_stand(spark, tail, n):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    cat = catalog_of(spark, [rule("q", [lookup(tail)], key="query_lookup", lookup="true")])
    res = evaluate(cat, "identification", "query_lookup", "q", "true", df=df, apply=True, as_of=AS_OF)
    assert res.df.count() == n


def test_rules_of_one_id_are_told_apart(spark, tmp_path):
    rules = [rule("x", [cond("n", "<=", "4")], ("size", "small"), process="identification"), rule("x", [cond("n", "<=", "2")], ("size", "tiny"), process="other"),
             values_rule("x", '{"n": 1}', process="third")]
    cat = catalog_of(spark, rules)
    df = spark.range(1, 7).select(F.col("id").cast("int").alias("n"))
    other = RuleAddress("x", process="other")
    assert apply_rule(df, cat, "x", as_of=AS_OF).count() == 4
    assert apply_rule(df, cat, other, as_of=AS_OF).count() == 2
    assert apply_stages(df, cat, ["x", other], as_of=AS_OF).count() == 2
    hits = {r["n"]: r["hits"] for r in tag_all(df, cat, ["x", other], as_of=AS_OF, as_array=True).collect()}
    assert hits[1] == ["x", "x"] and hits[3] == ["x"] and hits[5] == []
    states = rule_statuses(cat, [other, RuleAddress("x", "absent"), RuleAddress("x", "third", "value_lookup", "true")], as_of=AS_OF)
    assert [s.status.value for s in states.values()] == ["ok", "not_configured", "ok"]
    from ruleloom.__main__ import main

    path = f"{tmp_path}/rules.json"
    with open(path, "w") as f:
        json.dump({"rules": rules}, f)
    df.write.parquet(f"{tmp_path}/in")
    main(["apply", "--rules", path, "--input", f"{tmp_path}/in", "--rule", "x@other/query_builder", "--output", f"{tmp_path}/out", "--as-of", "2022-03-01"], spark)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
