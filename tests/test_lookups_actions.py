"""Lookups (L1–L3) and actions."""

import pytest
from conftest import AS_OF, catalog_of, cond, lookup, rule

from pyspark.sql import functions as F

from ruleloom import RuleError, match_lookup, rule_hit_counts, rule_values, tag, tag_all, transform, values
from ruleloom.functions.lookups import explode_pairs, json_value


@pytest.fixture(scope="module")
def cat(spark):
    return catalog_of(spark, [
        rule("big", [cond("gross_g", ">=", "10000")], ("is_big", "yes")),
        rule("mill", [cond("depot", "=", "mill")], ("region", "west")),
        rule("hob", [cond("depot", "=", "quay")], ("region", "south")),
        rule("chain", [cond("net_g", ">", "5000")], ("goto", "mill")),
        rule("kv", [lookup({"depot": "quay", "n": 2})], key="value_lookup", lookup="true"),
        rule("q", [lookup(" where depot = 'mill'")], key="query_lookup", lookup="true", process="filtration"),
        rule("net", [], ("net_amount", "gross_g - wrap_g"), key="transformation"),
        rule("net_if", [cond("depot", "=", "mill")], ("net_amount", "gross_g - wrap_g"),
             key="transformation"),
        rule("arr", [lookup([1, 2])], key="value_lookup", lookup="true"),
    ])


def test_tag_sets_value_on_hits(sample, cat):
    out = tag(sample, cat, "big", as_of=AS_OF)
    got = {(r["van"], r["parcel"]): r["is_big"] for r in out.collect()}
    assert sum(v == "yes" for v in got.values()) == 5
    assert sum(v is None for v in got.values()) == 4


def test_tag_all_one_pass(sample, cat):
    out = tag_all(sample, cat, ["big", "mill", "hob", "chain", "q"], as_of=AS_OF)
    rows = {(r["van"], r["parcel"]): r["hits"] for r in out.collect()}
    assert rows[(2, 527)] == "big,mill,chain,q"
    assert rows[(3, 58)] == "hob"
    assert rows[(1, 51)] == "mill,q"
    assert out.columns[-1] == "hits" and len(out.columns) == len(sample.columns) + 1


def test_tag_all_actions_first_rule_wins(sample, cat):
    out = tag_all(sample, cat, ["mill", "hob", "chain"], as_of=AS_OF, set_actions=True)
    regions = {r["region"] for r in out.collect()}
    assert regions == {"west", "south"}


def test_rule_hit_counts(sample, cat):
    got = {r["rule_id"]: r["n_hits"] for r in rule_hit_counts(sample, cat, ["big", "mill", "hob", "q"], as_of=AS_OF).collect()}
    assert got == {"big": 5, "mill": 7, "hob": 2, "q": 7}


def test_transform(sample, cat):
    out = transform(sample, cat, "net", as_of=AS_OF)
    assert out.filter("net_amount = gross_g - wrap_g").count() == 9
    out = transform(sample, cat, "net_if", as_of=AS_OF)
    assert out.filter("net_amount is null").count() == 2  # quay rows untouched (new column)


def test_values_and_rule_values(cat, spark):
    assert values(cat, "kv", as_of=AS_OF).value == [("depot", "quay"), ("n", 2)]
    got = sorted((r["rule_id"], r["key"], r["value"]) for r in rule_values(cat).collect())
    assert got == [("kv", "depot", "quay"), ("kv", "n", "2")]  # text values; non-objects give nothing


def test_match_lookup_on_data(spark):
    df = spark.createDataFrame([(1, '{"depot": "quay", "n": 2}'), (2, '{"depot": "quay", "n": 3}'),
                                (3, '{"depot": "mill"}'), (4, None), (5, "not json")], "k int, j string")
    cat = catalog_of(spark, [rule("kv", [lookup({"depot": "quay", "n": 2})], key="value_lookup", lookup="true"),
                             rule("arr", [lookup([1, 2])], key="value_lookup", lookup="true")])
    out = match_lookup(df, cat, "kv", "j", as_of=AS_OF)
    assert [(r["k"], r["depot"], r["n"]) for r in out.collect()] == [(1, "quay", "2")]
    with pytest.raises(RuleError):
        match_lookup(df, cat, "arr", "j", as_of=AS_OF)


def test_json_helpers(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": 2}}'), (2, "[1]")], "k int, j string")
    assert [r[0] for r in df.select(json_value("j", "a")).collect()] == ["1", None]
    pairs = sorted(tuple(r) for r in explode_pairs(df, "j", ["k"]).collect())
    assert pairs == [(1, "a", "1"), (1, "b", '{"c":2}')]


def test_lookup_only_returns_text_without_table(cat):
    from ruleloom import evaluate

    r = evaluate(cat, "filtration", "query_lookup", "q", "true", as_of=AS_OF)  # L3
    assert r.ok and r.df is None and r.text == "where depot = 'mill'"
    r = evaluate(cat, "identification", "query_builder", "big", "false", as_of=AS_OF)
    assert r.ok and r.predicate is None and r.text == "(gross_g) >= 10000"


def test_multi_rule_calls_can_skip_unusable_rules(spark, sample):
    from ruleloom import rule_statuses

    cat = catalog_of(spark, [rule("ok", [cond("depot", "=", "quay")]),
                             rule("off", [cond("depot", "=", "mill")], valid="false"),
                             rule("dang", [cond("depot", "=", "mill")], ("goto", "none"))])
    with pytest.raises(RuleError):
        tag_all(sample, cat, ["ok", "off"], as_of=AS_OF)
    out = tag_all(sample, cat, ["ok", "off", "dang", "missing"], as_of=AS_OF, errors="skip")
    assert sorted(r["hits"] for r in out.collect()) == [""] * 7 + ["ok"] * 2
    st = {k: v.status.value for k, v in rule_statuses(cat, ["ok", "off", "dang", "missing"], as_of=AS_OF).items()}
    assert st == {"ok": "ok", "off": "off", "dang": "goto_unknown", "missing": "not_configured"}
    counts = rule_hit_counts(sample, cat, ["off", "ok"], as_of=AS_OF, errors="skip").collect()
    assert [(r["rule_id"], r["n_hits"]) for r in counts] == [("ok", 2)]
    assert tag_all(sample, cat, ["off"], as_of=AS_OF, errors="skip").filter("hits = ''").count() == 9


def test_transformation_through_evaluate(spark, sample, cat):
    from ruleloom import evaluate

    res = evaluate(cat, "identification", "transformation", "net", "false", df=sample, apply=True, as_of=AS_OF)
    assert res.ok and "net_amount" in res.df.columns
    assert res.df.filter("net_amount = gross_g - wrap_g").count() == 9


def test_query_tails_beyond_where(spark, orders_small):
    from ruleloom import apply_rule

    cat = catalog_of(spark, [
        rule("top", [lookup(" where o_orderstatus = 'F' order by o_totalprice desc, o_orderkey limit 5")],
             key="query_lookup", lookup="true", process="filtration"),
        rule("brace", [lookup(" where o_orderpriority != '{x}'")], key="query_lookup", lookup="true",
             process="filtration"),
        rule("sub", [lookup(" where o_custkey in (select o_custkey from orders_v where o_totalprice > 450000)")],
             key="query_lookup", lookup="true", process="filtration"),
    ])
    top = apply_rule(orders_small, cat, "top", as_of=AS_OF).collect()
    exp = orders_small.filter("o_orderstatus = 'F'").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5).collect()
    assert [r["o_orderkey"] for r in top] == [r["o_orderkey"] for r in exp]
    assert apply_rule(orders_small, cat, "brace", as_of=AS_OF).count() == orders_small.count()
    orders_small.createOrReplaceTempView("orders_v")
    n = apply_rule(orders_small, cat, "sub", as_of=AS_OF).count()
    assert n == orders_small.join(orders_small.filter("o_totalprice > 450000").select("o_custkey").distinct(),
                                  "o_custkey").count()


def test_match_lookup_with_escaped_json(spark):
    df = spark.createDataFrame([(1, '{"\\u006b": 9}'), (2, '{"k": 9}'), (3, '{"k": "9"}'), (4, '{"k": 19}'),
                                (5, '{"x": 9, "k": 1}')], "id int, j string")
    cat = catalog_of(spark, [rule("kv", [lookup({"k": 9})], key="value_lookup", lookup="true")])
    got = sorted(r["id"] for r in match_lookup(df, cat, "kv", "j", as_of=AS_OF).collect())
    exp = sorted(r["id"] for r in df.filter(F.get_json_object("j", "$.k") == "9").collect())
    assert got == exp == [1, 2, 3]


def test_subquery_tail_filters_and_tags(spark, orders_small):
    """An IN-subquery tail is a filter, and a per-row test when tagging (an existence join)."""
    from ruleloom import apply_rule

    orders_small.createOrReplaceTempView("orders_v2")
    cat = catalog_of(spark, [
        rule("sub", [lookup(" where o_custkey in (select o_custkey from orders_v2 where o_totalprice > 450000)")],
             key="query_lookup", lookup="true", process="filtration"),
        rule("big", [cond("o_totalprice", ">=", "400000")]),
    ])
    n = apply_rule(orders_small, cat, "sub", as_of=AS_OF).count()
    out = tag_all(orders_small, cat, ["sub", "big"], as_of=AS_OF)
    assert n > 0 and out.filter("hits like 'sub%'").count() == n
    assert out.filter("hits like '%big'").count() == orders_small.filter("o_totalprice >= 400000").count()


def test_hit_counts_two_level_merge_gives_the_same_counts(spark):
    from ruleloom import tpch

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").repartition(12)
    rules = ["li_net", "li_net60"]
    direct = {r["rule_id"]: r["n_hits"] for r in rule_hit_counts(li, tpch.catalog(spark), rules, as_of=AS_OF).collect()}
    tree = {r["rule_id"]: r["n_hits"]
            for r in rule_hit_counts(li, tpch.catalog(spark), rules, as_of=AS_OF).collect()}
    assert direct == tree
    assert direct["li_net60"] == li.filter("l_extendedprice - l_extendedprice*l_discount >= 60000").count()


def test_tag_keeps_existing_values_on_misses(spark, sample, cat):
    pre = sample.withColumn("is_big", F.lit("unknown"))
    out = tag(pre, cat, "big", as_of=AS_OF)
    vals = sorted(r["is_big"] for r in out.collect())
    assert vals == ["unknown"] * 4 + ["yes"] * 5
    out = tag(sample, cat, "big", as_of=AS_OF, column="flag", value="Y")
    assert out.filter("flag = 'Y'").count() == 5 and out.filter("flag is null").count() == 4
