"""Every row of the outcome table, with the build's decisions."""

import pytest
from conftest import AS_OF, catalog_of, cond, lookup, rule

from ruleloom import Status, evaluate


@pytest.fixture(scope="module")
def cat(spark):
    return catalog_of(spark, [
        rule("q", [lookup(" where o_orderstatus = 'F'")], key="query_lookup", lookup="true", process="filtration"),
        rule("v", [lookup({"a": "yes", "b": 2})], key="value_lookup", lookup="true"),
        rule("varr", [lookup([{"a": "yes"}, {"b": "no"}])], key="value_lookup", lookup="true"),
        rule("b", [cond("o_totalprice", ">=", "400000")]),
        rule("off", [cond("o_totalprice", ">=", "1")], valid="false"),
        rule("old", [cond("o_totalprice", ">=", "1")], window=("10/12/2020", "10/06/2021")),
        rule("empty", []),
        rule("weird", [cond("o_totalprice", ">=", "1")], key="mystery"),
        rule("tr", [], ("net", "o_totalprice - 1"), key="transformation"),
        rule("cond_ok", [lookup({"o_orderstatus": "O"})], ("goto", "b"), key="conditional", lookup="true"),
        rule("cond_nogoto", [lookup({"o_orderstatus": "O"})], key="conditional", lookup="true"),
        rule("grp", [lookup(" group by o_custkey")], key="groupby_lookup", lookup="true", process="filtration"),
        rule("b_lk", [cond("o_totalprice", ">=", "1")], lookup="true"),
        rule("goto_none", [cond("o_totalprice", ">=", "1")], ("goto", "missing")),
        rule("cond_none", [lookup({"x": "1"})], ("goto", "missing"), key="conditional", lookup="true"),
        rule("cond_empty", [lookup({"x": "1"})], ("goto", "empty"), key="conditional", lookup="true"),
        rule("cond_weird", [lookup({"x": "1"})], ("goto", "weird"), key="conditional", lookup="true"),
        rule("cond_tr", [lookup({"x": "1"})], ("goto", "tr"), key="conditional", lookup="true"),
        rule("q_flag_false", [lookup(" where o_orderstatus = 'F'")], key="query_lookup", lookup="false"),
        rule("v_flag_false", [lookup({"a": "b"})], key="value_lookup", lookup="false"),
        rule("goto_off", [cond("o_totalprice", ">=", "1")], ("goto", "off")),
        rule("goto_old", [cond("o_totalprice", ">=", "1")], ("goto", "old")),
        rule("goto_lookup", [cond("o_totalprice", ">=", "1")], ("goto", "q")),
        rule("goto_cond", [cond("o_totalprice", ">=", "450000")], ("goto", "cond_ok")),
        rule("cyc1", [cond("o_totalprice", ">=", "1")], ("goto", "cyc2")),
        rule("cyc2", [cond("o_totalprice", ">=", "1")], ("goto", "cyc1")),
    ])


def ev(cat, rid, key="query_builder", lookup="false", process="identification", **kw):
    return evaluate(cat, process, key, rid, lookup, as_of=AS_OF, **kw)


def test_not_configured(cat):
    r = ev(cat, "nope")
    assert (r.status, r.params_ok, r.rule_ok, r.text) == (Status.NOT_CONFIGURED, False, False, "")
    # a known id with another key / process / flag is not a match either
    assert ev(cat, "b", key="query_lookup").status is Status.NOT_CONFIGURED
    assert ev(cat, "b", process="filtration").status is Status.NOT_CONFIGURED
    assert ev(cat, "b", lookup="true").status is Status.NOT_CONFIGURED


def test_inputs_are_trimmed(cat):
    assert ev(cat, "  b ", key=" query_builder", lookup="false ", process=" identification").ok


def test_off_and_out_of_window(cat):
    r = ev(cat, "off")
    assert (r.status, r.params_ok, r.rule_ok) == (Status.OFF, True, False)
    r = ev(cat, "old")
    assert (r.status, r.params_ok, r.rule_ok) == (Status.OUT_OF_WINDOW, True, False)


def test_no_conditions_and_unknown_key(cat):
    assert ev(cat, "empty").status is Status.NO_CONDITIONS
    r = ev(cat, "weird", key="mystery")
    assert (r.status, r.params_ok, r.rule_ok) == (Status.INVALID_KEY, True, False)


def test_transformation_is_a_plan(cat):
    r = ev(cat, "tr", key="transformation")
    assert r.ok and r.plan.kind == "transform" and r.text == "o_totalprice - 1 AS net"


def test_query_lookup_and_builder_ok(cat, orders_small):
    r = ev(cat, "q", key="query_lookup", lookup="true", process="filtration", df=orders_small, apply=True)
    assert r.ok and r.text == "where o_orderstatus = 'F'"
    assert r.df.count() == orders_small.filter("o_orderstatus = 'F'").count()
    r = ev(cat, "b", df=orders_small, apply=True)
    assert r.ok and r.df.count() == orders_small.filter("o_totalprice >= 400000").count()


def test_value_lookup_rows(cat):
    r = ev(cat, "v", key="value_lookup", lookup="true", value_key="a")
    assert r.ok and r.value == "yes"
    r = ev(cat, "v", key="value_lookup", lookup="true", value_key="zzz")
    assert (r.status, r.params_ok, r.rule_ok) == (Status.VALUE_KEY_MISSING, False, True)
    assert r.params_ok is False  # a real boolean, not the text "False"
    r = ev(cat, "varr", key="value_lookup", lookup="true", value_key="a")
    assert r.status is Status.VALUE_KEY_MISSING
    r = ev(cat, "v", key="value_lookup", lookup="true")
    assert r.ok and r.value == [("a", "yes"), ("b", 2)]
    r = ev(cat, "varr", key="value_lookup", lookup="true")
    assert (r.status, r.params_ok) == (Status.NOT_AN_OBJECT, False)


def test_value_key_none_means_all(cat):
    assert ev(cat, "v", key="value_lookup", lookup="true", value_key=None).value == [("a", "yes"), ("b", 2)]
    assert ev(cat, "v", key="value_lookup", lookup="true", value_key="  ").value == [("a", "yes"), ("b", 2)]


def test_conditional_rows(cat, orders_small):
    r = ev(cat, "cond_ok", key="conditional", lookup="true", df=orders_small, apply=True)
    assert r.ok and r.df.count() == orders_small.filter("o_totalprice >= 400000").count()
    r = ev(cat, "cond_nogoto", key="conditional", lookup="true")
    assert (r.status, r.params_ok, r.rule_ok) == (Status.CONDITIONAL_NO_GOTO, False, True)


def test_lookup_flag_with_other_keys(cat):
    # group-by lookup resolves to a plan that needs aggregates (not an empty text)
    r = ev(cat, "grp", key="groupby_lookup", lookup="true", process="filtration")
    assert r.ok and r.plan.kind == "group"
    # builder flagged as lookup: error, never an empty match-all query
    assert ev(cat, "b_lk", lookup="true").status is Status.LOOKUP_FLAG


def test_goto_unknown_both_entries(cat):
    assert ev(cat, "goto_none").status is Status.GOTO_UNKNOWN
    assert ev(cat, "cond_none", key="conditional", lookup="true").status is Status.GOTO_UNKNOWN  # D12


def test_conditional_to_empty_or_wrong_target_is_error(cat):
    assert ev(cat, "cond_empty", key="conditional", lookup="true").status is Status.NO_CONDITIONS
    assert ev(cat, "cond_weird", key="conditional", lookup="true").status is Status.GOTO_TARGET_KIND
    assert ev(cat, "cond_tr", key="conditional", lookup="true").status is Status.NO_CONDITIONS


def test_lookup_rules_flagged_false_are_errors(cat):
    assert ev(cat, "q_flag_false", key="query_lookup").status is Status.LOOKUP_FLAG
    assert ev(cat, "v_flag_false", key="value_lookup").status is Status.LOOKUP_FLAG


def test_goto_to_off_or_expired_passes_status_up(cat):
    assert ev(cat, "goto_off").status is Status.OFF
    assert ev(cat, "goto_old").status is Status.OUT_OF_WINDOW


def test_goto_to_lookup_and_conditional_targets(cat, orders_small):
    assert ev(cat, "goto_lookup").status is Status.GOTO_TARGET_KIND  # D13 plain lookup
    r = ev(cat, "goto_cond", df=orders_small, apply=True)  # D13 conditional passes through
    assert r.ok and r.chain == ["goto_cond", "cond_ok", "b"]
    assert r.df.count() == orders_small.filter("o_totalprice >= 450000 and o_totalprice >= 400000").count()


def test_goto_cycle(cat):
    r = ev(cat, "cyc1")
    assert r.status is Status.GOTO_CYCLE and "cyc1 -> cyc2 -> cyc1" in r.message


def test_never_match_all(cat, orders_small):
    """No outcome ever yields an unfiltered table (the empty-where trap)."""
    for rid, key, lk in [("empty", "query_builder", "false"), ("cond_empty", "conditional", "true"),
                         ("cond_none", "conditional", "true"), ("q_flag_false", "query_lookup", "false"),
                         ("goto_lookup", "query_builder", "false")]:
        r = ev(cat, rid, key=key, lookup=lk, df=orders_small, apply=True)
        assert not r.ok and r.df is None


def test_none_means_blank_and_lookups_never_execute(spark, cat, orders_small):  # D16, D17
    from ruleloom import generate

    ok, valid, msg, text, df = generate(spark, cat, "identification", "query_builder", "b", "false",
                                        table_name=None, apply_query=True, as_of=AS_OF)
    assert ok and valid and df is None and text == "WHERE (o_totalprice) >= 400000"
    ok, valid, msg, value, df = generate(spark, cat, "identification", "value_lookup", "v", "true", value_key="a",
                                         table_name=orders_small, apply_query=True, as_of=AS_OF)
    assert (ok, valid, value, df) == (True, True, "yes", None)


def test_first_lookup_entry_wins(spark):  # D21
    c = catalog_of(spark, [rule("two", [lookup({"a": "first"}), lookup({"a": "second"})], key="value_lookup",
                                lookup="true")])
    assert evaluate(c, "identification", "value_lookup", "two", "true", value_key="a", as_of=AS_OF).value == "first"


def test_nulls_follow_sql_logic(spark):  # D23
    df = spark.createDataFrame([(1, None, None), (2, "ECONOMY", 5), (3, "STANDARD", None)], "k int, t string, n int")
    c = catalog_of(spark, [rule("nl", [cond("t", "NOT LIKE", "ECON")]), rule("lt", [cond("n", "<", "10")]),
                           rule("ns", [cond("t", "<=>", "STANDARD")]), rule("ne", [cond("t", "!=", "ECONOMY")])])
    from ruleloom import apply_rule

    assert [r["k"] for r in apply_rule(df, c, "nl", as_of=AS_OF).collect()] == [3]
    assert [r["k"] for r in apply_rule(df, c, "lt", as_of=AS_OF).collect()] == [2]
    assert [r["k"] for r in apply_rule(df, c, "ns", as_of=AS_OF).collect()] == [3]
    assert [r["k"] for r in apply_rule(df, c, "ne", as_of=AS_OF).collect()] == [3]


def test_tail_that_does_not_fit_the_table_is_a_status(spark, orders_small):
    c = catalog_of(spark, [rule("q", [lookup(" where no_such_col = 1")], key="query_lookup", lookup="true",
                                process="filtration"),
                           rule("q2", [lookup(" where o_orderstatus = 'F' order by no_such_col")],
                                key="query_lookup", lookup="true", process="filtration")])
    for rid in ("q", "q2"):
        r = evaluate(c, "filtration", "query_lookup", rid, "true", df=orders_small, apply=True, as_of=AS_OF)
        assert r.status is Status.BAD_QUERY and r.df is None and "does not fit" in r.message
