"""Rule document loading and the rule tables."""

import json
import os

import pytest
from conftest import AS_OF, catalog_of, cond, lookup, rule

from ruleloom import RuleCatalog, Status, apply_rule, evaluate, tpch


def test_headers_and_conditions(spark):
    cat = catalog_of(spark, [
        rule("late", [lookup(" where depot = 'quay'")], key="query_lookup", lookup="true", process="filtration"),
        rule("tariff", [lookup({"zone": "east", "grams": 750})], key="value_lookup", lookup="true"),
        rule("jump", [cond("net_g", ">", "1", "AND"), cond("wrap_g", ">", "2")], ("goto", "late")),
    ])
    h = cat.headers().orderBy("rule_pos").collect()
    assert [r["id"] for r in h] == ["late", "tariff", "jump"]
    assert [r["n_conditions"] for r in h] == [1, 1, 2]
    assert h[2]["field_name"] == "goto" and h[2]["field_value"] == "late"
    c = cat.conditions().orderBy("rule_pos", "cond_pos").collect()
    assert len(c) == 4 and c[0]["lookup_value"].strip().startswith("where")
    # objects arrive as their JSON text
    assert json.loads(c[1]["lookup_value"]) == {"zone": "east", "grams": 750}


def test_trim_and_numeric_field_values(spark, orders_small):
    cat = catalog_of(spark, [{
        "id": " r1 ", "name": " n ", "description": "d", "is_valid": " true ", "valid_from": "10/12/2021",
        "valid_till": "10/12/2999", "process": " identification ", "process_key": " query_builder ",
        "is_lookup": " false ", "when": [{"field_name": "o_totalprice", "operator": ">=", "field_value": 400000,
                                          "join": ""}], "then": {"field_name": " is_large ", "field_value": "true"}}])
    h = cat.headers().first()
    assert (h["id"], h["is_valid"], h["process_key"], h["field_name"]) == ("r1", "true", "query_builder", "is_large")
    # a JSON number as field_value arrives as text and compares numerically
    assert cat.conditions().first()["field_value"] == "400000"
    assert apply_rule(orders_small, cat, "r1", as_of=AS_OF).count() == orders_small.filter("o_totalprice >= 400000").count()


def test_older_key_name(spark, orders_small):
    r = rule("old", [cond("o_orderstatus", "=", "F")])
    r["key"] = r.pop("process_key")
    cat = catalog_of(spark, [r])
    assert cat.headers().first()["process_key"] == "query_builder"
    assert evaluate(cat, "identification", "query_builder", "old", "false", as_of=AS_OF).ok


def test_malformed_document(spark, tmp_path):
    bad = tmp_path / "bad.json"
    bad.write_text('{"rule_id": "x", "rules": [ {"name": "a", "when": [ {"field_name": "x"} ], "then": {"a": 1} ] }')
    cat = RuleCatalog.load(spark, str(bad))
    with pytest.raises(ValueError):
        cat.rules_with_id("x")


def test_status_table(spark):
    cat = catalog_of(spark, [
        rule("ok", [cond("a", "=", "1")]),
        rule("off", [cond("a", "=", "1")], valid="FALSE"),
        rule("old", [cond("a", "=", "1")], window=("10/12/2020", "10/06/2021")),
        rule("bad", [cond("a", "=", "1")], window=("2021-12-10", "10/12/2999")),
        rule("empty", []),
        rule("weird", [cond("a", "=", "1")], key="nope"),
        rule("flag", [lookup("x")], key="query_lookup", lookup="false"),
    ])
    got = {r["id"]: r["status"] for r in cat.status(AS_OF).collect()}
    assert got == {"ok": "ok", "off": "off", "old": "out_of_window", "bad": "bad_date", "empty": "no_conditions",
                   "weird": "invalid_key", "flag": "lookup_flag_mismatch"}


def test_bad_date_rule_does_not_break_others(spark, orders_small):  # D15
    cat = catalog_of(spark, [rule("bad", [cond("o_totalprice", ">=", "1")], window=("31/02/2022", "xx")),
                             rule("good", [cond("o_orderstatus", "=", "F")])])
    assert evaluate(cat, "identification", "query_builder", "bad", "false", as_of=AS_OF).status is Status.BAD_DATE
    assert apply_rule(orders_small, cat, "good", as_of=AS_OF).count() > 0


def test_window_is_inclusive(spark):
    import datetime as dt

    cat = catalog_of(spark, [rule("w", [cond("a", "=", "1")], window=("01/03/2022", "31/03/2022"))])
    for d, ok in [(dt.date(2022, 3, 1), True), (dt.date(2022, 3, 31), True), (dt.date(2022, 2, 28), False),
                  (dt.date(2022, 4, 1), False)]:
        assert evaluate(cat, "identification", "query_builder", "w", "false", as_of=d).ok is ok


def test_duplicates_first_definition_wins(spark, orders_small):  # D19
    cat = catalog_of(spark, [rule("d", []), rule("d", [cond("o_orderstatus", "=", "F")]),
                             rule("d", [cond("o_orderstatus", "=", "O")])])
    assert [r["id"] for r in cat.duplicates().collect()] == ["d"]
    # the first definition has no conditions, so the next one is used, alone
    res = evaluate(cat, "identification", "query_builder", "d", "false", df=orders_small, apply=True, as_of=AS_OF)
    assert res.text == "(o_orderstatus) = 'F'"


def test_every_rule_is_indexed_in_one_job(spark, orders_small):
    rules = [rule(f"r{i}", [cond("o_totalprice", ">=", str(i * 1000))]) for i in range(30)]
    cat = catalog_of(spark, rules)
    assert apply_rule(orders_small, cat, "r25", as_of=AS_OF).count() == orders_small.filter("o_totalprice >= 25000").count()
    assert len(cat.all_ids()) == 30


def test_malformed_documents_raise_on_every_call(spark):
    cat = RuleCatalog.from_json(spark, ['{"rules": []}', "not json"])
    for _ in range(2):
        with pytest.raises(ValueError):
            cat.rules_with_id("x")


def test_texts_keep_their_order(spark):
    one, two = ({"rules": [rule(i, [cond("a", "=", v)]) for i in ids]} for ids, v in ((["p", "x"], "1"), (["x", "q"], "2")))
    cat = RuleCatalog.from_json(spark, [json.dumps(one), json.dumps(two)])
    assert cat.all_ids() == ["p", "x", "q"]
    assert [r.conditions[0].field_value for r in cat.rules_with_id("x")] == ["1", "2"]


def test_reads_from_file_path(spark):
    cat = RuleCatalog.load(spark, tpch.RULES_PATH)
    assert cat.all_ids()[:3] == ["ord_filter", "ord_large", "ord_and"]


def test_empty_document_is_an_empty_catalog(spark):
    cat = RuleCatalog.from_json(spark, '{"rules": []}')
    assert cat.all_ids() == []
    assert evaluate(cat, "identification", "query_builder", "x", "false", as_of=AS_OF).status is Status.NOT_CONFIGURED


def test_validate_rules_reports_chain_problems(spark):
    from ruleloom import tpch, validate_rules

    got = {r["rule_id"]: (r["status"], r["chain"]) for r in validate_rules(tpch.catalog(spark), AS_OF).collect()}
    assert got["ord_c1"] == ("ok", "ord_c1 -> ord_c2 -> ord_c3")
    assert got["ord_via_cond"] == ("ok", "ord_via_cond -> ord_cond -> ord_large")
    assert got["dangling"][0] == "goto_unknown"
    assert got["loop_a"][0] == "goto_cycle"
    assert got["off"][0] == "off" and got["expired"][0] == "out_of_window" and got["bad_date"][0] == "bad_date"
    assert got["vals"][0] == "ok" and got["grp"][0] == "ok" and got["net"][0] == "ok"


def test_folder_of_documents(spark, orders_small):
    import json as _json

    from ruleloom.session import shared_path

    base = shared_path(spark, "t-docs").replace("file:", "")
    os.makedirs(base)
    docs = {
        "a.json": [rule("x", [cond("o_orderstatus", "=", "F")]), rule("y", [cond("o_totalprice", ">=", "1")])],
        "b.json": [rule("x", [cond("o_orderstatus", "=", "O")]), rule("z", [cond("o_totalprice", "<", "1000")])],
    }
    for name, rules in docs.items():
        with open(os.path.join(base, name), "w") as f:
            _json.dump({"rules": rules}, f, indent=2)
    cat = RuleCatalog.load(spark, base)
    assert cat.all_ids() == ["x", "y", "z"]
    assert [r["id"] for r in cat.duplicates().collect()] == ["x"]
    # the first document (by file name) defines x
    assert apply_rule(orders_small, cat, "x", as_of=AS_OF).count() == orders_small.filter("o_orderstatus = 'F'").count()
