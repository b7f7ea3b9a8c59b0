"""Condition typing and connector semantics."""

import pytest
from conftest import AS_OF, catalog_of, cond, rule

from ruleloom import Status, apply_rule, evaluate
from ruleloom.functions.predicates import fold_terms


def count(spark, sample, when, then=("", "")):
    cat = catalog_of(spark, [rule("r", when, then)])
    res = evaluate(cat, "identification", "query_builder", "r", "false", df=sample, apply=True, as_of=AS_OF)
    return res if not res.ok else res.df.count()


def test_numeric_and_string_comparisons(spark, sample):
    assert count(spark, sample, [cond("net_g", ">", "9000")]) == 2  # P2
    assert count(spark, sample, [cond("depot", "=", "quay")]) == 2  # P3
    assert count(spark, sample, [cond("depot", "!=", "quay")]) == 7
    assert count(spark, sample, [cond("depot", "<>", "quay")]) == 7
    assert count(spark, sample, [cond("depot", "==", "mill")]) == 7
    assert count(spark, sample, [cond("depot", "<=>", "mill")]) == 7


def test_like_family(spark, sample):
    assert count(spark, sample, [cond("kind", "LIKE", "LET")]) == 8  # P4 prefix
    assert count(spark, sample, [cond("kind", "NOT LIKE", "LET")]) == 1  # P5
    assert count(spark, sample, [cond("kind", "like", "LET")]) == 0  # D22 exact
    assert count(spark, sample, [cond("kind", "like", "LETTERBOX")]) == 8
    assert count(spark, sample, [cond("route", "LIKE", "K7_00")]) == 9  # '_' stays a wildcard
    assert count(spark, sample, [cond("depot", "RLIKE", "^q")]) == 2
    assert count(spark, sample, [cond("depot", "ilike", "MILL")]) == 7


def test_like_on_digits_is_a_text_prefix(spark, sample):  # P6
    assert count(spark, sample, [cond("parcel", "LIKE", "5")]) == 9
    assert count(spark, sample, [cond("parcel", "LIKE", "52")]) == 2
    assert count(spark, sample, [cond("zone", "LIKE", "03")]) == 1


def test_computed_left_side(spark, sample):  # P8
    assert count(spark, sample, [cond("gross_g - wrap_g", ">=", "10000")]) == 3


def test_literal_typing(spark, sample):  # P12, D3, D4
    assert count(spark, sample, [cond("insured", "=", "true")]) == 8
    assert count(spark, sample, [cond("insured", "=", "FALSE")]) == 1
    # digits against a text column compare as numbers: '036' = 36; 'north' does not raise
    assert count(spark, sample, [cond("zone", "=", "36")]) == 1
    assert count(spark, sample, [cond("zone", "=", "036")]) == 1
    assert count(spark, sample, [cond("net_g", ">=", "11000.5")]) == 1  # decimal on int
    assert count(spark, sample, [cond("wrap_g", ">", "-5")]) == 9
    assert count(spark, sample, [cond("wrap_g", ">", "0300")]) == 8  # leading zeros


def test_bad_values_are_statuses(spark, sample):
    assert count(spark, sample, [cond("net_g", ">=", "abc")]).status is Status.BAD_VALUE
    assert count(spark, sample, [cond("net_g", ">=", "²")]).status is Status.BAD_VALUE  # D4
    assert count(spark, sample, [cond("insured", "=", "1")]).status is Status.BAD_VALUE
    assert count(spark, sample, [cond("no_such_column", "=", "1")]).status is Status.BAD_FIELD
    assert count(spark, sample, [cond("depot", "=", None)]).status is Status.BAD_VALUE


def test_quotes_in_values_are_data(spark, sample):  # D5
    assert count(spark, sample, [cond("depot", "=", "o'hare")]) == 0
    assert count(spark, sample, [cond("depot", "=", "x' or '1'='1")]) == 0


def test_operator_allow_list(spark, sample):  # P7
    for op in ["=>", "IN", "BETWEEN", "IS", "", None, "; drop"]:
        assert count(spark, sample, [cond("net_g", op, "1")]).status is Status.BAD_OPERATOR


def test_connectors(spark, sample):  # P9, D6, D7, D9, D11
    assert count(spark, sample, [cond("depot", "=", "mill", "AND"), cond("net_g", ">", "3000")]) == 3
    assert count(spark, sample, [cond("depot", "=", "mill", "and"), cond("net_g", ">", "3000")]) == 3
    assert count(spark, sample, [cond("depot", "=", "quay", "or"), cond("net_g", ">", "10000")]) == 3
    r = count(spark, sample, [cond("depot", "=", "mill", ""), cond("net_g", ">", "3000")])
    assert r.status is Status.MISSING_CONNECTOR
    r = count(spark, sample, [cond("depot", "=", "mill", None), cond("net_g", ">", "3000")])
    assert r.status is Status.MISSING_CONNECTOR
    assert count(spark, sample, [cond("depot", "=", "mill", "AND")]).status is Status.TRAILING_CONNECTOR
    r = count(spark, sample, [cond("depot", "=", "mill", "XOR"), cond("net_g", ">", "3000")])
    assert r.status is Status.BAD_CONNECTOR
    assert count(spark, sample, [cond("depot", "=", "mill", None)]) == 7  # null join on the last = none


def test_goto_precedence_and_connectors(spark, sample):  # C1, D7, D8, D9, D10
    def chain(first, second):
        cat = catalog_of(spark, [rule("a", first, ("goto", "b")), rule("b", second)])
        return apply_rule(sample, cat, "a", as_of=AS_OF).count()

    # a OR b goto c  ==  a OR (b AND c)
    n = chain([cond("depot", "=", "quay", "OR"), cond("net_g", ">=", "8000")], [cond("van", "=", "2")])
    assert n == sample.filter("depot = 'quay' or (net_g >= 8000 and van = 2)").count() == 4
    # trailing OR on the last condition links to the target with OR
    n = chain([cond("depot", "=", "quay", "OR")], [cond("van", "=", "2")])
    assert n == sample.filter("depot = 'quay' or van = 2").count()
    # blank joins inside a target mean AND; OR inside a target is honoured
    n = chain([cond("depot", "=", "mill")], [cond("van", "=", "1", ""), cond("net_g", ">", "1000")])
    assert n == sample.filter("depot = 'mill' and van = 1 and net_g > 1000").count()
    n = chain([cond("depot", "=", "mill")], [cond("van", "=", "3", "OR"), cond("net_g", ">", "9000")])
    assert n == sample.filter("depot = 'mill' and van = 3 or net_g > 9000").count()


def test_fold_matches_sql_precedence():
    conns = ["OR", "AND", "OR", "AND", None]
    assert fold_terms(list("abcde"), conns) == "(a OR (b AND c) OR (d AND e))"
    assert fold_terms(["a"], [None]) == "a"


def test_date_and_timestamp_literals(spark, orders_small):
    cat = catalog_of(spark, [rule("t", [cond("o_orderdate", ">=", "1998-01-01")]),
                             rule("d", [cond("cast(o_orderdate as date)", "<", "1993-01-01")]),
                             rule("bad", [cond("o_orderdate", ">=", "01/01/1998")])])
    assert apply_rule(orders_small, cat, "t", as_of=AS_OF).count() == orders_small.filter(
        "o_orderdate >= timestamp_ntz'1998-01-01 00:00:00'").count()
    assert apply_rule(orders_small, cat, "d", as_of=AS_OF).count() == orders_small.filter(
        "cast(o_orderdate as date) < date'1993-01-01'").count()
    res = evaluate(cat, "identification", "query_builder", "bad", "false", df=orders_small, as_of=AS_OF)
    assert res.status is Status.BAD_VALUE


@pytest.mark.parametrize("value,expected", [("400000", 400000), ("400000.50", None)])
def test_double_column_literals(spark, orders_small, value, expected):
    cat = catalog_of(spark, [rule("r", [cond("o_totalprice", ">=", value)])])
    n = apply_rule(orders_small, cat, "r", as_of=AS_OF).count()
    assert n == orders_small.filter(f"o_totalprice >= {value}").count()


def test_long_goto_chain_is_one_balanced_predicate(spark, orders_small):
    n = 300
    rules = [rule(f"c{i}", [cond("o_totalprice", ">=", str(i))], ("goto", f"c{i + 1}") if i < n - 1 else ("", ""))
             for i in range(n)]
    cat = catalog_of(spark, rules)
    res = evaluate(cat, "identification", "query_builder", "c0", "false", df=orders_small, apply=True, as_of=AS_OF)
    assert res.ok and len(res.chain) == n
    assert res.df.count() == orders_small.filter(f"o_totalprice >= {n - 1}").count()


def test_number_forms_on_numeric_columns(spark, sample):
    assert count(spark, sample, [cond("net_g", ">=", "1.1e4")]) == 2
    assert count(spark, sample, [cond("net_g", "<", "99999999999999999999999")]) == 9
    assert count(spark, sample, [cond("net_g", ">", " 10000 ")]) == 2


def test_bound_text_is_typed_sql(spark, sample):
    cat = catalog_of(spark, [rule("r", [cond("zone", "=", "036", "OR"),
                                        cond("insured", "=", "TRUE", "AND"),
                                        cond("net_g", ">=", "11000.5")])])
    res = evaluate(cat, "identification", "query_builder", "r", "false", df=sample, as_of=AS_OF)
    assert res.text == ("(TRY_CAST((zone) AS BIGINT) = 36 OR "
                        "((insured) = true AND (net_g) >= 11000.5))")
    assert sample.filter(res.text).count() == sample.filter(res.predicate).count() == 2
    unbound = evaluate(cat, "identification", "query_builder", "r", "false", as_of=AS_OF)
    assert unbound.text.startswith("((zone) = 036 OR")
