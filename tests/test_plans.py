"""Plan shape: rules become pushed filters over one scan, no shuffle for filters."""

import re

from conftest import AS_OF, SF_SMALL

from ruleloom import apply_stages, tag_all
from ruleloom import tpch


def n_scans(text):
    return len(re.findall(r"^\(\d+\) Scan parquet", text, re.M))


def plan_text(df):
    """The ``explain("formatted")`` text (untruncated)."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_stages_collapse_into_one_pushed_filter(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    out = apply_stages(li, tpch.catalog(spark), ["li_filter", "li_cond"], as_of=AS_OF)
    text = plan_text(out)
    assert n_scans(text) == 1
    assert "Exchange" not in text
    assert "EqualTo(l_returnflag,R)" in text and "PushedFilters" in text
    assert "In(l_linestatus, [F,X])" in text


def test_column_pruning_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    out = tpch.apply_rule(orders, tpch.catalog(spark), "ord_c1", as_of=AS_OF).select("o_orderkey")
    text = plan_text(out)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" in text
    assert "StringStartsWith(o_orderpriority,1)" in text


def test_tag_all_is_one_scan_no_shuffle(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    out = tag_all(orders, tpch.catalog(spark), tpch.TAG_RULES, as_of=AS_OF)
    text = plan_text(out)
    assert n_scans(text) == 1 and "Exchange" not in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_group_lookup_aggregates_map_side(spark):
    out = tpch.group_lookup_query(spark, SF_SMALL)
    text = plan_text(out)
    # partial aggregation before the shuffle (skew-safe for algebraic aggregates)
    assert "partial_count" in text and "partial_sum" in text


def test_lookup_parses_json_once(spark):
    text = plan_text(tpch.value_in_props(spark, SF_SMALL))
    assert text.count("from_json(") == 1 and "get_json_object" not in text
    assert "ReadSchema: struct<event_id:bigint,props:string>" in text
    assert "Exchange" not in text and "BatchEvalPython" not in text


def test_time_span_pre_aggregates_before_the_shuffle(spark):
    text = plan_text(tpch.time_span_query(spark, SF_SMALL))
    assert "partial_count" in text and "partial_min" in text and "partial_max" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text
