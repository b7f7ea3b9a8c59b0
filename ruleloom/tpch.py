"""Rule queries over the driver's tables, each with an equivalent SQL oracle.

Every query reads whole tables from ``sf_dir`` and applies rules from the
fixture document shipped with the package (``resources/tpch_rules.json``).
``AS_OF`` pins the validity-window date so results never depend on the clock.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.lookups import explode_pairs
from .operators.actions import bind_statuses, rule_hit_counts, tag, tag_all, transform
from .operators.aggregate import exact_sum, group_lookup, time_span
from .operators.apply import apply_rule, apply_stages, evaluate
from .operators.lookups import match_lookup, match_lookups
from .operators.prefixes import match_prefixes, without_prefixes
from .operators.ranking import exact_statistics, row_positions, top_k
from .operators.sessions import sessions, stretches
from .operators.versions import hits_in_force, tag_in_force
from .plans.catalog import RuleCatalog
from .session import shared_path
from .sources.audited import read_runs, write_tagged
from .sources.readers import CSV_NULL, escape_breaks, read_csv, read_csv_checked, read_table, register
from .sources.sinks import append_audit, hits_audit_frame, new_run_id, read_audit, write_csv

AS_OF = _dt.date(2022, 3, 1)
RULES_PATH = os.path.join(os.path.dirname(__file__), "resources", "tpch_rules.json")

# rules evaluated together by the multi-rule queries
TAG_RULES = ["ord_large", "ord_f", "ord_or_goto", "ord_c1", "ord_digits"]
SKIP_RULES = ["ord_large", "off", "expired", "dangling", "loop_a", "ord_f"]
HIT_RULES = ["ord_filter", "ord_large", "ord_and", "ord_or", "ord_or_goto", "ord_c1", "ord_digits", "ord_cond"]

# rules of the index queries, of the lookup division, and of those with versions
INDEX_RULES = 1000
LOOKUP_RULES = 400
VERSIONED_RULES = 24
PREFIX_RULES = 900
# orders a status reported by the top-k query
TOP_ORDERS = 1200

_CATALOGS: dict[tuple[int, str, str], RuleCatalog] = {}


def catalog(spark: SparkSession, path: str = RULES_PATH) -> RuleCatalog:
    """The fixture catalog, loaded once per session."""
    key = (id(spark), spark.sparkContext.applicationId, path)
    if key not in _CATALOGS:
        _CATALOGS[key] = RuleCatalog.load(spark, path)
    return _CATALOGS[key]


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, resolved once per session (file listing and footers
    are read once, like a catalog table; the data is not cached)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES or _TABLES[key].sparkSession is not spark:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _apply(name: str, rule_id: str, guard: bool = False):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return apply_rule(table(spark, sf_dir, name), catalog(spark), rule_id, as_of=AS_OF, guard=guard)

    return q


def staged_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship (C4 + C2): filtration by a lookup query, then identification
    entered through a conditional rule that jumps to a builder rule."""
    return apply_stages(table(spark, sf_dir, "lineitem"), catalog(spark), ["li_filter", "li_cond"], as_of=AS_OF)


def conditional_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 through the call protocol: ``conditional`` key, lookup flag true."""
    res = evaluate(catalog(spark), "identification", "conditional", "ord_cond", "true",
                   df=table(spark, sf_dir, "orders"), apply=True, as_of=AS_OF)
    return res.raise_for_status().df


def value_in_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 on data: events whose JSON ``props`` hold the rule's lookup pair."""
    ev = table(spark, sf_dir, "events")
    return match_lookup(ev, catalog(spark), "ev_k", "props", as_of=AS_OF).select("event_id", "k")


def lookup_rules(n: int) -> str:
    """A document of ``n`` value lookups over events' facts, values spread by a rule."""
    def pairs(i: int) -> str:
        kind = ("view", "signup", "click", "error", "purchase")[i % 5]
        if i % 4 == 0:
            return f'{{"k": {i % 100}.0}}'
        if i % 4 == 1:
            return f'{{"type": "{kind}", "k": {i % 100}}}'
        if i % 4 == 2:
            return f'{{"type": "{kind}", "shard": {i % 7}e0, "k": {i % 50}}}'
        return f'{{"type": "{kind}", "shard": "{i % 7}", "none": null}}'

    rules = [{"id": f"v{i}", "is_valid": "true", "valid_from": "01/01/2020", "valid_till": "31/12/2999", "process": "identification", "process_key": "value_lookup",
              "is_lookup": "true", "when": [{"lookup_value": pairs(i)}], "then": {"field_name": "", "field_value": ""}} for i in range(n)]
    return json.dumps({"rules": rules})


def lookup_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1/L2 x 400: every event with every lookup whose pairs its facts all hold."""
    cat = RuleCatalog.from_json(spark, lookup_rules(LOOKUP_RULES))
    kind = F.concat(F.lit('{"type": "'), "event_type", F.lit('", "shard": '), (F.col("user_id") % 7).cast("string"), F.lit(', "none": null, '))
    facts = table(spark, sf_dir, "events").select("event_id", F.concat(kind, F.substring("props", 2, 1 << 20)).alias("facts"))
    return match_lookups(facts, cat, cat.all_ids(), "facts", as_of=AS_OF).select("event_id", "rule_id")


def value_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 on data: every (key, value) pair of the ``props`` objects."""
    return explode_pairs(table(spark, sf_dir, "events"), "props", ["event_id"])


def transform_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    out = transform(li, catalog(spark), "net_r", as_of=AS_OF)
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "net_returned")


def tag_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return tag(orders, catalog(spark), "ord_large", as_of=AS_OF)


def tag_all_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return tag_all(orders, catalog(spark), TAG_RULES, as_of=AS_OF).select("o_orderkey", "hits")


def index_rules(n: int) -> str:
    """A document of ``n`` builder rules over lineitem, values spread by a rule, most of them selective."""
    def when(*conditions):
        return [{"field_name": f, "operator": o, "field_value": v, "join": j} for f, o, v, j in conditions]

    def conditions(i: int) -> list[dict]:
        if i % 4 == 0:
            return when(("l_extendedprice", ">=", str(1000 + 95 * i), "AND"), ("l_extendedprice", "<", str(1900 + 95 * i), "AND"), ("l_returnflag", "=", "ARN"[i % 3], ""))
        if i % 4 == 1:
            return when(("l_quantity", "=", str(1 + i % 50), "AND"), ("l_discount", "<=", f"0.0{i % 10}", "AND"), ("l_shipdate", "<", f"199{2 + i % 7}-0{1 + i % 9}-01", ""))
        if i % 4 == 2:
            return when(("l_extendedprice * (1 - l_discount)", "<", str(1000 + i), "OR"), ("l_partkey", "=", str(i), "AND"), ("l_linestatus", "!=", "F", ""))
        return when(("l_suppkey", "=", str(i), "OR"), ("l_tax", ">", "0.075", "AND"), ("l_linenumber", "<", "2", "AND"), ("l_partkey", "<", str(2 * i), ""))

    rules = [{"id": f"r{i}", "is_valid": "true", "valid_from": "01/01/2020", "valid_till": "31/12/2999", "process": "identification", "process_key": "query_builder",
              "is_lookup": "false", "when": conditions(i), "then": {"field_name": "", "field_value": ""}} for i in range(n)]
    return json.dumps({"rules": rules})


def tag_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 x 1,000 in one pass over lineitem, through the index over the rules' conditions."""
    cat = RuleCatalog.from_json(spark, index_rules(INDEX_RULES))
    tagged = tag_all(table(spark, sf_dir, "lineitem"), cat, cat.all_ids(), as_of=AS_OF)
    return tagged.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "hits")


def hits_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows hit by each of the 1,000 rules, in one scan."""
    cat = RuleCatalog.from_json(spark, index_rules(INDEX_RULES))
    return rule_hit_counts(table(spark, sf_dir, "lineitem"), cat, cat.all_ids(), as_of=AS_OF)


def versioned_rules(n: int) -> str:
    """``n`` rules over orders, each with a version for most years, the threshold rising by the year."""
    def version(i: int, year: int) -> dict:
        when = [{"field_name": "o_totalprice", "operator": ">=", "field_value": str(20_000 * i + 5_000 * (year - 1994)), "join": "AND"},
                {"field_name": "o_orderpriority", "operator": "LIKE" if i % 2 else ">=", "field_value": f"{1 + year % 5}-" if i % 2 else "2-", "join": ""}]
        return {"id": f"t{i}", "is_valid": "false" if (i + year) % 5 == 0 else "true", "valid_from": f"01/0{1 + i % 6}/{year}", "valid_till": f"15/0{1 + i % 6}/{year + 1}",
                "process": "identification", "process_key": "query_builder", "is_lookup": "false", "when": when, "then": {"field_name": "", "field_value": ""}}

    return json.dumps({"rules": [version(i, year) for year in range(1994, 2003) for i in range(n)]})


def tag_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 per row: orders tagged by the version of each rule in force on ``o_orderdate``."""
    cat = RuleCatalog.from_json(spark, versioned_rules(VERSIONED_RULES))
    return tag_in_force(table(spark, sf_dir, "orders"), cat, cat.all_ids(), "o_orderdate").select("o_orderkey", "o_orderdate", "hits")


def version_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a range join: every order with every version in force that it meets."""
    cat = RuleCatalog.from_json(spark, versioned_rules(VERSIONED_RULES))
    found = hits_in_force(table(spark, sf_dir, "orders"), cat, cat.all_ids(), "o_orderdate")
    return found.select("o_orderkey", "rule_id", "valid_from", "valid_till")


def tag_actions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    out = tag_all(orders, catalog(spark), TAG_RULES, as_of=AS_OF, set_actions=True)
    return out.select("o_orderkey", "hits", "is_large", "is_finished", "is_urgent_big")


def transform_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return transform(li, catalog(spark), "net", as_of=AS_OF).select("l_orderkey", "l_linenumber", "l_partkey", "net")


def group_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return group_lookup(orders, catalog(spark), "grp", {
        "n_rows": F.count(F.lit(1)),
        "total_amount": exact_sum("o_totalprice", 2),
        "min_date": F.min("o_orderdate"),
        "max_date": F.max("o_orderdate"),
    }, as_of=AS_OF)


def group_lookup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return group_lookup(ev, catalog(spark), "ev_grp", {
        "n_events": F.count(F.lit(1)),
        "total_value": exact_sum("value", 2),
        "first_ts": F.min("ts"),
        "last_ts": F.max("ts"),
    }, as_of=AS_OF)


def time_span_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return time_span(ev, ["user_id"], "ts", "value", 30, per_day=True, min_events=2, order=True, amount_scale=2)


def time_span_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 as it stands: spans over all days, groups of one event included."""
    ev = table(spark, sf_dir, "events")
    return time_span(ev, ["user_id", "event_type"], "ts", "value", 30_000, amount_scale=2)


def sessions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 inside a key: a user's events without a pause of more than four hours."""
    return sessions(table(spark, sf_dir, "events"), ["user_id"], "ts", "value", 240, amount_scale=2)


def sessions_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where a third of all rows has one key (every third event, whoever's it is)."""
    ev = table(spark, sf_dir, "events").withColumn("who", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    return sessions(ev, ["who"], "ts", "value", 10, amount_scale=2)


def stretches_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 inside a key: stretches of 30 minutes in which a user did two things or more."""
    return stretches(table(spark, sf_dir, "events"), ["user_id"], "ts", "value", 30, min_events=2, amount_scale=2)


def sessions_drained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions of the event stream, drained and closed, read back. The table is one batch, so no row is late."""
    from .streaming.sessions import sessions_to_parquet
    from .streaming.stream import parquet_stream

    stream = parquet_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", like=table(spark, sf_dir, "events"))
    run = sessions_to_parquet(stream, ["user_id"], "ts", "value", 240, 60, close=True)
    return spark.read.parquet(run.path).withColumn("total_amount", F.round("total_amount", 2))


def statistics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, exactly: distinct prices, most frequent and middle price by return flag (three keys hold all rows)."""
    return exact_statistics(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice")


def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: every line item's place by price, without a window over the table."""
    li = table(spark, sf_dir, "lineitem")
    rest = [c for c in li.columns if c != "l_extendedprice"]
    return row_positions(li, ["-l_extendedprice", *rest]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "position")


def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 a key: the dearest orders of each status (three keys hold all rows)."""
    return top_k(table(spark, sf_dir, "orders"), ["o_orderstatus"], ["-o_totalprice", "o_orderkey"], TOP_ORDERS)


def group_lookup_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 over values of more than two decimals."""
    li = table(spark, sf_dir, "lineitem")
    return group_lookup(li, catalog(spark), "li_grp", {
        "n_rows": F.count(F.lit(1)),
        "revenue": exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4),
    }, as_of=AS_OF)


def csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + S1 over free text: line breaks, quotes, blanks and empty texts survive."""
    docs = table(spark, sf_dir, "documents")
    path = write_csv(docs, shared_path(spark, "csv-documents"), escaped_breaks=True)
    return read_csv(spark, path, docs.schema, escaped_breaks=True)


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 with a quarantine: documents as CSV lines, some of them broken by rule, parted into good rows and bad records."""
    docs = table(spark, sf_dir, "documents")
    named = F.concat(F.when(F.col("doc_id") % 11 == 3, F.lit("no. ")).otherwise(F.lit("")), F.col("doc_id").cast("string"))
    values = F.struct(named.alias("doc_id"), *[escape_breaks(F.col(c).cast("string")).alias(c) for c in docs.columns[1:]])
    line = F.to_csv(values, {"quoteAll": "true", "quote": '"', "escape": '"', "nullValue": CSV_NULL, "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    line = F.when(F.col("doc_id") % 13 == 5, F.concat(line, F.lit(',"one more"'))).otherwise(line)
    path = shared_path(spark, "csv-quarantine")
    docs.select(line.alias("value")).write.text(path)
    parts = read_csv_checked(spark, path, docs.schema, header=False, escaped_breaks=True)
    good = parts.good.select(F.lit("good").alias("part"), "*", F.lit(None).cast("string").alias("record"))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields]
    return good.unionByName(parts.bad.select(F.lit("bad").alias("part"), *empty, "record"))


def named_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules applied to a named view, their text run as a statement by the caller."""
    register(apply_rule(table(spark, sf_dir, "orders"), catalog(spark), "ord_filter", as_of=AS_OF), "orders_filtered")
    res = evaluate(catalog(spark), "identification", "query_builder", "ord_large", "false", df=read_table(spark, "orders_filtered"), as_of=AS_OF)
    return spark.sql(f"select * from orders_filtered where {res.raise_for_status().text}")


def tag_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Off, expired, dangling and cyclic rules are left out of the pass, and reported."""
    orders = table(spark, sf_dir, "orders")
    status = {rid: r.status.value for rid, r in bind_statuses(orders, catalog(spark), SKIP_RULES, as_of=AS_OF).items()}
    tagged = tag_all(orders, catalog(spark), SKIP_RULES, as_of=AS_OF, errors="skip").select("o_orderkey", "hits")
    return tagged.withColumn("left_out", F.lit(",".join(rid for rid in SKIP_RULES if status[rid] != "ok")))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + S1: a rule's output written as CSV and read back with its schema."""
    filtered = apply_rule(table(spark, sf_dir, "orders"), catalog(spark), "ord_filter", as_of=AS_OF)
    path = write_csv(filtered, shared_path(spark, "csv-round-trip"))
    return read_csv(spark, path, filtered.schema)


def rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits per rule over orders (one scan), appended to the audit log
    with each rule's status and predicate text, then read back."""
    cat = catalog(spark)
    orders = table(spark, sf_dir, "orders")
    hits = rule_hit_counts(orders, cat, HIT_RULES, as_of=AS_OF)
    results = {}
    for rid in HIT_RULES:
        r = cat.rules_with_id(rid)[0]
        results[rid] = evaluate(cat, r.process, r.process_key, rid, r.is_lookup, df=orders, as_of=AS_OF)
    run_id = new_run_id()
    path = shared_path(spark, "rule-audit", unique=False)
    append_audit(hits_audit_frame(hits, results, run_id), path, run_id)
    return read_audit(spark, path, run_id).select("rule_id", "status", "n_hits")


def audit_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 in the writing pass: orders written with their hits, the counts of each rule gathered on the way."""
    ids = HIT_RULES + SKIP_RULES[1:3]
    audit = shared_path(spark, "audited-runs", unique=False)
    run = write_tagged(table(spark, sf_dir, "orders"), catalog(spark), ids, shared_path(spark, "audited-orders"), audit, as_of=AS_OF)
    return read_runs(spark, audit, run.run_id).select("rule_id", "status", "n_hits", "n_rows")


#: Names that cheap parts begin with, three and eight letters of them.
_CHEAP = "p_retailprice < 1500"


def _part_prefixes(part: DataFrame) -> DataFrame:
    ends = F.explode(F.array(F.lit(3), F.lit(8))).alias("n")
    cheap = part.filter(_CHEAP).select("p_name", ends).select(F.substring("p_name", F.lit(1), F.col("n")).alias("prefix"))
    return cheap.unionByName(_rows(part, ["_ed %r", "b%k"]))


def _rows(df: DataFrame, texts: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(t,) for t in texts], "prefix string")


def prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 x N: every part with the longest registered beginning of its name."""
    part = table(spark, sf_dir, "part")
    return match_prefixes(part, "p_name", _part_prefixes(part)).select("p_partkey", "prefix")


def prefix_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 x N: parts whose brand and size, as one text, begins like that of no cheap part of a small size."""
    part = table(spark, sf_dir, "part").withColumn("tag", F.concat(F.col("p_brand"), F.lit(" "), F.col("p_size").cast("string"), F.lit(" "), F.col("p_type")))
    prefixes = part.filter("p_size < 20").select(F.substring_index("tag", " ", 2).alias("prefix"))
    return without_prefixes(part, "tag", prefixes)[0].select("p_partkey", "tag")


def prefix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 and P5 x 900 rules through the index: prefixes are ranges of texts."""
    def one(i: int) -> dict:
        text = f"Brand#{i % 30}{' ' if i % 3 else ''}{i % 50 + 1 if i % 3 else ''}"
        when = [{"field_name": "concat(p_brand, ' ', p_size)", "operator": "NOT LIKE" if i % 90 == 7 else "LIKE", "field_value": text, "join": "AND"},
                {"field_name": "p_partkey", "operator": "LIKE", "field_value": str(1 + i % 7), "join": ""}]
        return {"id": f"p{i}", "is_valid": "true", "valid_from": "01/01/2020", "valid_till": "31/12/2999", "process": "identification", "process_key": "query_builder",
                "is_lookup": "false", "when": when, "then": {"field_name": "", "field_value": ""}}

    cat = RuleCatalog.from_json(spark, json.dumps({"rules": [one(i) for i in range(PREFIX_RULES)]}))
    return tag_all(table(spark, sf_dir, "part"), cat, cat.all_ids(), as_of=AS_OF).select("p_partkey", "hits")


def stream_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule applied to a file stream of events; drained, then read back."""
    from .streaming.stream import filter_stream, parquet_stream, run_to_parquet

    src = f"{sf_dir.rstrip('/')}/events.parquet"
    stream = parquet_stream(spark, src)
    out = run_to_parquet(filter_stream(stream, catalog(spark), "ev_errors", as_of=AS_OF), name="ev_errors")
    return spark.read.schema(stream.schema).parquet(out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "staged_filter": staged_filter,
    "query_lookup": _apply("orders", "ord_filter"),
    "cmp_numeric": _apply("orders", "ord_large"),
    "cmp_and": _apply("orders", "ord_and"),
    "cmp_or": _apply("orders", "ord_or"),
    "goto_or_precedence": _apply("orders", "ord_or_goto"),
    "goto_chain": _apply("orders", "ord_c1"),
    "expr_left": _apply("lineitem", "li_net"),
    "like_prefix": _apply("part", "part_like"),
    "not_like_prefix": _apply("part", "part_not_like"),
    "like_digits": _apply("orders", "ord_digits"),
    "cmp_timestamp": _apply("events", "ev_errors"),
    "text_digits_numeric": _apply("supplier", "sup_num"),
    "goto_through_conditional": _apply("orders", "ord_via_cond"),
    "cmp_not_equal_negative": _apply("customer", "cust_neg"),
    "ilike_pattern": _apply("part", "brand_ilike"),
    "rlike_pattern": _apply("part", "part_rlike"),
    "cmp_date": _apply("orders", "ord_early"),
    "cmp_decimal_literal": _apply("part", "part_size"),
    "transform_conditional": transform_conditional,
    "conditional_entry": conditional_entry,
    "conditional_guard": _apply("orders", "ord_cond", guard=True),
    "value_in_props": value_in_props,
    "value_pairs": value_pairs,
    "lookup_division": lookup_division,
    "tag": tag_query,
    "tag_all": tag_all_query,
    "tag_index": tag_index,
    "hits_index": hits_index,
    "tag_versions": tag_versions,
    "version_hits": version_hits,
    "tag_actions": tag_actions_query,
    "transform": transform_query,
    "group_lookup": group_lookup_query,
    "group_lookup_events": group_lookup_events,
    "time_span": time_span_query,
    "time_span_plain": time_span_plain,
    "exact_statistics": statistics_query,
    "row_numbers": row_numbers,
    "top_orders": top_orders,
    "sessions": sessions_query,
    "sessions_hot": sessions_hot,
    "sessions_drained": sessions_drained,
    "stretches": stretches_query,
    "group_lookup_revenue": group_lookup_revenue,
    "csv_documents": csv_documents,
    "csv_quarantine": csv_quarantine,
    "named_flow": named_flow,
    "tag_skip": tag_skip,
    "csv_round_trip": csv_round_trip,
    "rule_hits": rule_hits,
    "audit_write": audit_write,
    "prefix_join": prefix_join,
    "prefix_anti_join": prefix_anti_join,
    "prefix_index": prefix_index,
    "stream_filter": stream_filter,
}

_ORD = "o_totalprice >= 400000"
_PRED = {
    "ord_filter": "o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "ord_large": _ORD,
    "ord_and": "o_totalprice >= 400000 AND o_orderstatus = 'O'",
    "ord_or": "o_totalprice >= 490000 OR o_orderpriority = '1-URGENT'",
    "ord_or_goto": "o_totalprice >= 490000 OR o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'",
    "ord_f": "o_orderstatus = 'F'",
    "ord_c1": "o_totalprice >= 300000 AND o_orderstatus = 'F' AND o_orderpriority LIKE '1%'",
    "ord_digits": "CAST(o_orderkey AS VARCHAR) LIKE '10%'",
    "ord_cond": _ORD,
}


# the generated rule ``i`` as SQL over a row of lineitem
_INDEX_RULE = """CASE i % 4
    WHEN 0 THEN l_extendedprice >= 1000 + 95 * i AND l_extendedprice < 1900 + 95 * i AND l_returnflag = substr('ARN', 1 + i % 3, 1)
    WHEN 1 THEN l_quantity = 1 + i % 50 AND l_discount <= CAST('0.0' || (i % 10) AS DOUBLE) AND l_shipdate < CAST('199' || (2 + i % 7) || '-0' || (1 + i % 9) || '-01' AS TIMESTAMP)
    WHEN 2 THEN l_extendedprice * (1 - l_discount) < 1000 + i OR l_partkey = i AND l_linestatus <> 'F'
    ELSE l_suppkey = i OR l_tax > 0.075 AND l_linenumber < 2 AND l_partkey < 2 * i END"""


# versions of the rules in force: a window runs half a month into the next one, where the earlier version goes on
_VERSIONS = f"""versions AS (SELECT i, y, 't' || i AS rule_id, make_date(y, CAST(1 + i % 6 AS INTEGER), 1) AS own_from, make_date(y + 1, CAST(1 + i % 6 AS INTEGER), 15) AS valid_till
    FROM range({VERSIONED_RULES}) r(i), (SELECT CAST(y AS INTEGER) AS y FROM range(1994, 2003) s(y)) s WHERE (i + y) % 5 <> 0),
pieces AS (SELECT *, greatest(own_from, coalesce(lag(valid_till) OVER (PARTITION BY i ORDER BY y) + INTERVAL 1 DAY, own_from)) AS start FROM versions),
met AS (SELECT o_orderkey, o_orderdate, i, rule_id, CAST(start AS DATE) AS valid_from, valid_till FROM orders JOIN pieces
    ON o_orderdate >= start AND o_orderdate < valid_till + INTERVAL 1 DAY AND o_totalprice >= 20000 * i + 5000 * (y - 1994)
    AND CASE WHEN i % 2 = 1 THEN starts_with(o_orderpriority, (1 + y % 5) || '-') ELSE o_orderpriority >= '2-' END)"""


def _sessions_sql(key: str, minutes: int) -> str:
    return (f"WITH cut AS (SELECT {key} AS who, ts, value, CASE WHEN ts - lag(ts) OVER w > INTERVAL {minutes} MINUTE THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY {key} ORDER BY ts)), "
            "runs AS (SELECT *, sum(new) OVER (PARTITION BY who ORDER BY ts) AS run FROM cut) "
            "SELECT who AS {0}, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events, round(sum(value), 2) AS total_amount, "
            "(epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(60000000 AS DOUBLE) AS minutes FROM runs GROUP BY who, run")


def _case_list(rules: list[str]) -> str:
    return ", ".join(f"CASE WHEN {_PRED[r]} THEN '{r}' END" for r in rules)


ORACLE_SQL: dict[str, str] = {
    "staged_filter": "SELECT * FROM (SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus IN ('F', 'X')) t "
                     "WHERE l_extendedprice - l_extendedprice * l_discount >= 60000",
    "query_lookup": f"SELECT * FROM orders WHERE {_PRED['ord_filter']}",
    "cmp_numeric": f"SELECT * FROM orders WHERE {_PRED['ord_large']}",
    "cmp_and": f"SELECT * FROM orders WHERE {_PRED['ord_and']}",
    "cmp_or": f"SELECT * FROM orders WHERE {_PRED['ord_or']}",
    "goto_or_precedence": f"SELECT * FROM orders WHERE {_PRED['ord_or_goto']}",
    "goto_chain": f"SELECT * FROM orders WHERE {_PRED['ord_c1']}",
    "expr_left": "SELECT * FROM lineitem WHERE l_extendedprice * (1 - l_discount) >= 80000",
    "like_prefix": "SELECT * FROM part WHERE p_type LIKE 'ECON%'",
    "not_like_prefix": "SELECT * FROM part WHERE p_type NOT LIKE 'ECON%'",
    "like_digits": f"SELECT * FROM orders WHERE {_PRED['ord_digits']}",
    "cmp_timestamp": "SELECT * FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-15 00:00:00'",
    "text_digits_numeric": "SELECT * FROM supplier WHERE TRY_CAST(substr(s_name, 10) AS BIGINT) < 50",
    "goto_through_conditional": f"SELECT * FROM orders WHERE o_orderstatus = 'O' AND {_ORD}",
    "cmp_not_equal_negative": "SELECT * FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' AND c_acctbal < -500.5",
    "ilike_pattern": "SELECT * FROM part WHERE p_brand ILIKE 'brand#1%'",
    "rlike_pattern": "SELECT * FROM part WHERE regexp_matches(p_name, '^(small|red) ')",
    "cmp_date": "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1996-01-01'",
    "cmp_decimal_literal": "SELECT * FROM part WHERE p_size >= 10.5 AND p_retailprice <= 1000",
    "transform_conditional": "SELECT l_orderkey, l_linenumber, l_returnflag, "
                             "CASE WHEN l_returnflag = 'R' THEN l_extendedprice - l_quantity END AS net_returned "
                             "FROM lineitem",
    "conditional_entry": f"SELECT * FROM orders WHERE {_ORD}",
    "conditional_guard": f"SELECT * FROM orders WHERE o_orderstatus = 'O' AND {_ORD}",
    "value_in_props": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events "
                      "WHERE json_extract_string(props, '$.k') = '9'",
    "value_pairs": "SELECT e.event_id, j.key AS key, j.value ->> '$' AS value FROM events e, json_each(e.props) j",
    "lookup_division": f"SELECT event_id, 'v' || i AS rule_id FROM (SELECT event_id, event_type AS t, user_id % 7 AS s, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e "
                       f"JOIN (SELECT i, list_extract(['view', 'signup', 'click', 'error', 'purchase'], 1 + i % 5) AS want FROM range({LOOKUP_RULES}) r(i)) r "
                       "ON CASE i % 4 WHEN 0 THEN k = i % 100 WHEN 1 THEN t = want AND k = i % 100 WHEN 2 THEN t = want AND s = i % 7 AND k = i % 50 ELSE t = want AND s = i % 7 END",
    "tag": f"SELECT o_orderkey, o_totalprice, CASE WHEN {_ORD} THEN 'true' END AS is_large FROM orders",
    "tag_all": f"SELECT o_orderkey, concat_ws(',', {_case_list(TAG_RULES)}) AS hits FROM orders",
    "tag_index": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
                 f"array_to_string(list_transform(list_filter(range({INDEX_RULES}), lambda i: {_INDEX_RULE}), lambda i: 'r' || i), ',') AS hits FROM lineitem",
    "hits_index": f"SELECT CAST(i AS INTEGER) AS rule_pos, 'r' || i AS rule_id, count(*) FILTER (WHERE {_INDEX_RULE}) AS n_hits "
                  f"FROM lineitem CROSS JOIN range({INDEX_RULES}) r(i) GROUP BY i",
    "tag_versions": f"WITH {_VERSIONS} SELECT o.o_orderkey, o.o_orderdate, coalesce(h.hits, '') AS hits FROM orders o "
                    "LEFT JOIN (SELECT o_orderkey, string_agg(rule_id, ',' ORDER BY i) AS hits FROM met GROUP BY o_orderkey) h ON o.o_orderkey = h.o_orderkey",
    "version_hits": f"WITH {_VERSIONS} SELECT o_orderkey, rule_id, valid_from, valid_till FROM met",
    "tag_actions": f"SELECT o_orderkey, concat_ws(',', {_case_list(TAG_RULES)}) AS hits, "
                   f"CASE WHEN {_ORD} THEN 'true' END AS is_large, "
                   f"CASE WHEN {_PRED['ord_f']} OR {_PRED['ord_or_goto']} THEN 'true' END AS is_finished, "
                   f"CASE WHEN {_PRED['ord_c1']} THEN 'true' END AS is_urgent_big FROM orders",
    "transform": "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice - l_quantity AS net FROM lineitem",
    "group_lookup": "SELECT o_custkey, count(*) AS n_rows, "
                    "round(sum(o_totalprice), 2) AS total_amount, "
                    "min(o_orderdate) AS min_date, max(o_orderdate) AS max_date FROM orders GROUP BY o_custkey",
    "group_lookup_events": "SELECT user_id, event_type, count(*) AS n_events, "
                           "round(sum(value), 2) AS total_value, "
                           "min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY user_id, event_type",
    "time_span": "SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_events, "
                 "round(sum(value), 2) AS total_amount, "
                 "min(ts) AS min_time, max(ts) AS max_time, "
                 "(epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(60000000 AS DOUBLE) AS minutes "
                 "FROM events GROUP BY user_id, CAST(ts AS DATE) "
                 "HAVING count(*) >= 2 AND (epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(60000000 AS DOUBLE) <= 30 "
                 "ORDER BY user_id, day",
    "time_span_plain": "SELECT user_id, event_type, count(*) AS n_events, round(sum(value), 2) AS total_amount, "
                       "min(ts) AS min_time, max(ts) AS max_time, "
                       "(epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(60000000 AS DOUBLE) AS minutes "
                       "FROM events GROUP BY user_id, event_type "
                       "HAVING (epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(60000000 AS DOUBLE) <= 30000",
    "exact_statistics": "WITH c AS (SELECT l_returnflag, l_extendedprice AS v, count(*) AS n FROM lineitem GROUP BY ALL) "
                        "SELECT s.*, mode, (median_low + median_high) / 2 AS median FROM (SELECT l_returnflag, count(*) AS n_rows, count(l_extendedprice) AS n_values, count(DISTINCT l_extendedprice) AS n_distinct, "
                        "list_sort(list(l_extendedprice))[(count(l_extendedprice) + 1) // 2] AS median_low, list_sort(list(l_extendedprice))[count(l_extendedprice) // 2 + 1] AS median_high FROM lineitem GROUP BY l_returnflag) s "
                        "JOIN (SELECT l_returnflag, first(v ORDER BY n DESC, v) AS mode FROM c WHERE v IS NOT NULL GROUP BY l_returnflag) m USING (l_returnflag)",
    "row_numbers": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber, "
                   "l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS position FROM lineitem",
    "top_orders": f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders) WHERE rank <= {TOP_ORDERS}",
    "sessions": _sessions_sql("user_id", 240).format("user_id"),
    "sessions_hot": _sessions_sql("CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END", 10).format("who"),
    "sessions_drained": _sessions_sql("user_id", 240).format("user_id"),
    "stretches": "SELECT * FROM (SELECT user_id, ts AS stretch_end, count(*) OVER w AS n_events, round(sum(value) OVER w, 2) AS total_amount FROM events "
                 "WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND CURRENT ROW)) WHERE n_events >= 2",
    "group_lookup_revenue": "SELECT l_suppkey, count(*) AS n_rows, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue "
                            "FROM lineitem GROUP BY l_suppkey",
    "csv_documents": "SELECT * FROM documents",
    "csv_quarantine": "WITH b AS (SELECT *, doc_id % 11 = 3 OR doc_id % 13 = 5 AS broken FROM documents), "
                      "q AS (SELECT *, '\"' || CASE WHEN doc_id % 11 = 3 THEN 'no. ' ELSE '' END || doc_id || '\",\"' "
                      "|| replace(replace(replace(replace(text, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), '\"', '\"\"') || '\",\"' || lang || '\",\"' || source || '\",\"' || n_chars || '\"' "
                      "|| CASE WHEN doc_id % 13 = 5 THEN ',\"one more\"' ELSE '' END AS line FROM b) "
                      "SELECT CASE WHEN broken THEN 'bad' ELSE 'good' END AS part, CASE WHEN NOT broken THEN doc_id END AS doc_id, CASE WHEN NOT broken THEN text END AS text, "
                      "CASE WHEN NOT broken THEN lang END AS lang, CASE WHEN NOT broken THEN source END AS source, CASE WHEN NOT broken THEN n_chars END AS n_chars, "
                      "CASE WHEN broken THEN line END AS record FROM q",
    "named_flow": f"SELECT * FROM orders WHERE {_PRED['ord_filter']} AND {_ORD}",
    "tag_skip": f"SELECT o_orderkey, concat_ws(',', {_case_list(['ord_large', 'ord_f'])}) AS hits, "
                "'off,expired,dangling,loop_a' AS left_out FROM orders",
    "csv_round_trip": f"SELECT * FROM orders WHERE {_PRED['ord_filter']}",
    "rule_hits": " UNION ALL ".join(
        f"SELECT '{r}' AS rule_id, 'ok' AS status, count(*) FILTER (WHERE {_PRED[r]}) AS n_hits FROM orders"
        for r in HIT_RULES
    ),
    "audit_write": " UNION ALL ".join(
        [f"SELECT '{r}' AS rule_id, 'ok' AS status, count(*) FILTER (WHERE {_PRED[r]}) AS n_hits, count(*) AS n_rows FROM orders" for r in HIT_RULES]
        + [f"SELECT '{r}', '{state}', NULL, count(*) FROM orders" for r, state in zip(SKIP_RULES[1:3], ("off", "out_of_window"))]
    ),
    "prefix_join": f"WITH plain AS (SELECT DISTINCT substr(p_name, 1, n) AS prefix FROM part, (VALUES (3), (8)) v(n) WHERE {_CHEAP}), "
                   "met AS (SELECT p_partkey, prefix FROM part JOIN plain ON starts_with(p_name, prefix) "
                   "UNION SELECT p_partkey, prefix FROM part JOIN (VALUES ('_ed %r'), ('b%k')) w(prefix) ON p_name LIKE prefix || '%') "
                   "SELECT p_partkey, first(prefix ORDER BY length(prefix) DESC, prefix) AS prefix FROM met GROUP BY p_partkey",
    "prefix_anti_join": "WITH p AS (SELECT p_partkey, p_size, p_brand || ' ' || p_size || ' ' || p_type AS tag, p_brand || ' ' || p_size AS head FROM part) "
                        "SELECT p_partkey, tag FROM p WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT head FROM p WHERE p_size < 20) q WHERE starts_with(p.tag, q.head))",
    "prefix_index": "SELECT p_partkey, array_to_string(list_transform(list_filter(range(" + str(PREFIX_RULES) + "), lambda i: starts_with(CAST(p_partkey AS VARCHAR), CAST(1 + i % 7 AS VARCHAR)) AND "
                    "(starts_with(p_brand || ' ' || p_size, 'Brand#' || (i % 30) || CASE WHEN i % 3 = 0 THEN '' ELSE ' ' || (i % 50 + 1) END) <> (i % 90 = 7))), lambda i: 'p' || i), ',') AS hits FROM part",
    "stream_filter": "SELECT * FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-15 00:00:00'",
}
