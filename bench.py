"""Benchmark: headline rule queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Prints one JSON line. Every query is fully executed through the ``noop``
sink (all rows produced, nothing collected to the driver), with a fresh plan
per repeat (median of ``BENCH_REPEATS``, default 5). ``value`` is the sum of
the headline queries. Besides the registered queries it measures: N
generated rules over lineitem in one pass (``tag_all``, ``rule_hit_counts``)
against one filtered scan per rule; 100 rule calls resolved and bound
without running (driver cost); and, under ``jobs``, the Spark jobs a catalog
load, a rule call and a 100-rule pass start.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ruleloom import RuleCatalog, apply_rule, evaluate, rule_hit_counts, tag_all  # noqa: E402
from ruleloom import tpch  # noqa: E402
from ruleloom.session import local_session  # noqa: E402

HEADLINE = [
    "staged_filter", "query_lookup", "goto_or_precedence", "goto_chain", "expr_left", "conditional_guard",
    "value_in_props", "tag_all", "transform", "group_lookup", "time_span",
]
REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))


def generated_rules(n: int) -> str:
    """``n`` builder rules over lineitem, thresholds spread by a rule."""
    rules = []
    for i in range(n):
        kind = i % 4
        if kind == 0:
            when = [{"field_name": "l_extendedprice", "operator": ">=", "field_value": str(1000 + 950 * i), "join": ""}]
        elif kind == 1:
            when = [{"field_name": "l_quantity", "operator": ">", "field_value": str(i % 50), "join": "AND"},
                    {"field_name": "l_returnflag", "operator": "=", "field_value": "ARN"[i % 3], "join": ""}]
        elif kind == 2:
            when = [{"field_name": "l_extendedprice * (1 - l_discount)", "operator": "<", "field_value": str(500 * (i + 1)),
                     "join": "OR"},
                    {"field_name": "l_linestatus", "operator": "=", "field_value": "FO"[i % 2], "join": ""}]
        else:
            when = [{"field_name": "l_shipdate", "operator": ">=", "field_value": f"199{2 + i % 7}-0{1 + i % 9}-01",
                     "join": "AND"},
                    {"field_name": "l_discount", "operator": "<=", "field_value": f"0.0{i % 10}", "join": ""}]
        rules.append({"id": f"g{i}", "name": "gen", "description": "generated", "is_valid": "true",
                      "valid_from": "01/01/2020", "valid_till": "31/12/2999", "process": "identification",
                      "process_key": "query_builder", "is_lookup": "false", "when": when,
                      "then": {"field_name": "", "field_value": ""}})
    return json.dumps({"rules": rules})


def jobs_of(spark, fn) -> int:
    """Spark jobs started by ``fn`` (counted with a job group)."""
    sc = spark.sparkContext
    group = f"bench-{time.perf_counter_ns()}"
    sc.setJobGroup(group, "job count")
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int = REPEATS) -> float:
    times = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")),
                          app="ruleloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]

    queries = tpch.QUERIES
    results: dict[str, float] = {}
    results["rule_load"] = timed(lambda: RuleCatalog.load(spark, tpch.RULES_PATH).rules_with_id("ord_large"))
    tpch.catalog(spark).rules_with_id("ord_large")  # session catalog, loaded once
    run(queries["staged_filter"](spark, sf_dir))  # warm-up (JVM, file listing)
    for name in HEADLINE:
        results[name] = timed(lambda n=name: run(queries[n](spark, sf_dir)))

    lineitem = tpch.table(spark, sf_dir, "lineitem")
    cat0 = tpch.catalog(spark)
    # driver side only: 100 rule calls resolved and bound to a table (no job runs)
    results["evaluate_100_calls"] = timed(lambda: [
        evaluate(cat0, "identification", "conditional", "li_cond", "true", df=lineitem, apply=True, as_of=tpch.AS_OF)
        for _ in range(100)])
    for n in (1, 10, 100):
        cat = RuleCatalog.from_json(spark, generated_rules(n))
        ids = [f"g{i}" for i in range(n)]
        cat.rules_with_ids(ids)
        results[f"tag_all_{n}_rules"] = timed(lambda c=cat, i=ids: run(tag_all(lineitem, c, i, as_of=tpch.AS_OF)))
        results[f"hit_counts_{n}_rules"] = timed(
            lambda c=cat, i=ids: rule_hit_counts(lineitem, c, i, as_of=tpch.AS_OF).collect())
        # the one-scan-per-rule way, for comparison (100 scans: timed once)
        results[f"scan_per_rule_{n}_rules"] = timed(
            lambda c=cat, i=ids: [run(apply_rule(lineitem, c, r, as_of=tpch.AS_OF)) for r in i],
            repeats=REPEATS if n <= 10 else 1)

    # Spark jobs per step (the old way: ~6 per rule call before touching data)
    cat100 = RuleCatalog.from_json(spark, generated_rules(100))
    jobs = {
        "catalog_load": jobs_of(spark, lambda: RuleCatalog.load(spark, tpch.RULES_PATH).rules_with_id("x")),
        "rule_call_without_execution": jobs_of(spark, lambda: evaluate(
            cat0, "identification", "conditional", "li_cond", "true", df=lineitem, apply=True, as_of=tpch.AS_OF)),
        "tag_all_100_rules_incl_load": jobs_of(spark, lambda: run(tag_all(
            lineitem, cat100, [f"g{i}" for i in range(100)], as_of=tpch.AS_OF))),
    }

    total = round(sum(v for k, v in results.items() if k in HEADLINE), 4)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": results,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus, "jobs": jobs}))
    spark.stop()


if __name__ == "__main__":
    main()
