"""Job entry point (``spark-submit -m``-style or ``python -m ruleloom``).

  validate --rules R [--as-of D]                      per-rule status, chains included
  apply    --rules R --input P --rule ID [--rule ID…] --output O [--format parquet|csv] [--as-of D]
           [--tag] [--input-format csv --schema DDL]  run rules as stages (or tag with all of them)

A rule is named by its id, or where ids repeat by ``ID@process/key/flag`` (parts may be left empty or out).

CSV input needs its schema (a DDL string): inferring it would read the
whole input an extra time.

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings given to spark-submit apply unchanged.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from .operators.actions import tag_all, validate_rules
from .operators.apply import RuleAddress, apply_stages
from .plans.catalog import RuleCatalog


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ruleloom")
    sub = p.add_subparsers(dest="cmd", required=True)
    v = sub.add_parser("validate", help="status of every rule")
    v.add_argument("--rules", required=True)
    v.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    a = sub.add_parser("apply", help="apply rules to a table and write the result")
    a.add_argument("--rules", required=True)
    a.add_argument("--input", required=True)
    a.add_argument("--input-format", default="parquet", choices=["parquet", "csv"])
    a.add_argument("--schema", default=None, help="DDL schema of a CSV input, e.g. 'id bigint, city string'")
    a.add_argument("--rule", action="append", required=True, dest="rules_to_apply")
    a.add_argument("--output", required=True)
    a.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    a.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    a.add_argument("--tag", action="store_true", help="add a `hits` column instead of filtering")
    return p


def _address(catalog: RuleCatalog, text: str) -> str | RuleAddress:
    """``ID`` (also one that holds an @) or ``ID@process/key/flag``."""
    rid, at, rest = text.rpartition("@")
    if not at or catalog.rules_with_id(text):
        return text
    parts = [p or None for p in rest.split("/")]
    return RuleAddress(rid, *(parts + [None] * 3)[:3])


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("ruleloom").getOrCreate()
    catalog = RuleCatalog.load(spark, args.rules)
    if args.cmd == "validate":
        rows = validate_rules(catalog, args.as_of).collect()
        for r in rows:
            print(f"{r['rule_id']}\t{r['status']}\t{r['chain'] or ''}\t{r['message']}")
        return 0 if all(r["status"] == "ok" for r in rows) else 1
    if args.input_format == "csv":
        if not args.schema:
            raise SystemExit("--schema is required for CSV input")
        facts = spark.read.option("header", True).schema(args.schema).csv(args.input)
    else:
        facts = spark.read.parquet(args.input)
    rules = [_address(catalog, text) for text in args.rules_to_apply]
    if args.tag:
        out = tag_all(facts, catalog, rules, as_of=args.as_of)
    else:
        out = apply_stages(facts, catalog, rules, as_of=args.as_of)
    writer = out.write.mode("errorifexists")
    if args.format == "csv":
        writer = writer.option("header", True)
    writer.format(args.format).save(args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
