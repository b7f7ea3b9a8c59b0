"""Rules over an orders table: check the document, tag, filter in stages, total per customer.

    python examples/rules_on_orders.py [folder with orders.parquet]
"""

from __future__ import annotations

import datetime as dt
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from ruleloom import RuleCatalog, apply_stages, group_lookup, tag_all, validate_rules  # noqa: E402
from ruleloom.session import local_session  # noqa: E402
from ruleloom.tpch import RULES_PATH  # noqa: E402

AS_OF = dt.date(2022, 3, 1)


def main(folder: str) -> None:
    spark = local_session(app="rules-on-orders")
    rules = RuleCatalog.load(spark, RULES_PATH)
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    validate_rules(rules, as_of=AS_OF).filter("status <> 'ok'").show(truncate=False)
    tag_all(orders, rules, ["ord_large", "off", "ord_f"], as_of=AS_OF, errors="skip").groupBy("hits").count().show()
    large = apply_stages(orders, rules, ["ord_filter", "ord_large"], as_of=AS_OF)
    group_lookup(large, rules, "grp", {"orders": F.count(F.lit(1)), "last": F.max("o_orderdate")}, as_of=AS_OF).show(5)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")
