"""The job entry point, run in-process on the test session."""

from conftest import SF_SMALL

from ruleloom import tpch
from ruleloom.__main__ import main
from ruleloom.session import shared_path


def test_validate_exit_code_and_output(spark, capsys):
    assert main(["validate", "--rules", tpch.RULES_PATH, "--as-of", "2022-03-01"], spark) == 1  # fixtures hold broken rules
    out = capsys.readouterr().out
    assert "ord_c1\tok\tord_c1 -> ord_c2 -> ord_c3" in out and "loop_a\tgoto_cycle" in out


def test_apply_stages_and_tag(spark):
    out = shared_path(spark, "t-cli-apply")
    args = ["apply", "--rules", tpch.RULES_PATH, "--input", f"{SF_SMALL}/lineitem.parquet", "--rule", "li_filter",
            "--rule", "li_cond", "--output", out, "--as-of", "2022-03-01"]
    assert main(args, spark) == 0
    assert spark.read.parquet(out).count() == tpch.staged_filter(spark, SF_SMALL).count()
    out2 = shared_path(spark, "t-cli-tag")
    args = ["apply", "--rules", tpch.RULES_PATH, "--input", f"{SF_SMALL}/orders.parquet", "--rule", "ord_large",
            "--rule", "ord_f", "--output", out2, "--as-of", "2022-03-01", "--tag", "--format", "csv"]
    assert main(args, spark) == 0
    back = spark.read.option("header", True).csv(out2)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert back.count() == orders.count()
    assert back.filter("hits = 'ord_large,ord_f'").count() == orders.filter(
        "o_totalprice >= 400000 and o_orderstatus = 'F'").count()


def test_apply_csv_input_needs_a_schema(spark, orders_small):
    import pytest

    from ruleloom.sources.sinks import write_csv

    source = write_csv(orders_small, shared_path(spark, "t-cli-csv-in"))
    base = ["apply", "--rules", tpch.RULES_PATH, "--input", source, "--input-format", "csv", "--rule", "ord_filter",
            "--as-of", "2022-03-01"]
    with pytest.raises(SystemExit):
        main(base + ["--output", shared_path(spark, "t-cli-csv-x")], spark)
    out = shared_path(spark, "t-cli-csv")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders_small.schema)
    assert main(base + ["--output", out, "--schema", ddl], spark) == 0
    assert spark.read.parquet(out).count() == tpch.QUERIES["query_lookup"](spark, SF_SMALL).count()
