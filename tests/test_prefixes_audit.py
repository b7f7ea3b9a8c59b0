"""Many prefixes by equi-join, and results written with their audit in one pass."""

import random

import pytest
from conftest import AS_OF, catalog_of, cond, lookup, rule
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ruleloom import RuleAddress, rule_hit_counts, tag_all
from ruleloom.operators import actions
from ruleloom.operators.prefixes import match_prefixes, without_prefixes
from ruleloom.sources.audited import read_runs, write_tagged

TEXTS = ["abc", "abcd", "ab", "a", "", None, "xyz", "x%z", "x_z", "éa", "\U0001f600b", "\\a", "ab%", "aXc"] + ["hot text"] * 50
PREFIXES = ["a", "ab", "abc", "abcdef", "é", "\U0001f600", "hot", "hot t", None, "a", "x\\%", "x_z", "a_c"]


def like(text, prefix):
    import re

    out, i = "", 0
    while i < len(prefix):
        c = prefix[i]
        if c == "\\":
            i += 1
            out += re.escape(prefix[i])
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
        i += 1
    return re.match(out, text, re.S) is not None


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t, "own") for i, t in enumerate(TEXTS)], "id int, `a.text` string, prefix string").repartition(4)


@pytest.fixture(scope="module")
def prefixes(spark):
    return spark.createDataFrame([(p, 1) for p in PREFIXES], "prefix string, id int")


def test_all_and_longest_prefixes(texts, prefixes):
    exp = {i: sorted({p for p in PREFIXES if p is not None and like(t, p)}, key=lambda p: (-len(p), p)) for i, t in enumerate(TEXTS) if t is not None}
    got = match_prefixes(texts, "a.text", prefixes, longest=False)
    assert got.columns == ["id", "a.text", "prefix"]
    assert sorted((r["id"], r["prefix"]) for r in got.collect()) == sorted((i, p) for i, ps in exp.items() for p in ps)
    one = match_prefixes(texts, "a.text", prefixes)
    assert sorted((r["id"], r["prefix"]) for r in one.collect()) == sorted((i, ps[0]) for i, ps in exp.items() if ps)


def test_rows_without_any_prefix_and_without_text(texts, prefixes):
    rest, null = without_prefixes(texts, "a.text", prefixes)
    assert sorted(r["id"] for r in rest.collect()) == [i for i, t in enumerate(TEXTS) if t is not None and not any(p is not None and like(t, p) for p in PREFIXES)]
    assert [r["id"] for r in null.collect()] == [TEXTS.index(None)]


def test_empty_prefix_and_empty_tables(spark, texts, prefixes):
    all_of = match_prefixes(texts, "a.text", spark.createDataFrame([("",)], "prefix string"))
    assert all_of.count() == len(TEXTS) - 1
    assert match_prefixes(texts, "a.text", prefixes.limit(0)).count() == 0
    assert match_prefixes(texts.limit(0), "a.text", prefixes).count() == 0
    assert without_prefixes(texts, "a.text", prefixes.limit(0))[0].count() == len(TEXTS) - 1


def test_prefix_rules_in_the_index(spark, texts, monkeypatch):
    """LIKE and NOT LIKE of texts and numbers, with and without wildcards, are the same through the index."""
    rng = random.Random(2)
    pool = [p for p in PREFIXES if p is not None] + ["", "￿", "zz", "1", "2"]
    rules = [rule(f"r{i}", [cond(rng.choice(["`a.text`", "id"]), rng.choice(["LIKE", "NOT LIKE", "=", ">=", "<"]) if i % 3 else rng.choice(["LIKE", "NOT LIKE"]), rng.choice(pool), "")]) for i in range(80)]
    rules = [r for r in rules if not (r["when"][0]["field_name"] == "id" and r["when"][0]["operator"] in ("=", ">=", "<"))]
    cat = catalog_of(spark, rules)
    found = {}
    for many in (1, 10**9):
        monkeypatch.setattr(actions, "INDEXED_RULES", many)
        found[many] = sorted((r["id"], *r["hits"]) for r in tag_all(texts, cat, cat.all_ids(), as_of=AS_OF, as_array=True).collect())
    assert found[1] == found[10**9]


def test_written_with_audit(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("int").alias("n"), F.lit("own").alias("__met")).repartition(5)
    rules = [rule("big", [cond("n", ">=", "40")]), rule("low", [cond("n", "<", "3")]), rule("off", [cond("n", "<", "3")], valid="false"),
             rule("unfit", [cond("absent", "=", "3")]), rule("tail", [lookup("where n in (1, 99)")], key="query_lookup", lookup="true")]
    cat = catalog_of(spark, rules)
    ids = [r["id"] for r in rules]
    run = write_tagged(df, cat, ids, f"{tmp_path}/out", f"{tmp_path}/audit", as_of=AS_OF, run_id="one")
    assert run.hits == {"big": 60, "low": 3, "tail": 2} and run.n_rows == 100
    back = spark.read.parquet(run.output)
    assert back.columns == ["n", "__met", "hits"] and back.filter(F.array_contains("hits", "big")).count() == 60
    log = {r["rule_id"]: r for r in read_runs(spark, f"{tmp_path}/audit", "one").collect()}
    assert {k: (r["status"], r["n_hits"]) for k, r in log.items()} == {"big": ("ok", 60), "low": ("ok", 3), "off": ("off", None), "unfit": ("bad_field", None), "tail": ("ok", 2)}
    assert log["big"]["predicate"] and log["big"]["n_rows"] == 100
    counts = {r["rule_id"]: r["n_hits"] for r in rule_hit_counts(df, cat, ["big", "low", "tail"], as_of=AS_OF).collect()}
    assert counts == run.hits
    write_tagged(df.limit(0), cat, ids, f"{tmp_path}/out", f"{tmp_path}/audit", as_of=AS_OF, run_id="none")
    assert {r["n_hits"] for r in read_runs(spark, f"{tmp_path}/audit", "none").filter("status = 'ok'").collect()} == {0}
    assert spark.read.parquet(f"{tmp_path}/audit").count() == 2
    with pytest.raises((PySparkException, Py4JError)):
        write_tagged(df, cat, ids, f"{tmp_path}/out", f"{tmp_path}/audit", as_of=AS_OF, run_id="one")
    with pytest.raises(ValueError, match="one id"):
        write_tagged(df, cat, ["big", RuleAddress("big")], f"{tmp_path}/out", f"{tmp_path}/audit", as_of=AS_OF)


def test_the_input_is_scanned_once(spark, tmp_path):
    """Counts come from the pass that writes: rows that an accumulator sees once each."""
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).select(F.col("id").cast("int").alias("n")).mapInArrow(passed, "n int")
    cat = catalog_of(spark, [rule("big", [cond("n", ">=", "400")])])
    assert write_tagged(df, cat, ["big"], f"{tmp_path}/out", f"{tmp_path}/audit", as_of=AS_OF).hits == {"big": 600}
    assert seen.value == 1000
