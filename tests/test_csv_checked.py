"""CSV with escaped line breaks, and with bad records kept aside."""

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ruleloom.sources.readers import escape_breaks, read_csv, read_csv_checked, unescape_breaks
from ruleloom.sources.sinks import write_csv

TEXTS = ["", None, "plain", "two\nlines", "cr\r\nlf", "back\\slash", "\\n", "\\\\n", "\\\\\n\\", "\n", "\r", "\\", "say \"no\", twice", " blank ", "\\N", "ü\\ü\nü", "a,b\n\n\nc", "x" * 50_000]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t, float(i)) for i, t in enumerate(TEXTS)], "id int, t string, d double")


def test_escapes_are_undone(texts):
    back = texts.select("t", unescape_breaks(escape_breaks(F.col("t"))).alias("u"), escape_breaks(F.col("t")).alias("e")).collect()
    assert all(r["t"] == r["u"] for r in back)
    assert not any(c in (r["e"] or "") for r in back for c in "\r\n")


def test_texts_survive_a_file_of_lines(spark, texts, tmp_path):
    write_csv(texts.repartition(2), f"{tmp_path}/csv", escaped_breaks=True)
    back = read_csv(spark, f"{tmp_path}/csv", texts.schema, escaped_breaks=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, texts.collect()))
    checked = read_csv_checked(spark, f"{tmp_path}/csv", texts.schema, escaped_breaks=True)
    assert sorted(map(tuple, checked.good.collect())) == sorted(map(tuple, texts.collect()))
    assert (checked.n_records, checked.n_good, checked.n_bad) == (len(TEXTS), len(TEXTS), 0)


def test_unescaped_line_breaks_need_multi_line(spark, texts, tmp_path):
    # Unescaped, Spark's reader takes one text for null and ends lines its own way.
    texts = texts.filter(F.col("t").isNull() | ~(F.col("t").contains("\r") | (F.col("t") == "\\N")))
    write_csv(texts, f"{tmp_path}/csv")
    back = read_csv(spark, f"{tmp_path}/csv", texts.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, texts.collect()))
    with pytest.raises((PySparkException, Py4JError)):
        read_csv(spark, f"{tmp_path}/csv", texts.schema).collect()


LINES = ['"1","fits","1.5"', '"x","no number","1.5"', '"2","too few"', '"3","too many","1","2"', '"4",\\N,\\N', '"99999999999","too large","1"', '"5","a, b","2"', "", '"6","blank ","oops"', '"7","","0"']
GOOD = {(1, "fits", 1.5), (4, None, None), (5, "a, b", 2.0), (7, "", 0.0)}


def test_bad_records_are_kept_aside(spark, tmp_path):
    for n in range(3):
        with open(f"{tmp_path}/part{n}.csv", "w") as f:
            f.write("\n".join(["id,t,d", *LINES]) + "\n")
    schema = "id int, t string, d double"
    from pyspark.sql.types import _parse_datatype_string as parsed

    found = read_csv_checked(spark, f"{tmp_path}/*.csv", parsed(schema))
    assert sorted(map(tuple, found.good.collect()), key=str) == sorted([r for r in GOOD for _ in range(3)], key=str)
    bad = found.bad.collect()
    assert sorted(r["record"] for r in bad) == sorted([x for x in LINES if x and not x.startswith(('"1"', '"4"', '"5"', '"7"'))] * 3)
    assert len({r["file"] for r in bad}) == 3 and all(r["file"].endswith(".csv") for r in bad)
    assert (found.n_records, found.n_good, found.n_bad) == (27, 12, 15)
    with pytest.raises((PySparkException, Py4JError)):
        read_csv(spark, f"{tmp_path}/*.csv", parsed(schema)).collect()


def test_the_files_are_read_once(spark, tmp_path):
    """Both parts come from what was written, also when the files are gone from the listing."""
    import os

    from pyspark.sql.types import _parse_datatype_string as parsed

    path = f"{tmp_path}/one.csv"
    with open(path, "w") as f:
        f.write('"1","a"\n"x","b"\n')
    found = read_csv_checked(spark, path, parsed("id int, record string"), header=False)
    os.truncate(path, 0)
    assert [tuple(r) for r in found.good.collect()] == [(1, "a")] and [r["record"] for r in found.bad.collect()] == ['"x","b"']


def test_headers_that_do_not_fit_and_empty_files(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string as parsed

    with open(f"{tmp_path}/head.csv", "w") as f:
        f.write("t,id\n1,a\n")
    with pytest.raises((PySparkException, Py4JError)):
        read_csv_checked(spark, f"{tmp_path}/head.csv", parsed("id int, t string"))
    with open(f"{tmp_path}/empty.csv", "w") as f:
        f.write("id,t\n")
    found = read_csv_checked(spark, f"{tmp_path}/empty.csv", parsed("id int, t string"))
    assert (found.n_records, found.good.count(), found.bad.count()) == (0, 0, 0)
