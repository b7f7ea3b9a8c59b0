"""Sources: the rule document, fact CSV files and named tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path
from .schema import RULE_DOCUMENT


def read_rule_document(spark: SparkSession, path: str) -> DataFrame:
    """One multi-line JSON document ``{"rules": [...]}`` per file.

    The schema is explicit, so attribute types never depend on the document.
    A glob or folder holding several documents yields one row per document.
    """
    return spark.read.schema(RULE_DOCUMENT).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def rule_document_from_text(spark: SparkSession, text: str | list[str]) -> DataFrame:
    """The same as :func:`read_rule_document`, from JSON text held in memory."""
    texts = [text] if isinstance(text, str) else list(text)
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_pos int, doc string")
    return raw.select("doc_pos", F.from_json("doc", RULE_DOCUMENT).alias("d")).select("doc_pos", "d.*")


# Fixed value: how a null is written, so that it differs from empty text.
CSV_NULL = "\\N"


def _csv_options(header: bool, multi_line: bool, null: str, mode: str) -> dict:
    return {"header": header, "multiLine": multi_line, "mode": mode, "enforceSchema": not header, "quote": '"', "escape": '"',
            "nullValue": null, "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def escape_breaks(text: Column) -> Column:
    """Text on one line: backslash, line feed and carriage return as ``\\\\``, ``\\n``, ``\\r``."""
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_breaks(text: Column) -> Column:
    """The text that :func:`escape_breaks` was given."""
    parts = F.transform(
        F.split(text, r"\\\\", -1),
        lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
    )
    return F.array_join(parts, "\\")


def _texts(schema: T.StructType, change) -> list[Column]:
    return [change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in schema.fields]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, multi_line: bool = False,
             null: str = CSV_NULL, escaped_breaks: bool = False) -> DataFrame:
    """Header CSV with a declared schema (no inference pass over the data).

    Quoted values may hold quotes and blanks; empty text and ``null`` differ. A
    value that does not fit its type fails the read (:func:`read_csv_checked`
    keeps such rows aside instead), and so does a header whose names differ
    from the schema's or come in another order. Files are read in splits, a
    record a line. Where values hold line breaks, have them written escaped
    (``write_csv(escape_breaks=True)``) and read with ``escaped_breaks``; files that hold
    them as they are need ``multi_line``, by which each is read by one task.
    """
    out = spark.read.options(**_csv_options(header, multi_line, null, "FAILFAST")).schema(schema).csv(path)
    return out.select(*_texts(schema, unescape_breaks)) if escaped_breaks else out


@dataclass(frozen=True)
class CheckedCsv:
    """``good`` rows of the schema, ``bad`` ones as (file, record), and how many records there were."""

    good: DataFrame
    bad: DataFrame
    n_records: int
    n_good: int
    n_bad: int


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, multi_line: bool = False,
                     null: str = CSV_NULL, escaped_breaks: bool = False) -> CheckedCsv:
    """S1 with a quarantine: one read of the files that parts fitting records from the others.

    A record is bad if a value does not fit its type or it has more or fewer
    values than the schema; its text is kept as it stands, with its file. Both
    parts are written to the shared folder, so neither reads the files again.
    Records are counted while they are read: ``n_good + n_bad == n_records``, or the read fails.
    Empty lines are no records. Other options as in :func:`read_csv`; a header that does
    not fit still fails the read.
    """
    mark = "record"
    while mark in schema.fieldNames():
        mark += "_"
    asked = T.StructType([*schema.fields, T.StructField(mark, T.StringType())])
    options = {**_csv_options(header, multi_line, null, "PERMISSIVE"), "columnNameOfCorruptRecord": mark}
    raw = spark.read.options(**options).schema(asked).csv(path)
    values = F.struct(*(_texts(schema, unescape_breaks) if escaped_breaks else [F.col(f"`{f.name}`") for f in schema.fields]))
    seen = Observation()
    parted = raw.select(values.alias("row"), F.col(f"`{mark}`").alias("record"), F.col("_metadata.file_path").alias("file"), F.col(f"`{mark}`").isNotNull().alias("is_bad"))
    out = shared_path(spark, "csv-checked")
    parted.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy("is_bad").parquet(out)
    kept = spark.read.schema(parted.schema).parquet(out)
    good = kept.filter(~F.col("is_bad")).select("row.*")
    bad = kept.filter("is_bad").select("file", "record")
    counts = dict(map(tuple, kept.groupBy("is_bad").count().collect()))
    n_good, n_bad = counts.get(False, 0), counts.get(True, 0)
    if n_good + n_bad != seen.get["n"]:
        raise RuntimeError(f"{seen.get['n']} records read, {n_good} good and {n_bad} bad ones written")
    return CheckedCsv(good, bad, seen.get["n"], n_good, n_bad)


def event_time(date_col: str, time_col: str, fmt: str) -> Column:
    """A timestamp from a date text and a time text (null where they do not fit ``fmt``)."""
    return F.try_to_timestamp(F.concat_ws(" ", F.col(date_col), F.col(time_col)), F.lit(fmt))


def read_table(spark: SparkSession, name_or_df: str | DataFrame) -> DataFrame:
    """A table handle is either a DataFrame or the name of a table/view."""
    if isinstance(name_or_df, DataFrame):
        return name_or_df
    if name_or_df is None or not str(name_or_df).strip():
        raise ValueError("a table name or DataFrame is required")
    return spark.table(str(name_or_df).strip())


def register(df: DataFrame, name: str) -> DataFrame:
    """S3: make a stage's output addressable by name for later rules."""
    df.createOrReplaceTempView(name)
    return df
