"""Thousands of prefixes against a text column (P4, P5) as an equi-join.

A text has one beginning of each length, so the prefixes it begins with are found by
equality, length by length; only texts with wildcards are matched as patterns. Equal texts are
looked up once, whatever their number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _text_of(df: DataFrame, column: str):
    return F.col(f"`{column}`").cast("string")


def _found(df: DataFrame, column: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """(text, prefix): every distinct text with every distinct prefix it begins with."""
    texts = df.select(_text_of(df, column).alias("text")).filter("text is not null").distinct()
    wanted = prefixes.select(F.col(f"`{prefix}`").cast("string").alias("prefix")).filter("prefix is not null").distinct()
    plain = wanted.filter(~F.col("prefix").rlike(r"[%_\\\\]")).withColumn("long", F.length("prefix"))
    # One number per length that occurs, at most as many as the longest prefix has characters.
    lengths = sorted(r["long"] for r in plain.select("long").distinct().collect())
    begins = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("text"))
    begun = texts.select("text", F.explode(begins).alias("long")).withColumn("prefix", F.substring("text", F.lit(1), F.col("long")))
    by_length = begun.join(plain, ["prefix", "long"]).select("text", "prefix")
    patterns = [r["prefix"] for r in wanted.filter(F.col("prefix").rlike(r"[%_\\\\]")).collect()]
    if not patterns:
        return by_length
    met = F.filter(F.array(*[F.when(F.col("text").like(p + "%"), F.lit(p)) for p in patterns]), lambda p: p.isNotNull())
    return by_length.unionByName(texts.select("text", F.explode(met).alias("prefix")))


def match_prefixes(df: DataFrame, column: str, prefixes: DataFrame, prefix: str = "prefix", longest: bool = True) -> DataFrame:
    """P4 x N: the columns of ``df``, then ``prefix``: the longest one that ``column`` begins with, or each.

    A prefix may hold wildcards, as in ``LIKE``; those (configuration, brought to the driver) are tested one by
    one. Rows that no prefix fits, and null texts, are not returned. Of equally long ones the
    least counts. The empty prefix fits every text. Prefixes count once; other columns of
    ``prefixes`` are not read. A column of ``df`` named ``prefix`` gives way.
    """
    found = _found(df, column, prefixes, prefix)
    if longest:
        found = found.groupBy("text").agg(F.min(F.struct((-F.length("prefix")).alias("short"), "prefix"))["prefix"].alias("prefix"))
    kept = [F.col(f"d.`{c}`") for c in df.columns if c != "prefix"]
    return df.alias("d").join(found.alias("f"), F.col(f"d.`{column}`").cast("string") == F.col("f.text")).select(*kept, "f.prefix")


def without_prefixes(df: DataFrame, column: str, prefixes: DataFrame, prefix: str = "prefix") -> tuple[DataFrame, DataFrame]:
    """P5 x N: (rows whose text begins with none of the prefixes, rows without a text).

    ``NOT LIKE`` is neither true nor false of a null, so these rows are kept apart.
    """
    met = _found(df, column, prefixes, prefix).select("text").distinct()
    text = F.col(f"`{column}`").cast("string")
    return df.filter(text.isNotNull()).join(met, text == met["text"], "left_anti"), df.filter(text.isNull())
