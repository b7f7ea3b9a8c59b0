"""Bounded labelled samples for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def crc_of(key: str):
    """crc32 of the key as text; null keys count as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, usable, most: int) -> DataFrame:
    """At most ``most`` labelled rows (key, text, label), the same ones each time.

    ``usable`` is a condition on the key; rows with a null key or label are not used, and of a
    key's several labels or texts one is.
    """
    named = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & usable).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    chosen = named.orderBy(F.xxhash64(key), key).limit(most)
    # ``most`` rows bound the broadcast.
    return docs.select(key, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), key).groupBy(key).agg(F.max_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label"))
