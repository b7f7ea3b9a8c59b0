"""Corpus pipeline: quality, near duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleloom.llm import decontam, jaccard, packing, quality, secret_scan
from ruleloom.llm.rows import keep


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns c0, c1, … and their names: no column can clash with one that a stage adds."""
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*at.values()), at


def _named(found: DataFrame, at: dict[str, str]) -> DataFrame:
    return found.select(*[F.col(c).alias(name) for name, c in at.items()])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier gives 0.3 or more."""
    net = quality.learn(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows, at = _numbered(docs)
    return _named(quality.score(rows, net, at["text"]).filter(F.col("score") >= 0.3), at)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked ones, the one with the smallest doc_id.

    Rows without words stay, as do unlike texts under one doc_id; see ``jaccard.one_of_each``.
    """
    return jaccard.one_of_each(docs, "doc_id", "text")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that share no benchmark window."""
    rows, at = _numbered(docs)
    found = decontam.find_leaks(rows, at["text"], spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "item_id", "text")
    return _named(found.filter(F.col("n_hit") == 0), at)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark; n_chars follows."""
    forest = secret_scan.train(secret_scan.labelled_findings(spark))
    rows, at = _numbered(docs)
    text, size = at["text"], at["n_chars"]
    clean = secret_scan.redact(rows.withColumn("before", F.col(text)), text, at["source"], forest)
    changed = ~F.col(text).eqNullSafe(F.col("before"))
    return _named(clean.withColumn(size, F.when(changed, F.length(text).cast("long")).otherwise(F.col(size))), at)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in training sequences of 1024 tokens."""
    return packing.pack(docs.select("doc_id", "text"), "doc_id", "text")


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("best-fit packing", packing_stage),
]

#: The quality network and the secret forest are learned: SQL cannot express run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last written under the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = keep(docs, name.replace(" ", "-"))
    return docs
