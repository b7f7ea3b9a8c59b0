"""Row-wise Arrow steps and tables cut to the shared folder."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleloom.session import shared_path

#: Rows of one Arrow batch are handled in slices of about so many bytes of text.
SLICE_BYTES = 4 << 20


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the folder of ``spark.checkpoint.dir`` and read it back: lineage ends there."""
    path = shared_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def named(column: str):
    """The column of exactly this name, dots and backquotes included."""
    return F.col("`" + column.replace("`", "``") + "`")


def fresh_name(taken: list[str], name: str) -> str:
    """``name``, with underscores added until no column has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def add_columns(df: DataFrame, inputs: list[str], fields: T.StructType, step: Callable[..., list[pa.Array]], drop: tuple[str, ...] = ()) -> DataFrame:
    """Append ``fields``, computed by ``step`` from slices of the ``inputs`` columns.

    Input columns named like one of ``fields`` (in any case) give way to it.
    ``step`` gets Arrow arrays of equally many rows and returns one per field.
    """
    own = {f.name.lower() for f in fields} | {d.lower() for d in drop}
    passed = [i for i, c in enumerate(df.columns) if c.lower() not in own]
    at = [df.columns.index(c) for c in inputs]
    schema = T.StructType([df.schema.fields[i] for i in passed] + list(fields))
    names = [f.name for f in schema]

    def run(batches):
        for batch in batches:
            for part in slices(batch, at[0]):
                made = step(*(part.column(i) for i in at))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in passed] + made, names)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text_at: int, limit: int = SLICE_BYTES):
    """Cut a batch so that the text of a slice stays about ``limit`` bytes (a longer text goes alone)."""
    rows = batch.num_rows
    if not rows:
        return
    per_row = max(1, batch.column(text_at).nbytes // rows)
    many = max(1, limit // per_row)
    for at in range(0, rows, many):
        yield batch.slice(at, many)


def text_or_empty(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
