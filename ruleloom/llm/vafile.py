"""Exact search for the greatest inner products through a vector-approximation file.

Every vector is kept twice: as the numbers of the cells that its components fall into, a byte
each, and exactly. A task scans the cells of a slice of vectors: the products with the cells'
middles, plus and minus what a vector can lie off them, bound every score from both sides. Exact
vectors are then read in the order of the better bound, until no bound left reaches the k-th
best score found so far; that score is carried from slice to slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleloom.llm.rows import keep, named

#: Cells of a component.
CELLS = 64
#: Queries that are broadcast together (64 components: 8 MB), and that a task scans for at a time.
QUERY_BLOCK, QUERY_SLICE = 16_384, 1_024
#: Vectors that a task scans at a time.
ROWS = 4_096
#: Whole numbers below this are exact as doubles.
EXACT = 2.0**53
LEAST_LONG, MOST_LONG = -(2**63), 2**63 - 1


def whole_vector(vector: str, scale: float) -> Column:
    """``floor(scale * x)`` of every component, as longs (the ends of the long range beyond it)."""
    return F.transform(named(vector), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(id, vec) of the rows that take part: an id, and at least one component, all of them finite."""
    bad = F.exists(named(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return vectors.filter(named(key).isNotNull() & (F.size(named(vector)) > 0) & ~bad).select(named(key).cast("long").alias("id"), whole_vector(vector, scale).alias("vec"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _grid(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Least value and cell width of each of the ``dim`` components."""

    def ends(batches):
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(x.min(axis=0)), pa.array(x.max(axis=0))], ["at", "low", "high"])

    found = rows.select("vec").mapInArrow(ends, "at int, low long, high long").groupBy("at").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("at").collect()
    low = np.array([r["low"] for r in found], np.float64)
    high = np.array([r["high"] for r in found], np.float64)
    return low, np.maximum(1.0, np.ceil((high - low + 1) / CELLS))


def _middles(cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    return low + cells * width + (width - 1) / 2


def _approximate(rows: DataFrame, dim: int, low: np.ndarray, width: np.ndarray) -> DataFrame:
    """(id, copies, cells, off, vec): the file; ``off`` is the distance from the cells' middles."""

    def cut(batches):
        for batch in batches:
            x = _matrix(batch.column(2), dim).astype(np.float64)
            cells = np.minimum((x - low) // width, CELLS - 1).astype(np.uint8)
            off = np.sqrt(((x - _middles(cells, low, width)) ** 2).sum(axis=1)) * (1 + 1e-9)
            packed = pa.array([c.tobytes() for c in cells], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, pa.array(off), batch.column(2)], ["id", "copies", "cells", "off", "vec"])

    return rows.select("id", "copies", "vec").mapInArrow(cut, "id long, copies long, cells binary, off double, vec array<long>")


class Best:
    """The k best (score, id, copies) of each of some queries; k-th best scores in ``least``."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query, self.score, self.id, self.copies = (np.zeros(0, t) for t in [np.int64] * 4)
        self.least = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> None:
        q, s, i, n = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, ids), (self.copies, copies)))
        # ``~s`` falls as s rises, also for the least long.
        order = np.lexsort((i, ~s, q))
        q, s, i, n = q[order], s[order], i[order], n[order]
        start = np.searchsorted(q, q)
        before = np.cumsum(n) - n
        before -= before[start] if len(q) else before
        live = before < self.k
        self.query, self.score, self.id, self.copies = q[live], s[live], i[live], n[live]
        # The row with which a query's k-th place is filled holds the k-th best score.
        full = live & (before + n >= self.k)
        self.least[q[full]] = s[full].astype(np.float64)


def _products(queries: np.ndarray, vectors: np.ndarray, exact: bool) -> np.ndarray:
    """Row-wise inner products as longs, by Python's whole numbers where doubles do not hold them."""
    if exact:
        return np.einsum("ij,ij->i", queries.astype(np.float64), vectors.astype(np.float64)).astype(np.int64)
    sums = (sum(int(a) * int(b) for a, b in zip(q, v, strict=True)) for q, v in zip(queries, vectors, strict=True))
    return np.array([min(max(s, LEAST_LONG), MOST_LONG) for s in sums], np.int64)


def _scan(shared, low: np.ndarray, width: np.ndarray, dim: int, k: int, exact: bool):
    def search(batches):
        names, asked = shared.value
        parts = [slice(at, at + QUERY_SLICE) for at in range(0, len(names), QUERY_SLICE)]
        best = [Best(len(names[p]), k) for p in parts]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, copies = part.column(0).to_numpy(), part.column(1).to_numpy()
                cells = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(-1, dim)
                middles, off, vec = _middles(cells, low, width), part.column(3).to_numpy(), _matrix(part.column(4), dim)
                for p, own in zip(parts, best, strict=True):
                    _search(names[p], asked[p], ids, copies, middles, off, vec, own, width, exact)
        for p, own in zip(parts, best, strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(names[p][own.query]), pa.array(own.id), pa.array(own.copies), pa.array(own.score)], ["query_id", "vec_id", "copies", "score"])

    return search


def _search(names, asked, ids, copies, middles, off, vec, best: Best, width, exact: bool) -> None:
    """Bounds of all (query, vector) scores of a slice, then exact scores, the best bound first."""
    queries = asked.astype(np.float64)
    near = queries @ middles.T
    # Off the middles by less than half a cell in each component, and by ``off`` altogether.
    boxed = np.abs(queries) @ ((width - 1) / 2)
    length = np.sqrt((queries**2).sum(axis=1))
    spread = np.minimum(boxed[:, None], length[:, None] * off[None, :])
    spread += 1e-9 * (length[:, None] * (np.sqrt((middles**2).sum(axis=1)) + off)[None, :])
    # Scores beyond a long count as its ends, and so do their bounds.
    upper = np.maximum(near + spread, float(LEAST_LONG))
    other = names[:, None] != ids[None, :]
    upper[~other] = -np.inf
    # Whatever the k-th best lower bound is, the k-th best score is no less.
    known = best.least.copy()
    if len(ids) >= best.k:
        lower = np.where(other, np.minimum(near - spread, float(LEAST_LONG) * -1), -np.inf)
        known = np.maximum(known, np.partition(lower, len(ids) - best.k, axis=1)[:, len(ids) - best.k])
    query, row = np.nonzero((upper >= known[:, None]) & other)
    order = np.lexsort((-upper[query, row], query))
    query, row = query[order], row[order]
    bound = upper[query, row]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    step = 0
    while len(query):
        now = (place >= step) & (place < step + best.k)
        q, r = query[now], row[now]
        best.add(q, _products(asked[q], vec[r], exact), ids[r], copies[r])
        step += best.k
        left = (place >= step) & (bound >= best.least[query])
        query, row, bound, place = query[left], row[left], bound[left], place[left]


def greatest(vectors: DataFrame, key: str, vector: str, queries: Column, *, k: int = 20, scale: float = 64.0, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` greatest inner products of each query row, exactly.

    Vectors are taken as ``floor(scale * x)`` of their components. ``queries`` is a condition on (id, vec)
    that chooses the rows to search for; candidates are all rows but those of the query's id,
    every row in its own right: rows that repeat an id take a place each. Ties go to the
    smaller id. Rows without id or vector, with an empty vector, or with a null or non-finite
    component take no part, nor do vectors of another length than the most frequent
    one (ties: the smaller). Of several query rows with one id the least vector is searched for. Scores
    beyond a long count as its ends. Other columns are not returned; no usable vector
    gives an empty result.

    Of equal vectors only those with the ``k + 1`` least ids can be among any query's k
    best, so the file holds no others, however many there are.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector, scale)
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, vec_id long, copies long, score long"
    if common is None:
        return _ranked(spark.createDataFrame([], schema), k)
    dim = common["n"]
    rows = rows.filter(F.size("vec") == dim)
    same = rows.groupBy("vec", "id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("long").alias("copies"))
    by_id = Window.partitionBy("vec").orderBy("id")
    first = keep(same.withColumn("nth", F.row_number().over(by_id)).filter(F.col("nth") <= k + 1).drop("nth"), "vectors")
    low, width = _grid(first, dim)
    file = keep(_approximate(first, dim, low, width), "va-file")
    top = float(max(np.abs(low).max(), np.abs(low + width * CELLS).max()))
    asked = keep(rows.filter(queries).groupBy("id").agg(F.min("vec").alias("vec")), "queries")
    blocks = max(1, -(-asked.count() // query_block))
    found = None
    for b in range(blocks):
        # About ``query_block`` rows by the hash of their ids.
        block = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toArrow()
        if not block.num_rows:
            continue
        block = block.combine_chunks()
        shared = spark.sparkContext.broadcast((block.column(0).to_numpy(), _matrix(block.column(1).combine_chunks(), dim)))
        part = keep(file.mapInArrow(_scan(shared, low, width, dim, k, top * top * dim < EXACT), schema), "found")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    return _ranked(found if found is not None else spark.createDataFrame([], schema), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
