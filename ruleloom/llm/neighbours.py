"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are grown on a bounded sample; every vector is then sent down them to one leaf
each. A query walks all trees at once: one priority queue holds the branches not yet taken,
by the squared margins that the query lies on the wrong side of, and the least is taken next,
until the leaves reached hold the wanted share of the sample. The vectors of these leaves
are the candidates; their exact distances rank them.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Distinct vectors that the trees are grown on, at most.
SAMPLE_VECTORS = 8_192
TREES, LEAF = 24, 24
#: Share of the sample that a query's leaves must hold, at every size.
SHARE = 0.5
#: Queries that are searched for together, and broadcast.
QUERY_BLOCK = 2_048
#: Vectors that a task holds at a time.
ROWS = 4_096


@dataclass
class Node:
    """Inner nodes split by ``normal @ x > cut``; ``left`` and ``right`` are node numbers, a leaf's are -1."""

    normal: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray


@dataclass
class Forest:
    roots: list[int]
    nodes: Node
    members: list[np.ndarray]
    size: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(vectors x trees) leaf numbers."""
        out = np.zeros((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root)
            while True:
                inner = np.flatnonzero(self.nodes.left[at] >= 0)
                if not len(inner):
                    break
                node = at[inner]
                side = np.einsum("ij,ij->i", x[inner], self.nodes.normal[node]) > self.nodes.cut[node]
                at[inner] = np.where(side, self.nodes.right[node], self.nodes.left[node])
            out[:, t] = self.nodes.leaf[at]
        return out

    def search(self, query: np.ndarray, share: float) -> list[int]:
        """Leaves of all trees, nearest branches first, until they hold ``share`` of the sample."""
        margin = self.nodes.normal @ query - self.nodes.cut
        queue = [(0.0, root) for root in self.roots]
        heapq.heapify(queue)
        found, held = [], np.zeros(self.size, bool)
        left, right, leaf = self.nodes.left, self.nodes.right, self.nodes.leaf
        want = share * self.size
        while queue:
            far, node = heapq.heappop(queue)
            while left[node] >= 0:
                m = margin[node]
                near, other = (right[node], left[node]) if m > 0 else (left[node], right[node])
                heapq.heappush(queue, (far + m * m, other))
                node = near
            found.append(int(leaf[node]))
            held[self.members[leaf[node]]] = True
            if np.count_nonzero(held) >= want:
                break
        return found


def grow(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 11) -> Forest:
    """Split by hyperplanes half-way between two random members until at most ``leaf`` are left, or equal ones."""
    sample = np.unique(sample, axis=0) if len(sample) else sample
    rng = np.random.default_rng(seed)
    normals, cuts, left, right, leaves, members, roots = [], [], [], [], [], [], []
    dim = sample.shape[1] if sample.ndim == 2 else 0

    def add() -> int:
        normals.append(np.zeros(dim))
        cuts.append(0.0)
        left.append(-1)
        right.append(-1)
        leaves.append(-1)
        return len(cuts) - 1

    for _ in range(trees):
        roots.append(add())
        todo = [(roots[-1], np.arange(len(sample)))]
        while todo:
            node, rows = todo.pop()
            side = None
            if len(rows) > leaf:
                for _ in range(5):
                    a, b = sample[rng.choice(rows, 2, replace=False)]
                    normal = a - b
                    norm = np.linalg.norm(normal)
                    if not norm:
                        continue
                    normal /= norm
                    across = sample[rows] @ normal
                    cut = float(np.median(across))
                    side = across > cut
                    if 0 < side.sum() < len(rows):
                        break
                    side = None
            if side is None:
                leaves[node] = len(members)
                members.append(rows)
                continue
            normals[node], cuts[node] = normal, cut
            left[node], right[node] = add(), add()
            todo += [(left[node], rows[~side]), (right[node], rows[side])]
    nodes = Node(np.array(normals).reshape(len(cuts), dim), np.array(cuts), np.array(left), np.array(right), np.array(leaves))
    return Forest(roots, nodes, members, len(sample))


def usable(vectors: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """(id, vec) of the vectors that take part: ``dim`` finite numbers, not all zero, and an id."""
    vec = F.col(vector).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists(vec, lambda x: x != 0)
    return vectors.select(F.col(key).cast("long").alias("id"), vec.alias("vec")).filter(F.col("id").isNotNull() & F.col("vec").isNotNull()).filter((F.size("vec") == dim) & ~bad & some)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def nearest(vectors: DataFrame, key: str, vector: str, queries, *, k: int = 10, trees: int = TREES, leaf: int = LEAF, share: float = SHARE, sample: int = SAMPLE_VECTORS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query row, nearest first.

    ``queries`` is a condition on (id, vec) that chooses the rows to search for; candidates are all
    rows but those of the query's id. Scores are exact Euclidean distances in double
    precision, ties go to the smaller id. Vectors that are null, zero, of another
    dimension than the most frequent one, or hold a null or non-finite component take no
    part. Of several query rows with one id the least vector is searched for; a repeated candidate id counts once, by
    its nearest vector. Other columns are not returned; no usable vector gives an empty result.
    """
    spark = vectors.sparkSession
    out = "query_id long, vec_id long, score double"
    sizes = vectors.filter(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("n")).count().filter("n > 0").orderBy(F.desc("count"), "n").first()
    dim = sizes["n"] if sizes else 1
    rows = usable(vectors, key, vector, dim)
    # A fixed number of rows, the same ones each time.
    chosen = rows.groupBy("vec").agg(F.min("id").alias("id")).orderBy(F.xxhash64("id")).limit(sample).collect()
    forest = spark.sparkContext.broadcast(grow(np.array([r["vec"] for r in chosen], np.float64).reshape(-1, dim), trees, leaf))
    asked = rows.filter(queries).groupBy("id").agg(F.min("vec").alias("vec"))

    def walk(batches):
        for batch in batches:
            found = [forest.value.search(q, share) for q in _matrix(batch.column(1), dim)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], ["id", "vec", "leaves"])

    blocks = max(1, -(-asked.count() // query_block))
    walked = asked.mapInArrow(walk, "id long, vec array<double>, leaves array<long>")
    found = None
    for b in range(blocks):
        # About ``query_block`` rows by the hash of their ids.
        block = (walked if blocks == 1 else walked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)).collect()
        if not block:
            continue
        shared = spark.sparkContext.broadcast(([r["id"] for r in block], np.array([r["vec"] for r in block], np.float64), [r["leaves"] for r in block]))
        part = rows.mapInArrow(_ranker(forest, shared, dim, k), out)
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], out)
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _ranker(forest, shared, dim: int, k: int):
    def rank(batches):
        ids, queries, leaves = shared.value
        trees = forest.value
        wanted = np.zeros((len(ids), len(trees.members)), bool)
        for q, own in enumerate(leaves):
            wanted[q, own] = True
        best: list[list[tuple[float, int]]] = [[] for _ in ids]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                part = part.take(pa.array(np.argsort(part.column(0).to_numpy(), kind="stable")))
                names, x = part.column(0).to_numpy(), _matrix(part.column(1), dim)
                in_leaf = trees.leaves(x)
                for q in range(len(ids)):
                    mine = wanted[q]
                    rows = np.flatnonzero(mine[in_leaf].any(axis=1) & (names != ids[q]))
                    if not len(rows):
                        continue
                    score = np.sqrt(((x[rows] - queries[q]) ** 2).sum(axis=1))
                    # Rows are in order of id: the least score of each id first, then the k least of these.
                    near = names[rows]
                    one = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))
                    near, score = near[one], np.minimum.reduceat(score, one)
                    least = score <= np.partition(score, k - 1)[k - 1] if len(near) > k else np.ones(len(near), bool)
                    own = {}
                    for s, i in sorted([*best[q], *zip(score[least].tolist(), near[least].tolist(), strict=True)]):
                        own.setdefault(i, s)
                        if len(own) == k:
                            break
                    best[q] = [(s, i) for i, s in own.items()]
        flat = [(ids[q], i, s) for q in range(len(ids)) for s, i in best[q]]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int64()), pa.array([f[1] for f in flat], pa.int64()), pa.array([f[2] for f in flat], pa.float64())], ["query_id", "vec_id", "score"])

    return rank
