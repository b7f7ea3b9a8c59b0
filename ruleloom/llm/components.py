"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleloom.llm.rows import keep


class Forest:
    """Union-find over small integers; the smallest member names a set."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def thin(edges: DataFrame) -> DataFrame:
    """Replace each Arrow batch's edges by a star per component of the batch: (node, smallest node)."""

    def run(batches):
        for batch in batches:
            ends = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            names, at = np.unique(ends, return_inverse=True)
            at = at.reshape(2, -1)
            forest = Forest(len(names))
            for a, b in zip(at[0].tolist(), at[1].tolist(), strict=True):
                forest.union(a, b)
            root = np.array([forest.find(i) for i in range(len(names))], np.int64)
            far = np.flatnonzero(root != np.arange(len(names)))
            yield pa.RecordBatch.from_arrays([pa.array(names[far], pa.int64()), pa.array(names[root[far]], pa.int64())], ["hi", "lo"])

    return edges.mapInArrow(run, "hi long, lo long")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that an edge joins to another; root is the component's smallest node.

    Node names are longs; edges with a null end, loops and repeats count as none. Each
    round links every node's larger neighbours, then its smaller ones, to the
    smallest node among them, until only stars are left: the logarithm of the
    component size in rounds, each cut to the shared folder. No component is
    gathered anywhere; a node with very many neighbours is only ever aggregated.
    """
    start = edges.select(F.col(a).cast("long").alias("hi"), F.col(b).cast("long").alias("lo")).filter("hi is not null and lo is not null and hi <> lo")
    now = keep(thin(start).distinct(), "edges")
    while not _only_stars(now):
        both = now.union(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("hi"), F.col("m").alias("lo")), F.struct(F.col("v").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.hi", "e.lo")
        now = keep(small.filter("hi <> lo").distinct(), "edges")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _only_stars(edges: DataFrame) -> bool:
    """Whether every ``hi`` of distinct edges has one ``lo``, and none is a ``lo`` itself: another round changes nothing."""
    up, down = (F.struct(F.col(c).alias("node"), F.lit(x).alias("up"), F.lit(1 - x).alias("down")) for c, x in (("hi", 1), ("lo", 0)))
    ends = edges.select(F.explode(F.array(up, down)).alias("e")).groupBy("e.node").agg(F.sum("e.up").alias("up"), F.sum("e.down").alias("down"))
    return not ends.filter("up > 1 or up > 0 and down > 0").agg(F.count(F.lit(1))).first()[0]
