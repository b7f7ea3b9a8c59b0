"""Merkle manifest of a dataset, with a witness for every row.

Every row is a leaf; the rows of one group form a tree whose runs of eight neighbours are
hashed together, level by level, and the groups' roots form a tree in turn. A tree grows by
appending: a new node gets as partial witness the nodes already standing in its run, and
each node that is completed there later extends the witnesses of the earlier ones. Trees are
cut into aligned blocks of 8**4 leaves that are grown in different tasks; the root of a
block is nothing but the next append to the tree of block roots above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleloom.llm.rows import keep, named

#: Nodes that are hashed together, levels that one task grows, leaves of a block (fixed values).
FAN, LEVELS = 8, 4
BLOCK = FAN**LEVELS
WITNESS = "array<struct<place:int,siblings:array<string>>>"
_WITNESS = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))]))


def record_hash(columns: Sequence[str | Column]) -> Column:
    """Hex SHA-256 of the values: each ``-`` if null, else its UTF-8 byte count, a colon and its text."""
    texts = [(named(c) if isinstance(c, str) else c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def fold(digest: Column, witness: Column) -> Column:
    """The root that follows from a leaf and its witness."""

    def up(below, step):
        left = F.array_join(F.slice(step["siblings"], 1, step["place"]), "")
        right = F.array_join(F.slice(step["siblings"], step["place"] + 1, FAN), "")
        return F.sha2(F.concat(left, below, right), 256)

    return F.aggregate(witness, digest, up)


def siblings(witness: Column) -> Column:
    """All siblings of a witness as one text, from the leaf's run up to the root's."""
    return F.array_join(F.flatten(F.transform(witness, lambda step: step["siblings"])), "")


def height(size: int) -> int:
    """Levels above ``size`` leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


class Tree:
    """A tree of at most ``levels`` levels that takes its leaves one after the other.

    ``witnesses[i]`` holds (place, siblings) of leaf i for every level begun; it is partial while
    the run at that level is open, and shared by all leaves below the same node.
    """

    def __init__(self, levels: int):
        self.levels, self.root, self.witnesses = levels, None, []
        self.open = [([], []) for _ in range(levels)]

    def append(self, digest: str) -> None:
        self.witnesses.append([])
        self._complete(0, digest, len(self.witnesses) - 1)

    def _complete(self, level: int, digest: str, first: int) -> None:
        """A node over the leaves from ``first`` to the last one so far is known."""
        if level == self.levels:
            self.root = digest
            return
        digests, steps = self.open[level]
        mine = (len(digests), list(digests))
        for _, others in steps:
            others.append(digest)
        for witness in self.witnesses[first:]:
            witness.append(mine)
        digests.append(digest)
        steps.append(mine)
        if len(digests) == FAN:
            self._close(level)

    def _close(self, level: int) -> None:
        digests, _ = self.open[level]
        self.open[level] = ([], [])
        # Leaves whose witness ends at this level are those of the run now closed.
        first = len(self.witnesses)
        while first and len(self.witnesses[first - 1]) == level + 1:
            first -= 1
        self._complete(level + 1, hashlib.sha256("".join(digests).encode()).hexdigest(), first)

    def finish(self) -> str:
        """Close the open runs from the lowest level on; the root."""
        for level in range(self.levels):
            if self.open[level][0]:
                self._close(level)
        return self.root


def numbered(nodes: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``nodes`` with ``pos``, gapless from 0 in each ``tree``, and ``size``, the tree's leaves.

    Rows are dealt by ranges of (tree, order) and numbered inside a range; the counts of
    the ranges shift them. No tree is brought together.
    """
    dealt = keep(nodes.repartitionByRange(F.col("tree"), *order).withColumn("range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("tree")
    starts = counts.select("tree", "range", F.sum("rows").over(whole).alias("size"), (F.sum("rows").over(whole.orderBy("range")) - F.col("rows")).alias("start"))
    inner = F.row_number().over(Window.partitionBy("tree", "range").orderBy(*order)) - 1
    return dealt.withColumn("pos", inner.cast("long")).join(starts, ["tree", "range"]).withColumn("pos", F.col("pos") + F.col("start")).drop("range", "start")


def _levels(size: int) -> int:
    return LEVELS if size > BLOCK else height(size)


def _grown(block: pa.Table) -> tuple[pa.Table, Tree, str]:
    block = block.sort_by("pos")
    tree = Tree(_levels(block.column("size")[0].as_py()))
    for digest in block.column("digest").to_pylist():
        tree.append(digest)
    return block, tree, tree.finish()


def _roots(nodes: DataFrame) -> DataFrame:
    """The blocks' roots as the nodes of the trees above."""

    def root(block: pa.Table) -> pa.Table:
        block, _, digest = _grown(block)
        first = block.slice(0, 1)
        size = -(-first.column("size")[0].as_py() // BLOCK)
        made = [first.column("tree"), pa.array([first.column("pos")[0].as_py() // BLOCK], pa.int64()), pa.array([size], pa.int64()), pa.array([digest])]
        return pa.table(made, ["tree", "pos", "size", "digest"])

    return _blocked(nodes).applyInArrow(root, "tree string, pos long, size long, digest string")


def _blocked(nodes: DataFrame):
    return nodes.groupBy("tree", F.expr(f"pos div {BLOCK}").alias("block"))


def _extended(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``nodes`` with their witnesses up to the root; ``above`` holds those of their blocks."""
    fields = [f for f in nodes.schema.fields if f.name not in ("size",)]
    ends = [T.StructField("subroot", T.StringType()), T.StructField("root", T.StringType())]
    schema = T.StructType([*fields, *ends, *T._parse_datatype_string(f"witness {WITNESS}").fields])
    names = [f.name for f in fields]

    def extend(block: pa.Table, top: pa.Table) -> pa.Table:
        block, tree, _ = _grown(block)
        over = top.to_pylist()[0]
        tail = [(s["place"], s["siblings"]) for s in over["witness"]]
        n = block.num_rows
        root, subroot = over["root"], over["subroot"]
        own = pa.array([[{"place": p, "siblings": s} for p, s in [*w, *tail]] for w in tree.witnesses], _WITNESS)
        return pa.table([*(block.column(c) for c in names), pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string()), own], schema.names)

    return _blocked(nodes).cogroup(above.groupBy("tree", "pos")).applyInArrow(extend, schema)


def _rounds(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """``nodes``, the roots of their blocks, the roots of these ... down to one a tree."""
    rounds = [nodes]
    while most > 1:
        most = -(-most // BLOCK)
        rounds.append(keep(_roots(rounds[-1].select("tree", "pos", "size", "digest")), name))
    if len(rounds) == 1:
        rounds.append(nodes.select("tree", "pos", "size", "digest"))
    return rounds


def manifest(df: DataFrame, leaf: Column, group: str, order: str, carry: Sequence[Column] = ()) -> DataFrame:
    """One row per row of ``df``: ``order``, digest, subroot, root, witness, then ``carry``.

    ``leaf`` is the row's hash. The rows of a ``group`` value ascend by ``order`` (null first), rows
    equal in it by their hash, and rows equal in both stand side by side; each is a leaf of
    its own. Groups ascend as UTF-8 text, null first, and null is not the empty text. The
    witness lists (place in the run, siblings) from the leaf up to the root; ``fold`` turns it and
    the leaf into the root again. Columns of ``carry`` need names other than those; columns of
    ``df`` that are not asked for are not returned, whatever their names. An empty table gives an empty result.
    """
    tree = F.coalesce(F.concat(F.lit("1"), named(group).cast("string")), F.lit("0"))
    leaves = keep(df.select(tree.alias("tree"), named(order).alias("key"), leaf.alias("digest"), F.monotonically_increasing_id().alias("row"), *carry), "leaves")
    extra = leaves.columns[4:]
    nodes = keep(numbered(leaves, [F.col("key").asc_nulls_first(), F.col("digest"), F.col("row")]).drop("row"), "nodes")
    most = nodes.agg(F.max("size")).first()[0] or 0
    rounds = _rounds(nodes, most, "blocks")

    groups = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    tops = keep(numbered(groups, [F.col("name")]), "subroots")
    uppers = _rounds(tops, tops.agg(F.max("size")).first()[0] or 0, "group-blocks")
    above = uppers[-1].select("tree", "pos", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), F.array().cast(WITNESS).alias("witness"))
    above = _descend(uppers, above)
    above = above.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "root", "witness")
    found = _descend(rounds, above)
    return found.select(F.col("key").alias(order), "digest", "subroot", "root", "witness", *extra)


def _descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Witnesses from the uppermost blocks down to the first round's nodes."""
    for at in range(len(rounds) - 2, -1, -1):
        above = _extended(rounds[at], above)
        if at:
            above = keep(above.select("tree", "pos", "subroot", "root", "witness"), "witnesses")
    return above
