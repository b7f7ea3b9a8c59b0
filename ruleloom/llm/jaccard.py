"""Exact Jaccard self-join of word n-gram sets, as classes of linked documents.

1. Every document becomes its set of n-gram hashes; equal sets are one class.
2. The n-grams of an extended prefix in hash order are counted: a linked set has a share of
   them in other sets, however the rest looks. Classes without drop out here, among them
   those that have but a passage in common with others.
3. The n-grams of the rest are counted; a second prefix filter takes each set's n-grams
   rarest first. Classes that share a prefix n-gram are clustered.
4. Clusters are cut into blocks of bounded bytes, each joined in one task: prefix
   index, length, positional and suffix filter, then the exact intersection, once a
   pair; a pair that is already connected is left out, so a task reports fewer links than
   it has documents. A few pivots of a cut cluster join every block, so that a large
   group of near copies is one component by now.
5. Of a cut cluster, what is not in its heaviest component is joined with all blocks.
   Documents of one component are not compared any more.
6. The links' components are the answer.

The needed overlap of sets of sizes m and n at similarity t is t / (1 + t) * (m + n),
and no less than t * m; so two sets must meet in the first ``m - ceil(t * m) + 1``
n-grams of either, in any common order.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleloom.llm.components import Forest, components
from ruleloom.llm.rows import keep, slices
from ruleloom.llm.words import NOT_SPACE, hash_words, mix, ngram_sets

#: n-grams that one counting bucket holds on average.
BUCKET_GRAMS = 400_000
#: Bytes of n-gram sets in one block of a cluster.
BLOCK_BYTES = 8 << 20
#: Members of a cut cluster that every block of it is joined with, at most.
PIVOTS = 4
#: Rows of a hot cluster are dealt over so many keys where they look up their cluster.
SALTS = 64
#: Classes are broadcast to pick their texts up to so many; beyond that the join shuffles.
BROADCAST_CLASSES = 500_000
SUFFIX_BINS = 16
#: Percent of a set that the first filter looks at beyond the prefix.
BEYOND = 15


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """ceil(percent / 100 * n)."""
    return -(-percent * n // 100)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - needed(n, percent) + 1, 0)


def part_length(n: np.ndarray, percent: int) -> np.ndarray:
    """The extended prefix: of its n-grams, all but ``prefix_length - 1`` are in any linked set."""
    return np.minimum(n, prefix_length(n, percent) + BEYOND * n // 100)


# -- 1 ---------------------------------------------------------------------------------


def digests(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, row, n_shingles, k1, k2) of documents (doc_id, row, text): set size and set digest."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                grams, first = ngram_sets(hash_words(part.column(2), NOT_SPACE), n)
                keys = set_keys(grams, first)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(first)), pa.array(keys[:, 0]), pa.array(keys[:, 1])], ["doc_id", "row", "n_shingles", "k1", "k2"])

    return docs.mapInArrow(run, "doc_id long, row long, n_shingles long, k1 long, k2 long")


def set_keys(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128 bits of every set, as two longs."""
    return np.frombuffer(b"".join(hashlib.blake2b(grams[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first[:-1], first[1:], strict=True)), np.int64).reshape(-1, 2)


def full_sets(docs: DataFrame, n: int) -> DataFrame:
    """(node, n, grams) of documents (node, text)."""
    schema = "node long, n long, grams binary"

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                grams, first = ngram_sets(hash_words(part.column(1), NOT_SPACE), n)
                sets = [grams[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(first)), pa.array(sets, pa.binary())], ["node", "n", "grams"])

    return docs.mapInArrow(run, schema)


# -- 2 and 3: postings, many to a row ----------------------------------------------------


def deal(bucket: np.ndarray, planes: list[np.ndarray]) -> pa.RecordBatch:
    """Postings as one row a bucket: the bucket and each plane's values as a packed array."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    ends = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, np.int64)
    spans = list(zip(ends[:-1], ends[1:], strict=True))
    columns = [pa.array([int(bucket[a]) for a, _ in spans], pa.int32())]
    columns += [pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in (p[order] for p in planes)]
    return pa.RecordBatch.from_arrays(columns, ["bucket", *[f"p{k}" for k in range(len(planes))]])


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(values.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def _gathered(batches, kinds: list) -> list[np.ndarray]:
    parts: list[list[bytes]] = [[] for _ in kinds]
    for batch in batches:
        for k in range(len(kinds)):
            parts[k] += batch.column(k + 1).to_pylist()
    return [np.frombuffer(b"".join(p), kind) for p, kind in zip(parts, kinds, strict=True)]


def meeting(docs: DataFrame, n: int, percent: int, buckets: int) -> DataFrame:
    """(k1, met): how many n-grams of each set's extended prefix some other set's has too.

    Of documents (doc_id, row, text). A task posts a set once, however many copies of it there are in its rows.
    Only five bytes of a hash travel beside its bucket: a rare false meeting keeps a set that the exact
    steps drop later.
    """

    def post(batches):
        posted = set()
        for batch in batches:
            for part in slices(batch, 2):
                grams, first = ngram_sets(hash_words(part.column(2), NOT_SPACE), n)
                names = set_keys(grams, first)[:, 0]
                new = np.zeros(len(names), bool)
                for at, name in enumerate(names.tolist()):
                    new[at] = name not in posted
                    posted.add(name)
                take = np.where(new, part_length(np.diff(first), percent), 0)
                owner = np.repeat(names, take)
                at = np.arange(len(owner)) + np.repeat(first[:-1] - (np.cumsum(take) - take), take)
                grams = grams[at]
                yield deal(bucket_of(grams, buckets), [grams.view(np.uint8).reshape(-1, 8)[:, :5], owner])

    def match(batches):
        packed, owner = _gathered(batches, [np.uint8, np.int64])
        grams = np.zeros((len(owner), 8), np.uint8)
        grams[:, :5] = packed.reshape(-1, 5)
        grams = grams.view(np.uint64).ravel()
        order = np.lexsort((owner, grams))
        grams, owner = grams[order], owner[order]
        # A copy that was read in another task repeats (gram, owner): it counts once.
        one = np.concatenate([[True], (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])])[: len(owner)]
        grams, owner = grams[one], owner[one]
        same = grams[1:] == grams[:-1]
        met = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(owner) else np.zeros(0, bool)
        names, counts = np.unique(owner[met], return_counts=True)
        yield deal(bucket_of(names, buckets), [names, counts.astype(np.uint32)])

    def total(batches):
        owner, counts = _gathered(batches, [np.int64, np.uint32])
        names, at = np.unique(owner, return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(np.bincount(at, counts, len(names)).astype(np.int64))], ["k1", "met"])

    posts = docs.mapInArrow(post, "bucket int, p0 binary, p1 binary")
    met = posts.repartition(buckets, "bucket").mapInArrow(match, "bucket int, p0 binary, p1 binary")
    return met.repartition(buckets, "bucket").mapInArrow(total, "k1 long, met long")


def rare_prefixes(sets: DataFrame, buckets: int, percent: int) -> DataFrame:
    """(gram, node): the n-grams of each set's rarest-first prefix that another set has too."""

    def post(batches):
        for batch in batches:
            for part in slices(batch, 2):
                sizes = part.column(1).to_numpy()
                grams = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint64)
                yield deal(bucket_of(grams, buckets), [grams, np.repeat(part.column(0).to_numpy(), sizes), np.repeat(sizes.astype(np.uint32), sizes)])

    def count(batches):
        grams, owner, size = _gathered(batches, [np.uint64, np.int64, np.uint32])
        _, at, df = np.unique(grams, return_inverse=True, return_counts=True)
        shared = df[at] > 1
        owner = owner[shared]
        yield deal(bucket_of(owner, buckets), [grams[shared], owner, size[shared], df[at][shared].astype(np.uint32)])

    def prefix(batches):
        grams, owner, size, df = _gathered(batches, [np.uint64, np.int64, np.uint32, np.uint32])
        size = size.astype(np.int64)
        order = np.lexsort((grams, df, size, owner))
        grams, owner, size = grams[order], owner[order], size[order]
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (size[1:] != size[:-1])]) if len(owner) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        held = np.diff(np.append(start, len(owner)))
        # n-grams that no other set has come first in the order and take up places.
        place = np.arange(len(owner)) - start[run] + (size - held[run]) if len(owner) else owner
        head = place < prefix_length(size, percent)
        yield pa.RecordBatch.from_arrays([pa.array(grams[head].view(np.int64)), pa.array(owner[head])], ["gram", "node"])

    posts = sets.select("node", "n", "grams").mapInArrow(post, "bucket int, p0 binary, p1 binary, p2 binary")
    counted = posts.repartition(buckets, "bucket").mapInArrow(count, "bucket int, p0 binary, p1 binary, p2 binary, p3 binary")
    return counted.repartition(buckets, "bucket").mapInArrow(prefix, "gram long, node long")


# -- 4 ---------------------------------------------------------------------------------


def join_block(node: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int, within: bool, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (of different components so far) among documents, or between two sides.

    ``known`` names the components that are connected already; by default every row is its own.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    node, side, sizes, sets = node[order], side[order], sizes[order], [sets[i] for i in order]
    first = np.concatenate([[0], np.cumsum(sizes)])
    values, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    by_df = np.lexsort((values, df))
    rank = np.empty(len(values), np.int32)
    rank[by_df] = np.arange(len(values))
    token, df = rank[token], df[by_df].astype(np.int32)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    token = token[np.lexsort((token, owner))]
    place = (np.arange(len(token)) - first[owner]).astype(np.int32)
    bins = np.zeros((len(sets), SUFFIX_BINS), np.int32)
    np.add.at(bins, (owner, token.astype(np.int64) * SUFFIX_BINS // max(1, len(values))), 1)
    head = (place < prefix_length(sizes, percent)[owner]) & (df[token] > 1)
    post_token, post_owner, post_place = token[head], owner[head], place[head]
    by_token = np.argsort(post_token, kind="stable")
    post_from = np.searchsorted(post_token[by_token], np.arange(len(values) + 1))
    index_owner, index_place = post_owner[by_token], post_place[by_token]
    # Both are sorted by document inside a token, so the earlier documents are a front part.
    label, members = np.arange(len(sets)), {}
    if known is not None:
        _, label = np.unique(known[order], return_inverse=True)
        for row, name in enumerate(label.tolist()):
            members.setdefault(name, []).append(row)
    marks = np.zeros(len(values), bool)
    links = []
    doc_from = np.searchsorted(post_owner, np.arange(len(sets) + 1))
    for x in range(len(sets)):
        lo, hi = doc_from[x], doc_from[x + 1]
        if lo == hi:
            continue
        spans = [(post_from[t], post_from[t + 1], p) for t, p in zip(post_token[lo:hi].tolist(), post_place[lo:hi].tolist(), strict=True)]
        ys = np.concatenate([index_owner[a:b] for a, b, _ in spans])
        y_place = np.concatenate([index_place[a:b] for a, b, _ in spans])
        x_place = np.repeat([p for _, _, p in spans], [b - a for a, b, _ in spans])
        fit = (ys < x) & (label[ys] != label[x])
        if not within:
            fit &= side[ys] != side[x]
        # Length: the smaller set (ys come before x) must reach the share on its own.
        fit &= 100 * sizes[ys] >= percent * sizes[x]
        ys, y_place, x_place = ys[fit], y_place[fit], x_place[fit]
        if not len(ys):
            continue
        # Positional: what follows the first meeting place bounds the overlap.
        meet = np.lexsort((y_place, ys))
        ys, y_place, x_place = ys[meet], y_place[meet], x_place[meet]
        one = np.concatenate([[True], ys[1:] != ys[:-1]])
        ys, y_place, x_place = ys[one], y_place[one], x_place[one]
        want = -(-percent * (sizes[ys] + sizes[x]) // (100 + percent))
        fit = 1 + np.minimum(sizes[ys] - y_place, sizes[x] - x_place) - 1 >= want
        ys, want = ys[fit], want[fit]
        # Suffix: bins of the common order bound the overlap.
        fit = np.minimum(bins[ys], bins[x]).sum(axis=1) >= want
        ys, want = ys[fit], want[fit]
        if not len(ys):
            continue
        marks[token[first[x] : first[x + 1]]] = True
        for y, least in zip(ys.tolist(), want.tolist(), strict=True):
            if label[y] != label[x] and np.count_nonzero(marks[token[first[y] : first[y + 1]]]) >= least:
                links.append((int(node[x]), int(node[y])))
                a, b = int(label[x]), int(label[y])
                group_a, group_b = members.pop(a, [a]), members.pop(b, [b])
                if len(group_a) < len(group_b):
                    a, b, group_a, group_b = b, a, group_b, group_a
                label[group_b] = a
                members[a] = group_a + group_b
        marks[token[first[x] : first[x + 1]]] = False
    return links


def with_blocks(rows: DataFrame, cut: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with the ``columns`` of their cluster in ``cut`` (null where it is not there), a hot cluster's rows dealt over salts."""
    salted = cut.select("root", *columns, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, ["root", "salt"], "left").drop("salt")


def dealt(blocks) -> Column:
    """The block of a node, of so many."""
    return F.pmod(F.xxhash64(F.lit("block"), "node"), blocks).cast("int")


def block_links(placed: DataFrame, cut: DataFrame | None, percent: int) -> DataFrame:
    """(a, b): links inside the blocks of clusters, and between them and the pivots of clusters in ``cut``.

    Without ``cut`` every cluster is one block.
    """

    def run(group: pa.Table) -> pa.Table:
        grams = [np.frombuffer(g, np.uint64) for g in group["grams"].to_pylist()]
        return _link_table(join_block(group["node"].to_numpy(), np.zeros(len(grams), np.int64), grams, percent, within=True))

    if cut is None:
        whole = placed.select("root", F.lit(0).alias("block"), "node", "grams")
        return whole.groupBy("root", "block").applyInArrow(run, "a long, b long")
    members = with_blocks(placed, cut, "blocks").select("root", dealt(F.coalesce("blocks", F.lit(1))).alias("block"), "node", "grams")
    chosen = cut.select("root", "blocks", F.explode(F.array_distinct("pivots")).alias("node"))
    # A pivot is in its own block as it is.
    guests = chosen.withColumn("own", dealt(F.col("blocks"))).select("root", "node", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).filter("own <> block")
    guests = guests.join(placed.select("node", "grams"), "node").select("root", "block", "node", "grams")
    return members.unionByName(guests).groupBy("root", "block").applyInArrow(run, "a long, b long")


def cross_links(placed: DataFrame, cut: DataFrame, labels: DataFrame, percent: int, block_bytes: int) -> DataFrame:
    """(a, b): links of the clusters in ``cut`` between documents of different components in ``labels`` (node, label).

    The heaviest component of a cluster is its core: its blocks meet the blocks of the rest only, which
    meet one another too.
    """
    many = F.ceil(F.col("bytes") / block_bytes).cast("int")
    inside = with_blocks(placed, cut, "blocks").filter("blocks is not null").join(labels, "node", "left").select("root", "node", "n", "grams", F.coalesce("label", "node").alias("label"))
    weights = inside.groupBy("root", "label").agg((F.sum("n") * 8).alias("bytes"))
    cores = weights.groupBy("root").agg(F.max(F.struct("bytes", "label")).alias("core"), F.sum("bytes").alias("total"))
    sizes = cores.select("root", F.col("core.label").alias("core"), F.col("core.bytes").alias("bytes"), (F.col("total") - F.col("core.bytes")).alias("rest"))
    sizes = sizes.filter("rest > 0").select("root", "core", many.alias("core_blocks"), F.ceil(F.col("rest") / block_bytes).cast("int").alias("rest_blocks"))
    member = with_blocks(inside, sizes, "core", "core_blocks", "rest_blocks").filter("core is not null")
    is_core = F.col("label") == F.col("core")
    mine = F.when(is_core, F.col("rest_blocks") + dealt(F.col("core_blocks"))).otherwise(dealt(F.col("rest_blocks")))
    others = F.sequence(F.lit(0), F.when(is_core, F.col("rest_blocks") - 1).otherwise(F.col("rest_blocks") + F.col("core_blocks") - 1))
    paired = member.select("root", "node", "label", "grams", mine.alias("mine"), F.explode(others).alias("other"))
    paired = paired.select("root", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "label", "grams")

    def run(group: pa.Table) -> pa.Table:
        grams = [np.frombuffer(g, np.uint64) for g in group["grams"].to_pylist()]
        within = group["i"][0].as_py() == group["j"][0].as_py()
        return _link_table(join_block(group["node"].to_numpy(), group["mine"].to_numpy(), grams, percent, within, group["label"].to_numpy()))

    return paired.groupBy("root", "i", "j").applyInArrow(run, "a long, b long")


def _link_table(links: list[tuple[int, int]]) -> pa.Table:
    ends = np.array(links, np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})


def cluster_components(sets: DataFrame, clusters: DataFrame, percent: int, block_bytes: int) -> DataFrame:
    """(node, root): the components of all links inside clusters (node, root), for nodes that have a link."""
    pivots = F.array(*[F.min_by("node", F.xxhash64(F.lit(k), "node")) for k in range(PIVOTS)])
    weight = F.ceil(F.sum("n") * 8 / block_bytes).cast("int")
    cut = keep(clusters.join(sets.select("node", "n"), "node").groupBy("root").agg(weight.alias("blocks"), pivots.alias("pivots")).filter("blocks > 1"), "cut")
    placed = sets.join(clusters, "node")
    if not cut.limit(1).count():
        return components(keep(block_links(placed, None, percent), "near"), "a", "b")
    # Links are written before the next Python step, so that a task holds one Python worker.
    near = keep(block_links(placed, cut, percent), "near")
    found = keep(components(near, "a", "b"), "found")
    labels = found.withColumnRenamed("root", "label")
    more = keep(cross_links(placed, cut, labels, percent, block_bytes), "more")
    return components(found.toDF("a", "b").union(more), "a", "b")


# -- all -------------------------------------------------------------------------------


def row_key(doc_id: str, text: str) -> Column:
    """Tells the rows of one doc_id, or those without, apart by their texts."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string"))


def shared_ids(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): links between the classes that rows of one doc_id are in."""
    held = signed.filter("n_shingles > 0 and doc_id is not null").select("doc_id", "k1", "k2").distinct()
    least = held.groupBy("doc_id").agg(F.min(F.struct("k1", "k2")).alias("least"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    least = least.join(classes.select(F.struct("k1", "k2").alias("least"), F.col("node").alias("a")), "least").select("doc_id", "a")
    return held.join(least, "doc_id").join(classes.select("k1", "k2", F.col("node").alias("b")), ["k1", "k2"]).select("a", "b")


def linked_rows(docs: DataFrame, doc_id: str, text: str, *, n: int = 5, percent: int = 75, block_bytes: int = BLOCK_BYTES, one_id: bool = True) -> DataFrame:
    """(doc_id, row, n_shingles, component, component_id) of every row; ``row`` is its ``row_key``.

    ``component`` numbers the components of linked classes (null without words); ``component_id`` is the
    smallest doc_id in it. Every class of equal sets has a number of its own, so rows without
    doc_id link like others. With ``one_id`` the classes that rows of one doc_id are in are linked too.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("row"), F.col(text).cast("string").alias("text"))
    signed = keep(digests(texts, n), "digests")
    classes = signed.filter("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("low"), F.min(F.struct("row", "doc_id")).alias("first"), F.first("n_shingles").alias("size"))
    # The numbers are written at once, so they stay as they are if a task is run again.
    classes = keep(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    total = signed.agg(F.sum("n_shingles")).first()[0] or 0
    size, least = F.col("size"), F.ceil(percent * F.col("size") / 100)
    part = F.least(size, size - least + 1 + F.floor(BEYOND * size / 100))
    met = meeting(texts, n, percent, max(1, total * (100 - percent + BEYOND) // 100 // BUCKET_GRAMS))
    left = classes.join(met, "k1").filter(F.col("met") >= part - (size - least)).select("node", "size", F.col("first.row").alias("first_row"), F.col("first.doc_id").alias("first_id"))
    left = keep(left.dropDuplicates(["node"]), "met")
    many, grams = left.agg(F.count(F.lit(1)), F.sum("size")).first()
    chosen = left.select("node", "first_row", "first_id")
    if many <= BROADCAST_CLASSES:
        chosen = F.broadcast(chosen)
    found = texts.join(chosen, (F.col("row") == F.col("first_row")) & F.col("doc_id").eqNullSafe(F.col("first_id"))).select("node", "text")
    sets = full_sets(found, n).filter("n > 0")
    if signed.groupBy("row", "doc_id").count().filter("count > 1").limit(1).count():
        sets = sets.dropDuplicates(["node"])
    sets = keep(sets, "sets")
    heads = keep(rare_prefixes(sets, max(1, (grams or 0) // BUCKET_GRAMS), percent), "heads")
    stars = heads.join(heads.groupBy("gram").agg(F.min("node").alias("head")), "gram").filter("node <> head").select("node", "head").distinct()
    clusters = keep(components(stars, "node", "head"), "clusters")
    links = keep(cluster_components(sets, clusters, percent, block_bytes), "links")
    if one_id:
        links = keep(components(links.toDF("a", "b").union(shared_ids(signed, classes)), "a", "b"), "links")
    lows = links.join(classes.select("node", "low"), "node").groupBy("root").agg(F.min("low").alias("component_id"))
    joined = classes.join(links.join(lows, "root"), "node", "left")
    linked = F.col("root").isNotNull()
    named = joined.select("k1", "k2", F.when(linked, F.col("root")).otherwise(F.col("node")).alias("component"), F.when(linked, F.col("component_id")).otherwise(F.col("low")).alias("component_id"))
    return signed.join(named, ["k1", "k2"], "left").select("doc_id", "row", "n_shingles", "component", "component_id")


def link_classes(docs: DataFrame, doc_id: str, text: str, *, n: int = 5, percent: int = 75, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of
    word ``n``-grams; ``component_id`` is the smallest doc_id that links lead to, the own one
    included. A text of fewer words has one n-gram, all its words; null and empty
    texts have none and are alone. Rows of one doc_id are one document in
    the links; links lead through rows without doc_id as through others, and such a row
    has its component's smallest doc_id, or null if that has none. Repeated rows give
    repeated results; other columns are not returned.
    """
    rows = linked_rows(docs, doc_id, text, n=n, percent=percent, block_bytes=block_bytes)
    return rows.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str, text: str, *, n: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of every component of linked texts one row.

    It is the row with the smallest doc_id, then the smallest hash of id and text; a row without doc_id
    stays only if the component has no other. Of equal rows one stays. Unlike texts under one doc_id are
    unlike documents and all stay, as do all rows without words.
    """
    rows = linked_rows(docs, doc_id, text, n=n, percent=percent, one_id=False).filter("component is not null")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("best")
    best = rows.groupBy("component").agg(best).select(F.col("best.doc_id").alias("best_id"), F.col("best.row").alias("best_row"))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own_id, own_text = F.col(at[doc_id]).cast("long"), F.col(at[text]).cast("string")
    worded = F.coalesce(own_text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = plain.filter(worded).withColumn("row", row_key(at[doc_id], at[text]))
    kept = keyed.join(best, (F.col("row") == F.col("best_row")) & own_id.eqNullSafe(F.col("best_id")), "left_semi").dropDuplicates([at[doc_id], "row"])
    return kept.select(*plain.columns).unionByName(plain.filter(~worded)).toDF(*docs.columns)
