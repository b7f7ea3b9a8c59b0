"""Benchmark decontamination by winnowing.

Texts become hashes of their words. A benchmark window is ``window`` consecutive
words; of every ``window - gram + 1`` consecutive word ``gram``-grams the least
hash (of equals the last) is a fingerprint, of documents and of benchmark items
alike, so any shared run of ``window`` words shares a fingerprint at the same place.
Equal fingerprints are extended word by word to the longest shared run; runs of
``window`` words or more count. An item shorter than a window is one window: its
words are looked up as one gram at every place of a document.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleloom.llm.rows import add_columns, keep
from ruleloom.llm.words import ALNUM, Words, chain, hash_words

#: Characters of benchmark text that one broadcast index covers. A larger benchmark is
#: dealt into several, and the documents pass each in turn.
BLOCK_CHARS = 16_000_000


def winnow(grams: np.ndarray, span: int) -> np.ndarray:
    """Places of the least hash of every ``span`` neighbours (of equals the last), without repeats."""
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = grams[:n].copy()
    place = np.arange(n)
    for k in range(1, span):
        other = grams[k : k + n]
        lower = other <= least
        least[lower] = other[lower]
        place[lower] = np.flatnonzero(lower) + k
    return np.unique(place)


@dataclass
class Index:
    """Fingerprints of one block of benchmark items."""

    window: int
    gram: int
    ids: list = field(default_factory=list)
    words: list = field(default_factory=list)
    prints: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    where: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), np.int64))
    short: dict = field(default_factory=dict)

    def add(self, ids: list, texts: list) -> Index:
        found = hash_words(pa.array(texts, pa.string()), ALNUM)
        prints, where = [self.prints], [self.where]
        for i in range(len(found)):
            own = found.hashes[found.first[i] : found.first[i + 1]]
            if not len(own):
                continue
            number = len(self.ids)
            self.ids.append(ids[i])
            self.words.append(own)
            if len(own) < self.window:
                by_hash = self.short.setdefault(len(own), {})
                by_hash.setdefault(int(chain(own, len(own))[0]), []).append(number)
                continue
            grams = chain(own, self.gram)
            at = winnow(grams, self.window - self.gram + 1)
            prints.append(grams[at])
            where.append(np.stack([np.full(len(at), number), at], axis=1))
        order = np.argsort(all_prints := np.concatenate(prints), kind="stable")
        self.prints, self.where = all_prints[order], np.concatenate(where)[order]
        self.short = {n: (np.sort(np.array(list(m), np.uint64)), m) for n, m in self.short.items()}
        return self

    def hits(self, words: Words) -> list[tuple[int, np.ndarray, set]]:
        """(text, truth value for each of its words, item numbers) for texts that share a window."""
        marks: dict[int, tuple[np.ndarray, set]] = {}
        first, every = words.first, words.hashes
        length = np.diff(first)

        def marked(text: int) -> tuple[np.ndarray, set]:
            return marks.setdefault(text, (np.zeros(length[text], bool), set()))

        if len(self.prints) and len(every) >= self.window:
            grams = chain(every, self.gram)
            # Windows that reach over the end of a text select in vain but do no harm: what they
            # add is a place inside one text, or a gram over two texts, which extension rejects.
            places = winnow(grams, self.window - self.gram + 1)
            at = np.searchsorted(self.prints, grams[places])
            places = places[self.prints[np.minimum(at, len(self.prints) - 1)] == grams[places]]
            owner = np.searchsorted(first, places, "right") - 1
            done: dict[tuple[int, int, int], int] = {}
            for place, text in zip(places.tolist(), owner.tolist(), strict=True):
                lo, hi = np.searchsorted(self.prints, grams[place], "left"), np.searchsorted(self.prints, grams[place], "right")
                for item, at_item in self.where[lo:hi].tolist():
                    if done.get((text, item, place - at_item), -1) >= place:
                        continue
                    begin, end = self._extend(every, int(first[text]), int(first[text + 1]), place, self.words[item], at_item)
                    done[text, item, place - at_item] = end
                    if end - begin >= self.window:
                        mark, items = marked(text)
                        mark[begin - first[text] : end - first[text]] = True
                        items.add(item)
        for n, (known, numbers) in self.short.items():
            grams = chain(every, n)
            if not len(grams):
                continue
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            places = np.flatnonzero(known[at] == grams)
            owner = np.searchsorted(first, places, "right") - 1
            for place, text in zip(places.tolist(), owner.tolist(), strict=True):
                if place + n <= first[text + 1]:
                    mark, items = marked(text)
                    mark[place - first[text] : place - first[text] + n] = True
                    items.update(numbers[int(grams[place])])
        return [(text, mark, items) for text, (mark, items) in sorted(marks.items())]

    @staticmethod
    def _extend(every: np.ndarray, lo: int, hi: int, place: int, item: np.ndarray, at: int) -> tuple[int, int]:
        """The longest run through (place, at) in which text and item have equal words."""
        back, ahead = min(place - lo, at), min(hi - place, len(item) - at)
        differ = np.flatnonzero(every[place - back : place][::-1] != item[at - back : at][::-1])
        begin = place - (int(differ[0]) if len(differ) else back)
        differ = np.flatnonzero(every[place : place + ahead] != item[at : at + ahead])
        return begin, place + (int(differ[0]) if len(differ) else ahead)


RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("hit_words", T.BinaryType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
    ]
)


def find_leaks(docs: DataFrame, text: str, benchmark: DataFrame, item_id: str, item_text: str, *, window: int = 10, gram: int = 5, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents with n_words, n_hit, hit_words (one byte a word, 1 where hit) and item_ids.

    ``hit_words`` is null and ``item_ids`` empty where nothing is shared. Null and empty texts have no
    words; items without words are never found; items of equal words are all
    reported; a null item id is reported as "null". Input columns named like a result
    column give way to it. Rows are judged one by one, so repeated rows get equal results.
    """
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.col(item_text).cast("string").alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * chars // block_chars)) if chars > block_chars else 1
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    spark = docs.sparkSession
    out = docs
    for b in range(blocks):
        rows = items.filter(block == b).filter(F.col("text").isNotNull()).orderBy("id", "text").collect()
        shared = spark.sparkContext.broadcast(Index(window, gram).add([r["id"] for r in rows], [r["text"] for r in rows]))
        out = _pass(out, text, shared, first=b == 0)
        if b + 1 < blocks:
            out = keep(out, "leaks")
    return out


def _pass(docs: DataFrame, text: str, shared, first: bool) -> DataFrame:
    def step(column: pa.Array, *earlier: pa.Array) -> list[pa.Array]:
        index = shared.value
        words = hash_words(column, ALNUM)
        marks = [None] * len(words)
        items: list[list] = [[] for _ in range(len(words))]
        if earlier:
            marks = [None if m is None else np.frombuffer(m, np.uint8).astype(bool) for m in earlier[0].to_pylist()]
            items = [x or [] for x in earlier[1].to_pylist()]
        for i, mark, numbers in index.hits(words):
            marks[i] = mark if marks[i] is None else marks[i] | mark
            items[i] = sorted(set(items[i]) | {index.ids[n] for n in numbers})
        return [
            pa.array(np.diff(words.first), pa.int64()),
            pa.array([0 if m is None else int(m.sum()) for m in marks], pa.int64()),
            pa.array([None if m is None else m.astype(np.uint8).tobytes() for m in marks], pa.binary()),
            pa.array(items, pa.list_(pa.string())),
        ]

    source = docs.withColumn(text, F.col(f"`{text}`").cast("string"))
    return add_columns(source, [text] if first else [text, "hit_words", "item_ids"], RESULT, step)
