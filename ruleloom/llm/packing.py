"""Best-fit packing of documents into sequences of fixed length.

Piece lengths are whole numbers up to the capacity, so pieces of one length are
interchangeable and the packing depends on the count of each length alone:
at most ``capacity`` numbers, however many documents there are. The plan is made
on them:

* Martello-Toth dominance: a set of pieces that fits dominates another one if the
  other's pieces can be dealt to places no smaller than they are. Where one set
  dominates all sets that could hold the longest piece left, it is fixed for as many
  sequences as its lengths allow, and the instance shrinks.
* Best fit, longest first, packs the remainder: each length goes to the open
  sequences with the least room that still holds it.

Spark counts the lengths, numbers the pieces of each length, and looks every piece's
number up in the plan.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleloom.llm.rows import keep, slices

#: Tokenised words that one worker keeps, in each of two generations.
CACHE_WORDS = 300_000


# -- the plan ----------------------------------------------------------------------------


@dataclass
class Kind:
    """``times`` sequences alike: their (length, how many) in order, and the room left."""

    times: int
    holds: list[tuple[int, int]]
    room: int


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> list[Kind]:
    """Fix dominating sets, longest piece first, and take them out of ``counts``.

    For a longest piece j with room r beside it, {j} dominates if nothing fits into r;
    {j, k} with k the longest that fits, if k fills r or no two pieces fit into r
    together. Where at most two pieces fit into r, the pair (a, b) of largest sum
    dominates if every other choice can be dealt to places a, b: any single piece
    is no longer than a, any pair pairwise no longer.
    """
    fixed: list[Kind] = []
    lengths = sorted(x for x in counts if counts[x])
    at = len(lengths) - 1
    while at >= 0:
        j = lengths[at]
        if not counts[j]:
            lengths.pop(at)
            at = len(lengths) - 1 if at >= len(lengths) else at - 1
            continue
        chosen = _dominating(j, lengths, counts, capacity)
        if chosen is None:
            at -= 1
            continue
        use = [j, *chosen]
        need = {x: use.count(x) for x in use}
        times = min(counts[x] // n for x, n in need.items())
        if not times:
            at -= 1
            continue
        for x, n in need.items():
            counts[x] -= n * times
        fixed.append(Kind(times, sorted(need.items(), reverse=True), capacity - sum(use)))
        above = lengths[at]
        lengths = [x for x in lengths if counts[x]]
        # A longer piece that had no dominating set may have one now that others are gone.
        at = len(lengths) - 1 if len(need) < len(use) or above not in lengths else bisect_left(lengths, above)
    return fixed


def _dominating(j: int, lengths: list[int], counts: dict[int, int], capacity: int) -> list[int] | None:
    room = capacity - j

    def free(x: int) -> int:
        return counts[x] - (x == j)

    fitting = [x for x in lengths[: bisect_right(lengths, room)] if free(x) > 0]
    if not fitting:
        return []
    longest = fitting[-1]
    if longest == room:
        return [longest]
    smallest = fitting[0]
    second = smallest if free(smallest) > 1 else (fitting[1] if len(fitting) > 1 else None)
    if second is None or smallest + second > room:
        return [longest]
    third = [x for x in fitting for _ in range(min(3, free(x)))][:3]
    if len(third) > 2 and sum(third) <= room:
        return None
    # At most two fit: the best pair is {longest, b} only if no pair has a longer second.
    rest = [x for x in fitting if x <= room - longest and free(x) > (x == longest)]
    if not rest:
        return None
    b = rest[-1]
    for i, x in enumerate(fitting):
        partner = room - x
        y = bisect_right(fitting, min(partner, x))
        if y and min(x, fitting[y - 1]) > b and (fitting[y - 1] < x or free(x) > 1) and i:
            return None
    return [longest, b]


def best_fit(counts: dict[int, int], capacity: int) -> list[Kind]:
    """Pack all of ``counts``, longest first, each into the fullest sequence that has room."""
    by_room: dict[int, list[Kind]] = {}
    rooms: list[int] = []
    full: list[Kind] = []

    def put(kind: Kind) -> None:
        if not kind.room:
            full.append(kind)
            return
        if kind.room not in by_room:
            by_room[kind.room] = []
            insort(rooms, kind.room)
        by_room[kind.room].append(kind)

    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = min(left, capacity // length)
                times = left // each
                put(Kind(times, [(length, each)], capacity - each * length))
                left -= times * each
                continue
            kind = by_room[rooms[at]].pop()
            if not by_room[rooms[at]]:
                del by_room[rooms.pop(at)]
            each = min(left, kind.room // length)
            times = min(kind.times, left // each)
            if times < kind.times:
                put(Kind(kind.times - times, kind.holds, kind.room))
            put(Kind(times, [*kind.holds, (length, each)], kind.room - each * length))
            left -= times * each
        counts[length] = 0
    return full + [k for r in rooms for k in by_room[r]]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, sequence, each, offset) rows of the whole packing.

    Pieces number ``first`` to ``last`` of a length lie ``each`` to a sequence, from
    sequence number ``sequence`` on, the first of them at ``offset``.
    """
    counts = {x: n for x, n in counts.items() if n}
    if any(not 0 < x <= capacity for x in counts):
        raise ValueError("a piece is longer than a sequence, or empty")
    kinds = reduce_by_dominance(counts, capacity) + best_fit(counts, capacity)
    rows, used, sequence = [], {}, 0
    for kind in kinds:
        offset = 0
        for length, each in kind.holds:
            first = used.get(length, 0)
            used[length] = first + each * kind.times
            rows.append((length, first, used[length] - 1, sequence, each, offset))
            offset += length * each
        sequence += kind.times
    return rows


# -- tokens --------------------------------------------------------------------------------


class WordTokens:
    """Token ids of whole texts as little-endian bytes, each frequent word tokenised once.

    Byte-level pre-tokenisation always splits before a blank or a line feed that
    stands between two characters that are no white space, and after such a line feed, so a
    text without other white space is the sequence of its words' tokens.
    Other texts, those that hold an added token as ``<|endoftext|>``, and all texts under another kind
    of vocabulary, are tokenised whole by ``tokenizers``. Where the file's ids are its merge ranks, single words go through
    ``tiktoken`` with the file's own vocabulary, which gives the same ids faster.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Tokens that stand for themselves wherever a text holds them.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranked = self._ranked(path)
        self.cache = ranked and _Cache(ranked, cache_words)

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _ranked(self, path: str) -> Callable[[str], list[int]] | None:
        """An encoder by ranks, if the file is byte-level BPE whose merges are in order of id."""
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        if (model.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or model["model"].get("type") != "BPE" or model.get("normalizer"):
            return None
        import tiktoken

        # The printable stand-ins of byte-level vocabularies: such bytes as they are, the others from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t["content"] for t in model.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        encode = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        probe = "Don't pre-tokenise 12,345 mots\nd'été: naïve *** über-größe 日本 words"
        return encode if encode(probe) == self._plain(probe) else None

    def batch(self, texts: list[str]) -> list[bytes]:
        if self.cache is None:
            return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        word = self.cache.__getitem__
        self.cache.turn()
        made = []
        for text in texts:
            # A word keeps the line feed before it; the one added in front goes again.
            words = ("\n" + text).replace("\n", " \n")[1:].split(" ")
            # Words with one white space between any two, each a blank or a line feed.
            parts = text.split()
            if len(words) == len(parts) and not any(t in text for t in self.added) and sum(map(len, parts)) == len(text) - len(parts) + 1:
                made.append(b"".join(map(word, words))[4:])
            else:
                made.append(array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes() if text else b"")
        return made


class _Cache(dict):
    """Ids of words; two generations, so that words out of use go and memory stays bounded."""

    def __init__(self, encode: Callable[[str], list[int]], limit: int):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}
        self.marks = {mark: array("I", encode(mark)).tobytes() for mark in ".,"}

    def turn(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None and word[-1] in ".," and "A" <= word[-2:-1] < "\u0250" and word[-2].isalpha():
            # Letters and punctuation are split before tokens are made.
            ids = self[word[:-1]] + self.marks[word[-1]]
        if ids is None:
            ids = array("I", self.encode(word if word[:1] == "\n" else " " + word)).tobytes()
        self[word] = ids
        return ids


_TOKENS: dict[str, WordTokens] = {}


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


PIECES = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def cut_pieces(docs: DataFrame, key: str, text: str, capacity: int, end_id: int, vocabulary: Callable[[], str], with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32 and, if asked for, ids) for every piece of every document."""
    fields = [T.StructField(key, docs.schema[key].dataType), *PIECES.fields]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType(fields)
    end = end_id.to_bytes(4, "little")

    def run(batches):
        path = vocabulary()
        tokens = _TOKENS.setdefault(path, WordTokens(path)) if path not in _TOKENS else _TOKENS[path]
        for batch in batches:
            for part in slices(batch, 1, 4 << 20):
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, body in enumerate(tokens.batch(part.column(1).to_pylist())):
                    body += end
                    n = len(body) // 4
                    at, cut = 0, (n - 1) % capacity + 1
                    number = 0
                    while at < n:
                        own = body[4 * at : 4 * cut]
                        row.append(i)
                        piece.append(number)
                        start.append(at)
                        length.append(cut - at)
                        crc.append(zlib.crc32(own))
                        if with_ids:
                            ids.append(own)
                        at, cut, number = cut, cut + capacity, number + 1
                columns = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text")
    return docs.select(F.col(f"`{key}`"), body).mapInArrow(run, schema)


# -- all -------------------------------------------------------------------------------------


def pack(docs: DataFrame, key: str, text: str, *, capacity: int = 1024, end_id: int = 2, vocabulary: Callable[[], str] = public_vocabulary, with_ids: bool = False) -> DataFrame:
    """Pieces with their places: key, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and ``end_id``; a null text is empty, so every row gives a
    piece. Longer ones than ``capacity`` are cut into pieces of that many, the first may
    be shorter. ``with_ids`` adds the ids as little-endian unsigned 32-bit numbers.
    Repeated rows are packed once each, null keys like others; an empty table gives
    none. Other columns are not returned. ``vocabulary`` gives the tokenizer file's
    path where a task runs.
    """
    pieces = cut_pieces(docs, key, text, capacity, end_id, vocabulary, with_ids)
    pieces = keep(pieces.withColumn("__salt", F.spark_partition_id()), "pieces")
    spark = docs.sparkSession
    sizes = pieces.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("__rows"))
    # At most ``capacity`` rows, however many pieces there are.
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("__rows").alias("n")).collect()}
    rows = plan(counts, capacity)
    places = spark.createDataFrame(rows, "p_length int, first long, last long, sequence long, each long, p_offset long")
    # Pieces of a length are numbered inside a salt, from where the salts before it end.
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sizes.select(F.col("length").alias("s_length"), F.col("__salt").alias("s_salt"), (F.sum("__rows").over(before) - F.col("__rows")).alias("from"))
    inside = F.row_number().over(Window.partitionBy("length", "__salt").orderBy(key, "piece", "ids_crc32")) - 1
    numbered = pieces.join(starts, (F.col("length") == F.col("s_length")) & (F.col("__salt") == F.col("s_salt"))).withColumn("number", F.col("from") + inside)
    # The plan has at most a few rows for each length up to ``capacity``.
    found = numbered.join(F.broadcast(places), (F.col("length") == F.col("p_length")) & F.col("number").between(F.col("first"), F.col("last")))
    nth = F.col("number") - F.col("first")
    return found.select(
        key,
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + F.col("length") * (nth % F.col("each"))).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )
