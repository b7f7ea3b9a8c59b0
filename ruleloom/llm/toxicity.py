"""Toxicity: gradient-boosted trees over dense text features, isotonic calibration.

The lexicons are learned: words, and beginnings of words, that labelled toxic documents
hold significantly more often than others, the words in two tiers and beside a short list
of insults. Features are rates over the whole text: lexicon densities, lexicon words near
the second person, capitals, punctuation and obfuscation (letters swapped for digits and signs).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleloom.llm.labels import crc_of, labelled_sample
from ruleloom.llm.rows import add_columns, keep
from ruleloom.llm.words import ALNUM, FOLD, hash_words, prefix_hashes, text_bytes, word_starts

#: Labelled documents to learn from, at most.
SAMPLE_DOCS = 10_000
#: Lexicon tiers: words with at least this log-odds z-score.
TIERS = (7.0, 3.5)
LEXICON_WORDS = 500
#: Stems: beginnings of so many characters, with at least this z-score and log odds.
STEM_CHARS = (4, 5, 6, 7, 8)
STEM_Z, STEM_ODDS = 6.0, 2.5
STEMS = 200
NEAR = 5
TREES, DEPTH, RATE, BINS, LEAF = 80, 3, 0.15, 32, 10

INSULTS = ("idiot", "idiots", "moron", "stupid", "dumb", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown", "imbecile", "fool", "filth", "vermin", "hate", "kill")
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "vosotros")

#: Signs that stand for letters, as obfuscated words use them (fixed values).
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_LEET_FOLD = FOLD.copy()
for _sign, _letter in STANDS_FOR.items():
    _LEET_FOLD[ord(_sign)] = ord(_letter)
_LEET_LETTERS = ALNUM.copy()
_LEET_LETTERS[[ord("@"), ord("$")]] = True

_CODE = np.arange(256)
_UPPER = (_CODE >= 65) & (_CODE <= 90)
_LETTER = _UPPER | ((_CODE >= 97) & (_CODE <= 122)) | (_CODE >= 128)
_DIGIT = (_CODE >= 48) & (_CODE <= 57)
_SPACE = (_CODE == 32) | ((_CODE >= 9) & (_CODE <= 13))
#: 0 other letters, 1 capitals, 2 digits, 3 white space, 4 exclamation and question marks, 5 signs within words, 6 other punctuation.
_CLASS = np.select([_UPPER, _LETTER, _DIGIT, _SPACE, np.isin(_CODE, [33, 63]), np.isin(_CODE, [35, 36, 37, 38, 42, 64, 95])], [1, 0, 2, 3, 4, 5], 6).astype(np.uint8)
_SWAPPED = _DIGIT | np.isin(_CODE, [33, 36, 42, 64])

FEATURES = ("strong", "strong_count", "weak", "stems", "stem_count", "near_second_person", "second_person", "disguised", "capitals", "digits", "calls", "signs", "punctuation", "swapped", "log_words", "word_length")


def hashes_of(words: list[str]) -> np.ndarray:
    return np.unique(hash_words(pa.array(words, pa.string()), ALNUM).hashes)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _per_text(hits: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(hits, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def stems_of(stems: list[str]) -> dict[int, np.ndarray]:
    """Stem hashes by their length in bytes."""
    by_size: dict[int, list[int]] = {}
    for stem in stems:
        body, starts, sizes, _ = word_starts(pa.array([stem], pa.string()), ALNUM)
        if len(starts) == 1 and sizes[0] == len(body):
            *_, whole = prefix_hashes(body, starts, sizes, len(body))
            by_size.setdefault(len(body), []).append(int(whole[0]))
    return {n: np.unique(np.array(h, np.uint64)) for n, h in by_size.items()}


def features(column: pa.Array, strong: np.ndarray, weak: np.ndarray, stems: dict[int, np.ndarray]) -> np.ndarray:
    """(texts x FEATURES) float64; all zero for an empty text."""
    words = hash_words(column, ALNUM)
    first = words.first
    n = np.diff(first)
    some = np.maximum(n, 1)
    insult = _among(words.hashes, strong)
    person = _among(words.hashes, _SECOND)
    before = np.concatenate([[0], np.cumsum(person, dtype=np.int64)])
    at = np.flatnonzero(insult)
    owner = np.searchsorted(first, at, "right") - 1
    near = before[np.minimum(at + NEAR + 1, first[owner + 1])] - before[np.maximum(at - NEAR, first[owner])] > 0
    beside = np.zeros(len(insult), bool)
    beside[at[near]] = True
    leet = hash_words(column, _LEET_LETTERS, _LEET_FOLD)
    hits = _per_text(insult, first)
    disguised = np.maximum(_per_text(_among(leet.hashes, strong), leet.first) - hits, 0)
    body, starts, sizes, _ = word_starts(column, ALNUM)
    offsets = text_bytes(column)[1]
    stemmed = np.zeros(len(starts), bool)
    if stems and len(starts):
        for size, prefix in enumerate(prefix_hashes(body, starts, sizes, max(stems)), 1):
            if size in stems:
                stemmed |= _among(prefix, stems[size])
    stem_hits = _per_text(stemmed, first)
    swapped = np.zeros(len(body), bool)
    if len(body) > 2:
        swapped[1:-1] = _SWAPPED[body[1:-1]] & _LETTER[body[:-2]] & _LETTER[body[2:]]
    size = np.maximum(np.diff(offsets), 1)
    classes = np.stack([np.bincount(_CLASS[body[a:b]], minlength=7) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]) if len(n) else np.zeros((0, 7), np.int64)
    letters = np.maximum(classes[:, 0] + classes[:, 1], 1)
    return np.stack(
        [
            hits / some,
            np.minimum(hits, 50),
            _per_text(_among(words.hashes, weak), first) / some,
            stem_hits / some,
            np.minimum(stem_hits, 50),
            _per_text(beside, first) / some,
            _per_text(person, first) / some,
            disguised / some,
            classes[:, 1] / letters,
            classes[:, 2] / size,
            classes[:, 4] / size,
            classes[:, 5] / size,
            classes[:, 6] / size,
            _per_text(swapped, offsets) / some,
            np.log1p(n),
            np.minimum(letters / some, 100) * (n > 0),
        ],
        axis=1,
    ).astype(np.float64)


_SECOND = hashes_of(list(SECOND_PERSON))


# -- boosted trees ---------------------------------------------------------------------


@dataclass
class Tree:
    """A complete tree: inner node i splits on ``feature[i] <= cut[i]``, children 2i+1 and 2i+2."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.cut[node])
        return self.value[node - (2**DEPTH - 1)]


def _grow(binned: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray) -> tuple[Tree, np.ndarray]:
    inner = 2**DEPTH - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(grad), np.int64)
    for i in range(inner):
        rows = np.flatnonzero(node == i)
        best = 1e-6
        g, h = grad[rows].sum(), hess[rows].sum()
        split = np.zeros(len(rows), bool)
        for f in range(binned.shape[1]) if len(rows) >= 2 * LEAF else ():
            b = binned[rows, f]
            gl = np.cumsum(np.bincount(b, grad[rows], BINS))[:-1]
            hl = np.cumsum(np.bincount(b, hess[rows], BINS))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=BINS))[:-1]
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(nl < LEAF) | (len(rows) - nl < LEAF)] = 0
            k = int(gain.argmax())
            if gain[k] > best and k < len(cuts[f]):
                best, feature[i], cut[i], split = gain[k], f, cuts[f][k], b > k
        node[rows] = 2 * i + 1 + split
    leaf = node - inner
    value = np.bincount(leaf, grad, 2**DEPTH) / (np.bincount(leaf, hess, 2**DEPTH) + 1)
    return Tree(feature, cut, RATE * value), RATE * value[leaf]


def boost(x: np.ndarray, y: np.ndarray) -> tuple[float, list[Tree]]:
    """Log-odds of the base rate and trees fitted to the log loss; no trees for fewer than two classes."""
    if not 0 < y.sum() < len(y):
        return (0.0 if not len(y) else 4.0 if y[0] else -4.0), []
    cuts, binned = [], np.zeros(x.shape, np.int64)
    for f in range(x.shape[1]):
        own = np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
        positive = x[x[:, f] > 0, f]
        if len(own) < BINS // 2 and len(positive):
            own = np.unique(np.concatenate([[0.0], np.quantile(positive, np.linspace(0, 1, BINS - 1)[:-1])]))
        cuts.append(own[: BINS - 1])
        binned[:, f] = np.searchsorted(cuts[-1], x[:, f], "left")
    rate = float(y.mean())
    base = float(np.log(rate / (1 - rate)))
    margin, trees = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        tree, add = _grow(binned, cuts, y - p, p * (1 - p))
        trees.append(tree)
        margin += add
    return base, trees


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (score, probability) points of the calibration curve."""
    order = np.argsort(score, kind="stable")
    xs, at = np.unique(score[order], return_inverse=True)
    total, weight = np.bincount(at, y[order]), np.bincount(at).astype(float)
    pools: list[list[float]] = []
    for i in range(len(xs)):
        pools.append([total[i], weight[i], i, i])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            t, w, _, last = pools.pop()
            pools[-1][0] += t
            pools[-1][1] += w
            pools[-1][3] = last
    points = [(xs[k], (t + 0.5) / (w + 1)) for t, w, a, b in pools for k in sorted({int(a), int(b)})]
    return np.array([p[0] for p in points]), np.maximum.accumulate(np.array([p[1] for p in points]))


@dataclass
class Model:
    strong: np.ndarray
    weak: np.ndarray
    stems: dict[int, np.ndarray]
    base: float
    trees: list[Tree]
    curve: tuple[np.ndarray, np.ndarray]

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.predict(x)
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        margin = self.margins(features(column, self.strong, self.weak, self.stems))
        if not len(self.curve[0]):
            return 1 / (1 + np.exp(-margin))
        return np.clip(np.interp(margin, *self.curve), 0, 1)


# -- learning and scoring ------------------------------------------------------------------


def learn_lexicon(sample: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """(strong words, weak words, stems) that toxic documents of the sample hold more often, by the z-score of the log odds."""
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_distinct(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    begun = F.array_distinct(F.flatten(F.array(*[F.transform(F.filter("words", lambda w: F.length(w) > n), lambda w: F.substring(w, 1, n)) for n in STEM_CHARS])))
    named = sample.select("label", words.alias("words")).select("label", F.posexplode(F.array("words", begun)).alias("stem", "own")).select("label", "stem", F.explode("own").alias("word"))
    n = sample.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    toxic, clean = (n[0] or 0) + 1, (n[1] or 0) + 1
    counted = named.filter("word <> ''").groupBy("stem", "word").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")).filter("t >= 3")
    odds = F.log((F.col("t") + 0.5) / (F.lit(toxic) - F.col("t"))) - F.log((F.col("c") + 0.5) / (F.lit(clean) - F.col("c")))
    z = odds / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    scored = counted.select("stem", "word", odds.alias("odds"), z.alias("z"))
    top = scored.filter((F.col("stem") == 0) & (F.col("z") >= TIERS[1])).orderBy(F.desc("z"), "word").limit(LEXICON_WORDS).collect()
    stems = scored.filter((F.col("stem") == 1) & (F.col("z") >= STEM_Z) & (F.col("odds") >= STEM_ODDS)).orderBy(F.desc("z"), "word").limit(STEMS).collect()
    return [r["word"] for r in top if r["z"] >= TIERS[0]], [r["word"] for r in top if r["z"] < TIERS[0]], [r["word"] for r in stems]


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", *, folds: int = 3, held_out: int = 1, most: int = SAMPLE_DOCS) -> Model:
    """Fit on at most ``most`` labelled documents whose crc32 of the key mod ``folds`` is not ``held_out``.

    A third of them, by another hash of the key, only calibrate. Without labels, or with one class
    only, scores are constant.
    """
    sample = labelled_sample(docs, labels, key, text, label, crc_of(key) % folds != held_out, most)
    # Written once: several steps read the bounded sample, none the corpus again.
    sample = keep(sample.withColumn("fit", F.pmod(F.xxhash64(F.lit("fit"), key), F.lit(3)) > 0), "toxicity-sample")
    found, weak, stems = learn_lexicon(sample.filter("fit"))
    stems = stems_of(stems)
    strong = hashes_of([*INSULTS, *found])
    weak = hashes_of(weak)

    def measure(batches):
        for batch in batches:
            x = features(batch.column(1), strong, weak, stems)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(list(x), pa.list_(pa.float64()))], ["key", "label", "fit", "x"])

    schema = T.StructType([T.StructField("key", sample.schema[key].dataType), T.StructField("label", T.IntegerType()), T.StructField("fit", T.BooleanType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    rows = sample.select(key, "text", "label", "fit").mapInArrow(measure, schema).orderBy("key").collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(-1, len(FEATURES))
    y = np.array([r["label"] > 0 for r in rows], np.float64)
    mine = np.array([r["fit"] for r in rows], bool)
    base, trees = boost(x[mine], y[mine])
    model = Model(strong, weak, stems, base, trees, (np.zeros(0), np.zeros(0)))
    if trees and (~mine).any():
        model.curve = isotonic(model.margins(x[~mine]), y[~mine])
    return model


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """The documents with ``out``, the probability of being toxic. Null and empty texts have all features 0.

    A column already named ``out`` gives way; rows are scored one by one, whole texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(column: pa.Array) -> list[pa.Array]:
        return [pa.array(shared.value.scores(column), pa.float64())]

    source = docs.withColumn(text, F.col(f"`{text}`").cast("string"))
    return add_columns(source, [text], T.StructType([T.StructField(out, T.DoubleType())]), step)
