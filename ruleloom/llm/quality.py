"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters slide over overlapping chunks that cover the whole
document; each filter's greatest answer in a chunk is kept, the chunks' vectors are
averaged, and a logistic unit makes one probability of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleloom.llm.labels import crc_of, labelled_sample
from ruleloom.llm.rows import add_columns
from ruleloom.llm.words import text_bytes

CHUNK, STEP = 256, 224
WIDTH, STRIDE, EMBED, FILTERS = 8, 2, 6, 24
#: Labelled documents to learn from, at most; of each all chunks.
SAMPLE_DOCS = 4_000
EPOCHS, BATCH, RATE = 12, 32, 0.01
#: Places of a filter in a chunk.
PLACES = (CHUNK - WIDTH) // STRIDE + 1
#: Chunks that are convolved at a time.
BLOCK = 512


def chunk_matrix(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunks x CHUNK bytes, 0 beyond a text's end; the text each chunk is of). An empty text has one chunk of zeros."""
    size = np.diff(offsets)
    many = np.maximum(1, -(-(size - (CHUNK - STEP)) // STEP))
    owner = np.repeat(np.arange(len(size)), many)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    out = np.zeros((len(owner), CHUNK), np.uint8)
    start = offsets[owner] + nth * STEP
    held = np.minimum(offsets[owner + 1] - start, CHUNK)
    for k in range(0, len(owner), BLOCK):
        at = start[k : k + BLOCK, None] + np.arange(CHUNK)
        inside = np.arange(CHUNK) < held[k : k + BLOCK, None]
        if len(body):
            out[k : k + BLOCK] = np.where(inside, body[np.minimum(at, len(body) - 1)], 0)
    return out, owner


@dataclass
class Network:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    base: float

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        code = np.arange(256)
        embed = rng.normal(0, 0.3, (256, EMBED)).astype(np.float32)
        for k, known in enumerate([(code >= 65) & (code <= 90), (code >= 97) & (code <= 122), code == 32, ((code > 32) & (code < 48)) | ((code > 57) & (code < 65)), code >= 128]):
            embed[:, k] += known
        embed[0] = 0
        return cls(embed, rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), np.zeros(FILTERS, np.float32), 0.0)

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, places, WIDTH * EMBED) embedded bytes under each filter place."""
        made = self.embed[chunks]
        n, places = len(chunks), PLACES
        a, b, c = made.strides
        return np.lib.stride_tricks.as_strided(made, (n, places, WIDTH * EMBED), (a, STRIDE * b, c)).reshape(n * places, WIDTH * EMBED)

    def scores(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One probability for each text."""
        chunks, owner = chunk_matrix(body, offsets)
        total = np.zeros((len(offsets) - 1, FILTERS))
        for k in range(0, len(chunks), BLOCK):
            seen = self.windows(chunks[k : k + BLOCK]) @ self.filters
            top = np.maximum(seen.reshape(-1, PLACES, FILTERS).max(axis=1) + self.bias, 0)
            np.add.at(total, owner[k : k + BLOCK], top)
        mean = total / np.bincount(owner, minlength=len(offsets) - 1)[:, None]
        return 1 / (1 + np.exp(-np.clip(mean @ self.out + self.base, -30, 30)))


def fit(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Learn all weights by Adam on the log loss; classes weigh equally up to a factor of 4."""
    net = Network.fresh(seed)
    labels = np.asarray(labels, np.float32)
    good = float(labels.mean()) if len(labels) else 0.5
    if not 0 < good < 1:
        net.base = 4.0 if good == 1 else -4.0 if len(labels) else 0.0
        return net
    weight = np.where(labels == 1, 1.0, min(4.0, good / (1 - good))).astype(np.float32)
    made = [chunk_matrix(*text_bytes(pa.array([t], pa.string())))[0] for t in texts]
    rng = np.random.default_rng(seed)
    base = np.zeros(1, np.float32)
    params = [net.embed, net.filters, net.bias, net.out, base]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    total = epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            chunks = np.concatenate([made[r] for r in rows])
            owner = np.repeat(np.arange(len(rows)), [len(made[r]) for r in rows])
            many = np.bincount(owner).astype(np.float32)
            # Texts may be long: chunks pass in blocks, forth and back.
            blocks = [slice(k, k + BLOCK) for k in range(0, len(chunks), BLOCK)]
            best, top = np.zeros((len(chunks), FILTERS), np.int64), np.zeros((len(chunks), FILTERS), np.float32)
            for block in blocks:
                answers = (net.windows(chunks[block]) @ net.filters).reshape(-1, PLACES, FILTERS)
                best[block] = answers.argmax(axis=1)
                top[block] = np.maximum(np.take_along_axis(answers, best[block][:, None], 1)[:, 0] + net.bias, 0)
            mean = np.zeros((len(rows), FILTERS), np.float32)
            np.add.at(mean, owner, top)
            mean /= many[:, None]
            p = 1 / (1 + np.exp(-np.clip(mean @ net.out + base[0], -30, 30)))
            d = (p - labels[rows]) * weight[rows] / len(rows)
            d_top = (d[:, None] * net.out / many[:, None])[owner] * (top > 0)
            d_filters, d_embed = np.zeros_like(net.filters), np.zeros_like(net.embed)
            for block in blocks:
                own, at_best, back = chunks[block], best[block], d_top[block]
                # The bytes under each filter's best place.
                under = own[np.arange(len(own))[:, None, None], at_best[:, :, None] * STRIDE + np.arange(WIDTH)]
                d_filters += np.einsum("nfk,nf->kf", net.embed[under].reshape(len(own), FILTERS, WIDTH * EMBED), back)
                spread = back[:, :, None, None] * net.filters.T.reshape(1, FILTERS, WIDTH, EMBED)
                for k in range(EMBED):
                    d_embed[:, k] += np.bincount(under.reshape(-1), spread[..., k].reshape(-1), 256)
            d_embed[0] = 0
            grads = [d_embed, d_filters, d_top.sum(axis=0), mean.T @ d, d.sum(keepdims=True)]
            step += 1
            rate = RATE * min(1.0, 2 * (1 - step / (total + 1)))
            for param, grad, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                param -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    net.base = float(base[0])
    return net


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", *, folds: int = 5, held_out: int = 0, most: int = SAMPLE_DOCS) -> Network:
    """Fit on at most ``most`` labelled documents whose crc32 of the key mod ``folds`` is not ``held_out``.

    Whole texts are learned from. Without labels, or with one class only, scores are constant.
    """
    sample = labelled_sample(docs, labels, key, text, label, crc_of(key) % folds != held_out, most)
    rows = sample.select(key, "text", "label").orderBy(F.xxhash64(key), key).collect()
    return fit([r["text"] for r in rows], np.array([r["label"] > 0 for r in rows]))


def score(docs: DataFrame, net: Network, text: str = "text", out: str = "score") -> DataFrame:
    """The documents with ``out``, a probability of being good. Null and empty texts have the score of an empty chunk.

    A column already named ``out`` gives way; rows are scored one by one, whole texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def step(column: pa.Array) -> list[pa.Array]:
        return [pa.array(shared.value.scores(*text_bytes(column)), pa.float64())]

    source = docs.withColumn(text, F.col(f"`{text}`").cast("string"))
    return add_columns(source, [text], T.StructType([T.StructField(out, T.DoubleType())]), step)
