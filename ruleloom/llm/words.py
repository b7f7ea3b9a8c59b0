"""Words and word n-grams of Arrow text columns as 64-bit hashes, in numpy.

A word class is a table of 256 truth values over UTF-8 bytes; both classes used
here treat every byte from 0x80 up alike, so bytes and characters agree. Texts
are walked in blocks cut between words, so memory beyond the result (8 bytes a
word) is bounded by the block, not by the longest text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BYTES = np.arange(256)
#: Lower-case ASCII letters, digits and everything beyond ASCII.
ALNUM = (_BYTES >= 0x80) | ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
#: Everything but ASCII white space.
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: A-Z to a-z, other bytes as they are.
FOLD = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def mix(h: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash: every input bit reaches every output bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column's bytes (uint8) and row offsets (int64, one more than rows); null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    if not len(column) or at is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, offsets - offsets[0]


@dataclass
class Words:
    """Word hashes of several texts; ``first[i]:first[i + 1]`` are those of text i."""

    hashes: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1


def hash_words(column: pa.Array, letters: np.ndarray, fold: np.ndarray = FOLD) -> Words:
    """Hash every maximal run of ``letters`` bytes of every text, bytes first mapped by ``fold`` (A-Z lower-cased)."""
    body, offsets = text_bytes(column)
    lut = np.where(letters, _BYTE_HASH[fold], np.uint64(0)).astype(np.uint64)
    hashes, counts = [], np.zeros(len(offsets) - 1, np.int64)
    at = 0
    while at < len(body):
        end = min(at + BLOCK_BYTES, len(body))
        while end < len(body) and letters[body[end - 1]] and letters[body[end]]:
            ahead = letters[body[end : end + 4096]]
            stop = int(np.argmin(ahead)) if not ahead.all() else len(ahead)
            end += stop
            if stop < len(ahead):
                break
        lo, hi = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, end, "left")
        inner = offsets[lo:hi]
        inner = inner[(inner >= at) & (inner < end)] - at
        part = body[at:end]
        inside = letters[part]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        start[inner] = inside[inner]
        starts = np.flatnonzero(start)
        if len(starts):
            spans = np.diff(np.append(starts, len(part)))
            pos = np.arange(starts[0], len(part)) - np.repeat(starts, spans)
            # A separator's value is 0, so its (clipped) place does not matter.
            longest = int(pos[inside[starts[0] :]].max()) + 1
            power = np.cumprod(np.full(longest, _MULTIPLIER, np.uint64))
            values = lut[part[starts[0] :]]
            values *= power[np.minimum(pos, longest - 1)]
            hashes.append(mix(np.add.reduceat(values, starts - starts[0])))
            owner = np.searchsorted(offsets, starts + at, "right") - 1
            np.add.at(counts, *np.unique(owner, return_counts=True))
        at = end
    first = np.zeros(len(offsets), np.int64)
    np.cumsum(counts, out=first[1:])
    return Words(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), first)


def chain(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words of one array (``len(words) - n + 1`` values)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(words) - n + 1, np.uint64(n * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
    # Unrelated odd factors: places must not trade words without the sum noticing.
    factors = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_MULTIPLIER)) | np.uint64(1)
    for k in range(n):
        out += words[k : k + len(out)] * factors[k]
    return mix(out)


def ngram_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of every text and their offsets.

    A text of fewer than ``n`` words, but not none, has one n-gram: all of them.
    """
    grams = chain(words.hashes, n)
    sets, sizes = [], np.zeros(len(words), np.int64)
    for i in range(len(words)):
        lo, hi = words.first[i], words.first[i + 1]
        if hi - lo >= n:
            own = np.unique(grams[lo : hi - n + 1])
        elif hi > lo:
            own = chain(words.hashes[lo:hi], int(hi - lo))
        else:
            continue
        sets.append(own)
        sizes[i] = len(own)
    first = np.zeros(len(words) + 1, np.int64)
    np.cumsum(sizes, out=first[1:])
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), first


def word_starts(column: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start of every word, its length in bytes, first word of every text)."""
    body, offsets = text_bytes(column)
    inside = letters[body]
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets[:-1]] = True
    start = inside & (np.concatenate([[True], ~inside[:-1]]) | edge[:-1]) if len(body) else inside
    stop = inside & (np.concatenate([~inside[1:], [True]]) | edge[1:]) if len(body) else inside
    starts, stops = np.flatnonzero(start), np.flatnonzero(stop)
    return body, starts, stops + 1 - starts, np.searchsorted(starts, offsets)


def prefix_hashes(body: np.ndarray, starts: np.ndarray, sizes: np.ndarray, longest: int):
    """Hash of the first 1, 2, ... ``longest`` bytes of every word, A-Z lower-cased; 0 for shorter words."""
    total, power = np.zeros(len(starts), np.uint64), np.uint64(1)
    for k in range(longest):
        total += _BYTE_HASH[FOLD[body[np.minimum(starts + k, len(body) - 1)]]] * power
        power = np.uint64(int(power) * _MULTIPLIER & 0xFFFFFFFFFFFFFFFF)
        yield np.where(sizes > k, mix(total), np.uint64(0))
