"""Texts of an Arrow batch as flat numpy arrays: bytes, words, hashes, shingles.

Words are runs of other bytes than space and \\x09-\\x0D. Nothing here depends on Spark; these are the helpers
that the Python stages of the operators share, so that no stage works text by text or word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
TEXT_BYTES = 8 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_powers = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, CHUNK_BYTES), np.uint64(base))
        out[0] = 1
        have = _powers[base] = np.multiply.accumulate(out)
    return have


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if len(at) == 0:
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return at - at[0], whole[at[0]:at[-1]]


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds about size bytes of the column, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


class Words:
    """The words of several texts, one after the other."""

    def __init__(self, column: pa.Array, lower: bool = False):
        self.offsets, self.data = utf8(column)
        if lower:
            self.data = _LOWER[self.data]
        inside = ~_SPACE[self.data]
        before = np.empty(len(inside), bool)
        before[1:], before[:1] = inside[:-1], False
        first = self.offsets[:-1]
        before[first[first < len(inside)]] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty(len(inside), bool)
        after[:-1], after[-1:] = inside[1:], False
        last = self.offsets[1:] - 1
        after[last[last >= 0]] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: The words of text i are those from first[i] to before first[i + 1].
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that follow each other."""
    out, i, n = np.empty(len(starts), np.uint64), 0, len(starts)
    while i < n:
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + CHUNK_BYTES, "right")))
        size = int(ends[j - 1]) - low
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data[low:low + size]] * _powers_of(_BASE, size)[:size], out=sums[1:])
        a, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[e] - sums[a]) * _powers_of(_INVERSE, size)[a] + (e - a).astype(np.uint64)
        i = j
    return mix(out)


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash) of every run of size words; a shorter text with a word has one shingle, all of it."""
    hashed = words.hashes()
    inside = np.arange(len(hashed)) - words.first[words.text]
    full = np.flatnonzero(inside + size <= words.counts[words.text])
    value = np.zeros(len(full), np.uint64)
    for k in range(size):
        value = value * np.uint64(_BASE) + hashed[full + k]
    text, position = words.text[full], inside[full]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = words.counts[short] > k
            extra[has] = extra[has] * np.uint64(_BASE) + hashed[words.first[short[has]] + k]
        extra = mix(extra + words.counts[short].astype(np.uint64))
        text, position = np.concatenate([text, short]), np.concatenate([position, np.zeros(len(short), position.dtype)])
        value = np.concatenate([value, extra])
    return text, position, mix(value)


def bags(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, multiplicity), sorted by both."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return text[at], value[at], np.diff(np.append(at, len(text)))


def bag_similarity(left: pa.Array, right: pa.Array, size: int = 5) -> np.ndarray:
    """Weighted Jaccard similarity of the shingle multisets of two columns, row by row; 0 where both are empty."""
    a, b = bags(*shingles(Words(left), size)[::2]), bags(*shingles(Words(right), size)[::2])
    total = np.bincount(a[0], a[2], len(left)) + np.bincount(b[0], b[2], len(left))
    text, value, count = (np.concatenate([x, y]) for x, y in zip(a, b, strict=True))
    order = np.lexsort((value, text))
    text, value, count = text[order], value[order], count[order]
    same = np.flatnonzero((text[1:] == text[:-1]) & (value[1:] == value[:-1]))
    shared = np.bincount(text[same], np.minimum(count[same], count[same + 1]), len(left))
    return shared / np.maximum(total - shared, 1)
