"""Document fingerprints by locally consistent parsing: phrase names by deterministic coin tossing, level by level.

A text is a sequence of bytes. At every level runs of one symbol become one symbol; then coin tossing gives each symbol
a colour of three that depends on a few neighbours only: a toss is the lowest bit in which a symbol differs from the
one before it, with that bit's value, and some tosses leave six colours, three of which are replaced by one that no
neighbour has. Local maxima of the colours begin phrases of two to about five symbols; a phrase's name is a hash of
its symbols and is a symbol of the next level, until one is left. So equal substrings have equal names inside, at
whatever offset they stand; only names near their edges differ.

A fingerprint is the root's name and the smallest hashes of the distinct names from level three on (phrases of some
fourteen bytes and more). The likeness of two is the estimate of the share of names that they have in common, exact
where both keep all their names.

Defined results: a null text is empty; an empty text has the empty fingerprint, like itself (1) and no other (0); a
text too short for level three has its root as its only name. Documents are taken by descending id, nulls last, and
of equal ids by a hash of the text, so that rows that repeat an id and a text can change places; the last one is
followed by the first, a single one by itself. No documents give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwelltime.llm.arrays import mix, pieces, utf8
from dwelltime.llm.tables import keep_table, text_of

LEVEL, SIZE = 3, 64
PIECE_BYTES = 4 << 20

_FOLD = np.uint64(0x9E3779B97F4A7C15)
_RUN = np.uint64(0xC2B2AE3D27D4EB4F)
_BYTE_NAMES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _toss_table() -> np.ndarray:
    """By symbol and predecessor, both a byte: twice the place of their lowest different bit, plus the symbol's bit."""
    symbol, before = np.divmod(np.arange(65536, dtype=np.uint32), 256)
    differ = symbol ^ before
    place = np.bitwise_count((differ & (~differ + np.uint32(1))) - np.uint32(1)) % 32
    return (2 * place + (symbol >> place & 1)).astype(np.uint8)


_TOSS = _toss_table()
#: The smallest of three colours that neither neighbour has; 7 stands for no neighbour.
_FREE = np.array([[min({0, 1, 2} - {a, b}) for b in range(8)] for a in range(8)], np.uint8)


def _first_toss(symbol: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A toss on 64-bit symbols."""
    out = np.empty(len(symbol), np.uint8)
    differ = symbol[1:] ^ symbol[:-1]
    lowest = differ & (~differ + np.uint64(1))
    out[1:] = 2 * np.bitwise_count(lowest - np.uint64(1)) + ((symbol[1:] & lowest) != 0)
    out[first] = symbol[first] & np.uint64(1)
    return out


def _toss(symbol: np.ndarray, first: np.ndarray) -> np.ndarray:
    pair = symbol.astype(np.uint16) << 8
    pair[1:] |= symbol[:-1]
    out = _TOSS[pair]
    out[first] = symbol[first] & 1
    return out


def colours(symbol: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One of three colours a symbol, unlike its neighbours'; symbols of a text are unlike their neighbours.

    first and last are the places of the first and last symbol of each text.
    """
    colour = symbol if symbol.dtype == np.uint8 else _first_toss(symbol, first)
    for _ in range(3):
        colour = _toss(colour, first)
    around = np.empty(len(colour) + 2, np.uint8)
    for high in (5, 4, 3):
        at = np.flatnonzero(colour == high)
        around[1:-1], around[0], around[-1] = colour, 7, 7
        before, after = around[at], around[at + 2]
        before[np.searchsorted(at, first[colour[first] == high])] = 7
        after[np.searchsorted(at, last[colour[last] == high])] = 7
        colour[at] = _FREE[before, after]
    return colour


def phrases(column: pa.Array, roots: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(level, texts, how many, names) of all phrases, text by text; roots takes the last name of each, 0 if empty."""
    offsets, symbol = utf8(column)
    texts, level = np.flatnonzero(np.diff(offsets)), 0
    first = offsets[texts]
    while len(texts):
        new = np.ones(len(symbol), bool)
        np.not_equal(symbol[1:], symbol[:-1], out=new[1:])
        new[first] = True
        at = np.flatnonzero(new)
        extra, symbol, first = np.diff(at, append=len(symbol)) - 1, symbol[at], np.searchsorted(at, first)
        name = _BYTE_NAMES[symbol] if level == 0 else symbol.copy()
        runs = np.flatnonzero(extra)
        name[runs] += extra[runs].astype(np.uint64) * _RUN
        sizes = np.diff(first, append=len(symbol))
        alone = sizes == 1
        if alone.any():
            roots[texts[alone]] = mix(name[first[alone]])
            go = np.ones(len(symbol), bool)
            go[first[alone]] = False
            symbol, name, texts, sizes = symbol[go], name[go], texts[~alone], sizes[~alone]
            first = np.cumsum(sizes) - sizes
            if not len(texts):
                return
        last = first + sizes - 1
        colour = colours(symbol, first, last)
        begins = np.zeros(len(symbol), bool)
        np.logical_and(colour[1:-1] > colour[:-2], colour[1:-1] > colour[2:], out=begins[1:-1])
        begins[first + 1] = begins[last] = False
        begins[first] = True
        at, level = np.flatnonzero(begins), level + 1
        first, width = np.searchsorted(at, first), np.diff(at, append=len(symbol))
        folded = width.astype(np.uint64) + np.uint64(level << 8)
        # A phrase has two symbols at least, the text being longer than one.
        for k in range(2):
            folded = folded * _FOLD + name[at + k]
        has, k = np.arange(len(at)), 2
        while len(has := has[width[has] > k]):
            folded[has] = folded[has] * _FOLD + name[at[has] + k]
            k += 1
        symbol = mix(folded)
        yield level, texts, np.diff(first, append=len(symbol)), symbol


def sketches(column: pa.Array, level: int = LEVEL, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(roots, keys): a key is the text's number in its high half and a hashed name in its low half, sorted."""
    roots = np.zeros(len(column), np.uint64)
    owner, value = [], []
    for reached, texts, counts, name in phrases(column, roots):
        if reached >= level:
            owner.append(np.repeat(texts, counts))
            value.append(mix(name) >> np.uint64(32))
    has = np.zeros(len(column), bool)
    for text in owner[:1]:
        has[text] = True
    short = np.flatnonzero(~has & (roots != 0))
    owner, value = np.concatenate([*owner, short]), np.concatenate([*value, roots[short] >> np.uint64(32)])
    keys = np.unique(owner.astype(np.uint64) << np.uint64(32) | value)
    return roots, _smallest(keys, size)


def _smallest(keys: np.ndarray, size: int) -> np.ndarray:
    """The first `size` keys of each owner."""
    owner = keys >> np.uint64(32)
    return keys[np.arange(len(keys)) - np.searchsorted(owner, owner) < size]


def likeness(left: np.ndarray, right: np.ndarray, pairs: int, size: int = SIZE) -> np.ndarray:
    """Per pair, the share of the smallest names of both that are in both; 1 where neither has any."""
    both = np.sort(np.concatenate([left, right]))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    shared = both[:-1][~new[1:]]
    kept = _smallest(both[new], size)
    count = lambda keys: np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=pairs)
    total, common = count(kept), count(np.intersect1d(shared, kept, assume_unique=True))
    return np.where(total == 0, 1.0, common / np.maximum(total, 1))


def _spelled(roots: np.ndarray, keys: np.ndarray) -> list[str]:
    """The root's name and the hashed names, in hexadecimal."""
    ends = np.searchsorted(keys >> np.uint64(32), np.arange(len(roots), dtype=np.uint64), "right") * 8
    names = (keys & np.uint64(0xFFFFFFFF)).astype(">u4").tobytes().hex()
    starts = np.concatenate([[0], ends[:-1]])
    return [f"{root:016x}:{names[a:b]}" if b > a else "" for root, a, b in zip(
        roots.tolist(), starts.tolist(), ends.tolist(), strict=True)]


def edited_text(text: str, following: str) -> str:
    """The later half of the code points replaced by as many of the beginning of the text that follows."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _report(texts: list[str], following: list[str] | None, level: int, size: int) -> list[pa.Array]:
    """Columns from n_chars on. Without texts that follow, each but the last is followed by the next of the list."""
    pairs = len(texts) - 1 if following is None else len(texts)
    after = texts[1:] if following is None else following
    edited = [edited_text(a, b) for a, b in zip(texts, after)]
    roots, keys = sketches(pa.array(texts, pa.large_string()), level, size)
    edited_roots, edited_keys = sketches(pa.array(edited, pa.large_string()), level, size)
    if following is None:
        own = keys[:np.searchsorted(keys, np.uint64(pairs << 32))]
        other = keys[np.searchsorted(keys, np.uint64(1 << 32)):] - np.uint64(1 << 32)
    else:
        own, other = keys, sketches(pa.array(following, pa.large_string()), level, size)[1]
    return [pa.array([len(text) for text in texts[:pairs]], pa.int64()),
            pa.array([hashlib.sha256(text.encode()).hexdigest() for text in edited], pa.string()),
            pa.array(_spelled(roots[:pairs], own), pa.string()),
            pa.array(_spelled(edited_roots, edited_keys), pa.string()),
            pa.array(likeness(own, edited_keys, pairs, size)), pa.array(likeness(own, other, pairs, size))]


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_RESULT = [field.split()[0] for field in RESULT.split(", ")]
_NAMES = ["doc_id", *_RESULT, "part", "edge", "text"]
INNER, FIRST, LAST = 0, 1, 2


def _nulls(rows: int, *kinds: pa.DataType) -> list[pa.Array]:
    return [pa.nulls(rows, kind) for kind in kinds]


def _along(level: int, size: int):
    """Rows in order, each reported with the one after it; a part's first and last row leave with their texts."""
    def edge(row: pa.RecordBatch, kind: int) -> pa.RecordBatch:
        blank = _nulls(1, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays(
            [row.column("doc_id"), *blank, row.column("part"), pa.array([kind], pa.int32()),
             row.column("text").cast(pa.string())], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in pieces(batches, "text", PIECE_BYTES):
            if before is None:
                yield edge(batch.slice(0, 1), FIRST)
            else:
                batch = pa.Table.from_batches([before, batch]).combine_chunks().to_batches()[0]
            inner = batch.num_rows - 1
            if inner:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(0, inner), *_report(batch.column("text").to_pylist(), None, level, size),
                     batch.column("part").slice(0, inner), pa.array(np.full(inner, INNER, np.int32)),
                     *_nulls(inner, pa.string())], _NAMES)
            before = batch.slice(inner, 1)
        if before is not None:
            yield edge(before, LAST)
    return run


def _across(level: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_report(
                batch.column("text").to_pylist(), batch.column("following").to_pylist(), level, size)], ["doc_id", *_RESULT])
    return run


def fingerprints(docs: DataFrame, level: int = LEVEL, size: int = SIZE) -> DataFrame:
    """doc_id and the columns of RESULT for every document and the text that follows it by descending id.

    The texts are dealt by ranges of the id and move once. A task streams its range; only the two rows at its edges
    are joined with those of the next range, a row a task.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = [F.desc_nulls_last("doc_id"), "hash", "deal"]
    # Rows that repeat an id and a text may be many: a seeded number deals them over several ranges.
    rows = docs.select("doc_id", text_of().alias("text"), F.xxhash64(text_of()).alias("hash"), F.rand(12).alias("deal"))
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    told = keep_table(ranged.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        _along(level, size), f"doc_id {kind}, {RESULT}, part int, edge int, text string"), "fingerprints")
    first = told.where(F.col("edge") == FIRST).select("part", F.col("text").alias("following"))
    turn = Window.orderBy("part")
    after = first.select("part", F.lead("part").over(turn).alias("later"), F.first("part").over(turn).alias("start"))
    after = after.select("part", F.coalesce("later", "start").alias("then"))
    last = told.where(F.col("edge") == LAST).select("doc_id", "text", "part").join(after, "part")
    seams = last.join(first.withColumnRenamed("part", "then"), "then").select("doc_id", "text", "following")
    return told.where(F.col("edge") == INNER).select("doc_id", *_RESULT).unionByName(
        seams.mapInArrow(_across(level, size), f"doc_id {kind}, {RESULT}"))
