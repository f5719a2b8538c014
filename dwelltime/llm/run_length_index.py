"""Suffix-array dedup: bytes covered by a 200-byte string that starts elsewhere too, by a run-length index.

Only text near a repeated anchor can hold such a string: of any 101 neighbouring 100-byte grams the one with the
smallest hash is an anchor, so equal strings of 200 bytes hold an equal anchor at the same place. Around each anchor
that comes twice 300 bytes are cut out, and those of an anchor come together. Over blocks of them a run-compressed
Burrows-Wheeler transform is built: longest common prefixes are computed where its runs begin, at the sampled run
ends, and streamed along the text to all other positions, each one less than the one before. Suffixes that agree in
200 bytes and stand at different places of the corpus are repeated.

Whole texts that come more than once are covered as a whole; one of them stands for all in the index. An anchor with
more contexts than a block holds is resolved by hashing every 200-byte string of its contexts instead.

Defined results: a null text is empty; texts of fewer than 200 bytes lose nothing; rows that repeat an id and a text
are copies of each other; a row without an id is a document like others. Other columns are ignored. Strings are
compared byte by byte in blocks; anchors, copies and strings of crowded anchors by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwelltime.llm.arrays import _BASE, _BYTE_VALUES, _INVERSE, _powers_of, mix, pieces, utf8
from dwelltime.llm.decontaminate import bounded
from dwelltime.llm.tables import keep_table, text_of

MATCH = 200
GRAM = 100
WINDOW = MATCH - GRAM + 1
BLOCK = 1 << 20
CROWD = 10_000
STEP = 1 << 20


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of size bytes."""
    n = len(data) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(n, np.uint64)
    for low in range(0, n, STEP):
        high = min(n, low + STEP)
        width = high - low + size
        sums = np.zeros(width, np.uint64)
        np.cumsum(_BYTE_VALUES[data[low:high + size - 1]] * _powers_of(_BASE, width)[:width - 1], out=sums[1:])
        k = high - low
        out[low:high] = (sums[size:size + k] - sums[:k]) * _powers_of(_INVERSE, width)[:k]
    return mix(out)


def anchors(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the anchors of several texts."""
    hashed = gram_hashes(data, GRAM)
    if len(hashed) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    bits = np.uint64(max(20, int(len(hashed)).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    low = hashed & ~mask | np.arange(len(hashed), dtype=np.uint64)
    width = 1
    while 2 * width <= WINDOW:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = WINDOW - width
    low = np.minimum(low[:-rest], low[rest:]) if rest else low
    # Windows that stay inside a text.
    ends = np.repeat(offsets[1:], np.diff(offsets))[:len(low)]
    inside = np.arange(len(low)) + MATCH <= ends
    place = np.unique((low[inside] & mask).astype(np.int64))
    return place, hashed[place]


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors with whether they are known to repeat; of those known, one row as witness for other tasks."""
    parts, size = [], 0

    def settle() -> pa.RecordBatch:
        f, doc, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(f, kind="stable")
        f, doc, at = f[order], doc[order], at[order]
        same = f[1:] == f[:-1]
        known = np.append(False, same) | np.append(same, False)
        first = np.append(True, ~same)
        # 0: alone in this task; 1: repeated; 2: repeated, and the witness
        state = np.where(known, np.where(first, 2, 1), 0).astype(np.int8)
        return pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(doc), pa.array(at.astype(np.int32)),
                                           pa.array(state)], ["f", "doc", "at", "state"])

    for batch in pieces(batches, "text", 4 << 20):
        offsets, data = utf8(batch.column("text"))
        place, f = anchors(offsets, data)
        text = np.searchsorted(offsets, place, "right") - 1
        parts.append((f, batch.column("doc").to_numpy()[text], place - offsets[text]))
        size += len(f)
        if size > 2_000_000:
            yield settle()
            parts, size = [], 0
    if parts:
        yield settle()


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of f: those whose f the row before or after has as well, but for witnesses."""
    carried = None
    names = ["f", "doc", "at"]

    def picked(rows: np.ndarray, good: np.ndarray) -> pa.RecordBatch:
        rows = rows[:, good & (rows[3] == 0)]
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.array(rows[2].astype(np.int32))], names)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])
        before = None
        if carried is not None:
            rows = np.concatenate([carried[0], rows], axis=1)
            before = carried[1]
        same = rows[0][1:] == rows[0][:-1]
        good = np.append(same, False)
        good[1:] |= same
        if before:
            good[0] = True
        yield picked(rows[:, :-1], good[:-1])
        carried = (rows[:, -1:], bool(good[-1]))
    if carried is not None:
        yield picked(carried[0], np.array([carried[1]]))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 2 << 20):
        offsets, data = utf8(batch.column("text"))
        raw = data.tobytes()
        lists = batch.column("anchors")
        doc = batch.column("doc").to_numpy()
        count = np.diff(lists.offsets.to_numpy())
        held = lists.flatten()
        f, at = held.field("f").to_numpy(), held.field("at").to_numpy().astype(np.int64)
        text = np.repeat(np.arange(batch.num_rows), count)
        low = offsets[text] + np.maximum(at - (MATCH - GRAM), 0)
        high = np.minimum(offsets[text] + at + MATCH, offsets[text + 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(f), pa.array(doc[text]), pa.array((low - offsets[text]).astype(np.int32)),
             pa.array([raw[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)], pa.binary())],
            ["f", "doc", "at", "context"])


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of the suffixes' first depth symbols at least, by prefix doubling."""
    # As many symbols as fit a word are ranked at once, then twice as many every round.
    n, bits = len(symbols), int(symbols.max() + 1).bit_length()
    width = min(62 // bits, n)
    rank = np.zeros(n, np.int64)
    for k in range(width):
        rank[:n - k] |= (symbols[k:] + 1) << (bits * (width - 1 - k))
    _, rank = np.unique(rank, return_inverse=True)
    while True:
        following = np.zeros(n, np.int64)
        following[:n - width] = rank[width:] + 1
        key = rank * (int(following.max()) + 1) + following
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        number = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = number
        width *= 2
        if width >= depth or number[-1] == n - 1:
            return order


def common_prefixes(symbols: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each rank, the symbols (depth at most) its suffix shares with the one before, from the run-length BWT."""
    n = len(symbols)
    bwt = symbols[order - 1]
    runs = np.flatnonzero(np.append(True, bwt[1:] != bwt[:-1]))  # run heads; the end of the run before is one above
    mine, other = order[runs], order[np.maximum(runs - 1, 0)]
    padded = np.concatenate([symbols, np.arange(depth) - depth])
    length, live = np.zeros(len(runs), np.int64), np.flatnonzero(runs > 0)
    for d in range(depth):
        live = live[padded[mine[live] + d] == padded[other[live] + d]]
        if not len(live):
            break
        length[live] = d + 1
    # Along the text each position that is not at a run's head has one less than the position before.
    sampled = np.full(n, -1, np.int64)
    sampled[mine] = np.arange(len(runs))
    source = np.maximum.accumulate(np.where(sampled >= 0, np.arange(n), 0))
    value = np.where(sampled[source] >= 0, length[sampled[source]], 0)
    # A sample at full depth says nothing of how far it reaches: depth exceeds MATCH by all that a context can use.
    along = np.maximum(value - (np.arange(n) - source), 0)
    return along[order]


def _index_block(doc: np.ndarray, at: np.ndarray, contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, low, high) of the repeated bytes of the contexts of a block."""
    lengths = np.array([len(x) for x in contexts])
    starts = np.cumsum(lengths + 1) - lengths - 1
    symbols = np.zeros(int((lengths + 1).sum()), np.int64)
    keep = np.ones(len(symbols), bool)
    keep[starts + lengths] = False
    symbols[keep] = np.frombuffer(b"".join(contexts), np.uint8)
    symbols[~keep] = 256 + np.arange(len(contexts))  # each context ends in a symbol of its own
    order = suffix_array(symbols, MATCH + GRAM)
    shared = common_prefixes(symbols, order, MATCH + GRAM)
    group = np.cumsum(shared < MATCH)
    context = np.repeat(np.arange(len(contexts)), lengths + 1)[order]
    place = order - starts[context] + at[context]
    # Of a group the members must not all be the same place seen in several contexts.
    whole = np.bincount(group)[group] > 1
    group, context, place = group[whole], context[whole], place[whole]
    seq = np.lexsort((place, doc[context], group))
    group, context, place = group[seq], context[seq], place[seq]
    new = np.append(True, (group[1:] != group[:-1]) | (place[1:] != place[:-1])
                    | (doc[context][1:] != doc[context][:-1])) if len(group) else np.empty(0, bool)
    distinct = np.bincount(group, new, int(group.max()) + 1 if len(group) else 0)
    good = new & (distinct[group] > 1)
    owner, place = doc[context[good]], place[good]
    seq = np.lexsort((place, owner))
    owner, place = owner[seq], place[seq]
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (place[1:] - place[:-1] > MATCH))) \
        if len(owner) else np.empty(0, np.int64)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], place[first], place[last] + MATCH


COVER = "doc long, lo int, hi int, code long"


def _covers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts in order of f and themselves: blocks of whole anchors are indexed, crowded ones give string hashes.

    Equal contexts of an anchor at several places are repeated as a whole; one of them stands for all in the index.
    """
    group: list = []
    whole: list = []
    block: list = []
    size, current, crowded = 0, None, False

    def rows(doc, lo, hi, code=None) -> pa.RecordBatch:
        code = pa.nulls(len(doc), pa.int64()) if code is None else pa.array(code.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(doc, np.int64)), pa.array(np.asarray(lo, np.int32)),
                                           pa.array(np.asarray(hi, np.int32)), code], ["doc", "lo", "hi", "code"])

    def flush() -> pa.RecordBatch:
        doc, at, context = zip(*block, strict=True)
        return rows(*_index_block(np.array(doc), np.array(at), list(context)))

    def strings(part: list) -> Iterator[pa.RecordBatch]:
        for doc, at, context in part:
            code = gram_hashes(np.frombuffer(context, np.uint8), MATCH)
            at = at + np.arange(len(code))
            yield rows(np.full(len(code), doc), at, at + MATCH, code)

    for batch in batches:
        columns = [batch.column(k) for k in ("f", "doc", "at", "context")]
        for f, doc, at, context in zip(*[c.to_pylist() for c in columns], strict=True):
            if f != current:
                if crowded:
                    yield from strings(group)
                elif len(group) > 1:
                    block += group
                    size += sum(len(x[2]) for x in group)
                    if size >= BLOCK:
                        yield flush()
                        block, size = [], 0
                current, group, crowded = f, [], False
            if group and group[-1][2] == context:
                if group[-1][:2] != (doc, at):
                    whole += [(*group[-1][:2], len(context)), (doc, at, len(context))]
                continue
            group.append((doc, at, context))
            if len(group) >= CROWD or crowded:
                yield from strings(group[:-1] if group else [])
                group, crowded = group[-1:], True
        if whole:
            doc, at, length = np.array(sorted(set(whole))).T
            yield rows(doc, at, at + length)
            whole = []
    if crowded:
        yield from strings(group)
    elif len(group) > 1:
        block += group
    if block:
        yield flush()


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 4 << 20):
        offsets, data = utf8(batch.column("text"))
        raw, removed, spans, digests = data.tobytes(), [], [], []
        for i, held in enumerate(batch.column("covers").to_pylist()):
            low, high, gone, runs, kept = int(offsets[i]), int(offsets[i + 1]), 0, 0, []
            position = 0
            for a, b in sorted((x["lo"], x["hi"]) for x in held or []):
                if a > position or runs == 0:
                    kept.append(raw[low + position:low + a])
                    runs += 1
                    gone += b - a
                    position = b
                elif b > position:
                    gone += b - position
                    position = b
            kept.append(raw[low + position:high])
            removed.append(gone)
            spans.append(runs)
            digests.append(hashlib.sha256(b"".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def covers(docs: DataFrame) -> DataFrame:
    """(doc, lo, hi) byte spans, overlapping ones among them, that strings which start elsewhere too cover."""
    named = docs.select(F.xxhash64("doc_id", text_of()).alias("doc"), text_of().alias("text"))
    digests = keep_table(named.select("doc", F.xxhash64("text").alias("same"), F.octet_length("text").alias("n"))
                         .where(F.col("n") >= MATCH), "digests")
    several = digests.groupBy("same").agg(F.count("*").alias("copies"), F.min("doc").alias("one")).where("copies > 1")
    copies = keep_table(digests.join(several, "same"), "copies")
    spare = keep_table(copies.where("doc <> one").select("doc").distinct(), "spare")
    found = keep_table(named.join(bounded(spare), "doc", "left_anti")
                       .mapInArrow(_find_anchors, "f long, doc long, at int, state byte"), "anchors")
    asked = found.where("state <> 1").select("f", "doc", "at", "state")
    alone = asked.repartition("f").sortWithinPartitions("f").mapInArrow(_repeated, "f long, doc long, at int")
    repeated = found.where("state > 0").select("f", "doc", "at").unionByName(alone)
    lists = repeated.groupBy("doc").agg(F.collect_set(F.struct("at", "f")).alias("anchors"))
    cut = (named.join(lists, "doc").select("doc", "text", "anchors")
           .mapInArrow(_contexts, "f long, doc long, at int, context binary"))
    spans = keep_table(cut.repartition("f").sortWithinPartitions("f", "context").mapInArrow(_covers, COVER), "covers")
    strings = spans.where("code is not null").distinct()
    twice = strings.groupBy("code").agg(F.count("*").alias("n")).where("n > 1").select("code")
    return (spans.where("code is null").select("doc", "lo", "hi")
            .unionByName(strings.join(twice, "code").select("doc", "lo", "hi"))
            .unionByName(copies.select("doc", F.lit(0).alias("lo"), F.col("n").alias("hi"))))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = covers(docs).groupBy("doc").agg(F.collect_set(F.struct("lo", "hi")).alias("covers"))
    named = docs.select("doc_id", F.xxhash64("doc_id", text_of()).alias("doc"), text_of().alias("text"))
    return named.join(lists, "doc", "left").select("doc_id", "text", "covers").mapInArrow(
        _cut_out, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
