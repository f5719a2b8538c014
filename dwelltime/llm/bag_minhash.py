"""MinHash near-dedup: weighted signatures from hierarchical Poisson processes, bands, verified multiset overlap.

A text is the multiset of its five-word shingles. Multiplicities are the discretised weights: the levels [0, 1),
[1, 2), [2, 4), [4, 8) and so on each have their own Poisson process per shingle, whose points carry an arrival
time, a signature component and a level. A shingle of weight w takes all points below w, so two texts share the
earliest point of a component with probability equal to their weighted Jaccard similarity. Points come in order of
time and stop once they are later than every component, which takes about one point per shingle plus
m log m per text.

Defined results: a null text is empty; texts without a word are alike only if they are equal; a text of fewer than
five words is one shingle; rows with equal texts are of one class, whatever their ids; a class is named by its
smallest doc_id (null if all are null). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwelltime.llm.arrays import Words, bag_similarity, bags, mix, pieces, shingles
from dwelltime.llm.components import components
from dwelltime.llm.tables import free_name, keep_table, text_of

BANDS, ROWS = 28, 5
#: Groups of up to so many rows are compared side by side; columns of an incidence matrix at a time.
_SMALL, _COLUMNS = 64, 2048
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _processes(text: np.ndarray, value: np.ndarray, count: np.ndarray):
    """(text, seed, rate, share) of every level process that a weighted shingle takes points from."""
    parts, low, high = [], 0, 1
    while True:
        has = np.flatnonzero(count > low)
        if not len(has):
            break
        width = high - low
        seed = mix(value[has] + np.uint64((low + 1) * 0xD6E8FEB86659FD93 % (1 << 64)))
        share = np.minimum(1.0, (count[has] - low) / width)
        parts.append((text[has], seed, np.full(len(has), float(width)), share))
        low, high = high, high * 2
    if not parts:
        return (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0), np.empty(0))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def signatures(text: np.ndarray, value: np.ndarray, count: np.ndarray, n_texts: int, size: int) -> np.ndarray:
    """The identity of the earliest point per text and component; 0 for texts without a shingle."""
    first = np.full(n_texts * size, np.inf)
    ident = np.zeros(n_texts * size, np.uint64)
    text, seed, rate, share = _processes(text, value, count)
    time, k = np.zeros(len(text)), 0
    while len(text):
        k += 1
        point = mix(seed + np.uint64(k * int(_STEP) % (1 << 64)))
        uniform = (point >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        time = time - np.log1p(-uniform) / rate
        place = mix(point + _STEP)
        slot = text * size + (place >> np.uint64(32)).astype(np.int64) % size
        level = (place & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32
        taken = np.flatnonzero(level < share)
        np.minimum.at(first, slot[taken], time[taken])
        won = taken[first[slot[taken]] == time[taken]]
        ident[slot[won]] = point[won]
        go = time < first.reshape(n_texts, size).max(axis=1)[text]
        text, seed, rate, share, time = text[go], seed[go], rate[go], share[go], time[go]
    return ident.reshape(n_texts, size)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per text and band."""
    out = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        out = mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + signature[:, r::rows][:, :bands])
    return mix(out + np.arange(bands, dtype=np.uint64) * _STEP)


def _sign(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            n = batch.num_rows
            text, _, value = shingles(Words(batch.column("text")))
            bag = bags(text, value)
            keys = band_keys(signatures(*bag, n, bands * rows), bands, rows).view(np.int64)
            total = np.bincount(bag[0], bag[2], n).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.ravel()))
            out = pa.RecordBatch.from_arrays([batch.column("node"), pa.array(total), lists], ["node", "n", "keys"])
            yield out.filter(pa.array(total > 0))
    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text_a"):
        similarity = bag_similarity(batch.column("text_a"), batch.column("text_b"))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(similarity)],
                                         ["a", "b", "similarity"])


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(_compare, "a long, b long, similarity double").where(F.col("similarity") >= threshold))


def _undecided(state: DataFrame) -> DataFrame:
    """The rows of buckets that still hold several components."""
    several = (state.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
               .where("low <> high").select("key"))
    return state.join(several, "key")


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text's shingles as a set of numbers: the k-th occurrence of a shingle is an element of its own."""
    for batch in pieces(batches, "text"):
        n = batch.num_rows
        text, _, value = shingles(Words(batch.column("text")))
        text, value, count = bags(text, value)
        at = np.repeat(np.arange(len(text)), count)
        turn = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        token = mix(value[at] + turn.astype(np.uint64) * _STEP).view(np.int64)
        ends = np.concatenate([[0], np.cumsum(np.bincount(text[at], minlength=n))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(token))], ["node", "tokens"])


def _joining(pairs: np.ndarray) -> np.ndarray:
    """Those of the pairs of components that a forest needs."""
    parent, kept = {}, []

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for at, (a, b) in enumerate(pairs.tolist()):
        a, b = find(a), find(b)
        if a != b:
            parent[a] = b
            kept.append(at)
    return pairs[kept]


def _overlaps_in_groups(group: np.ndarray, owner: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, how many) of rows of one group that share tokens, for many small groups side by side.

    Sorted by group and token, the rows that share a token are neighbours; they are taken one lag after the other.
    """
    order = np.lexsort((owner, token, group[owner]))
    owner, token = owner[order], token[order]
    held, rows = group[owner], len(group)
    at, lag, codes = np.arange(len(token)), 1, []
    while len(at := at[at + lag < len(token)]):
        at = at[(token[at] == token[at + lag]) & (held[at] == held[at + lag])]
        codes.append(owner[at] * rows + owner[at + lag])
        lag += 1
    code, count = np.unique(np.concatenate([np.empty(0, np.int64), *codes]), return_counts=True)
    return code // rows, code % rows, count


def _overlaps_of_blocks(sizes: np.ndarray, token: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many tokens each row of one block shares with each of another, by products of incidence matrices."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    number, place = np.unique(token, return_inverse=True)
    row_of = lambda rows: np.where(np.isin(np.arange(len(sizes)), rows), np.searchsorted(rows, np.arange(len(sizes))), -1)
    a, b = row_of(left)[owner], row_of(right)[owner]
    in_a = np.bincount(place[a >= 0], minlength=len(number)) > 0
    in_b = np.bincount(place[b >= 0], minlength=len(number)) > 0
    common = np.flatnonzero(in_a & in_b if left is not right else np.bincount(place, minlength=len(number)) > 1)
    column = np.full(len(number), -1)
    column[common] = np.arange(len(common))
    column = column[place]
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, len(common), _COLUMNS):
        here = (column >= low) & (column < low + _COLUMNS)
        sides = []
        for rows, of in ((left, a), (right, b)):
            mine = here & (of >= 0)
            matrix = np.zeros((len(rows), min(_COLUMNS, len(common) - low)), np.float32)
            matrix[of[mine], column[mine] - low] = 1
            sides.append(matrix)
        out += sides[0] @ sides[1].T
    return out


def _linked(batch: pa.RecordBatch, threshold: float) -> np.ndarray:
    """Pairs of components that whole groups of rows join: all rows of two blocks are held against each other."""
    component = batch.column("component").to_numpy()
    tokens = batch.column("tokens")
    ends = tokens.offsets.to_numpy()
    token, sizes = tokens.values.to_numpy()[ends[0]:ends[-1]], np.diff(ends).astype(np.int64)
    edges = _group_starts(batch)
    rows_of = np.diff(edges)
    group = np.repeat(np.arange(len(rows_of)), rows_of)
    owner, small, found = np.repeat(np.arange(len(sizes)), sizes), rows_of[group] <= _SMALL, []
    like = lambda a, b, shared: (shared >= threshold * (sizes[a] + sizes[b] - shared)) & (component[a] != component[b])

    mine = small[owner]
    a, b, shared = _overlaps_in_groups(group, owner[mine], token[mine])
    hit = like(a, b, shared)
    found.append(np.stack([component[a[hit]], component[b[hit]]], 1))
    left_side, starts = batch.column("leftmost").to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        if high - low <= _SMALL:
            continue
        left, right = np.flatnonzero(left_side[low:high]), np.flatnonzero(~left_side[low:high])
        right = right if len(right) else left
        shared = _overlaps_of_blocks(sizes[low:high], token[starts[low]:starts[high - 1] + sizes[high - 1]], left, right)
        a, b = np.nonzero(shared * (1 + threshold) >= threshold * (
            sizes[low + left][:, None] + sizes[low + right][None, :]) - 1e-3)
        shared, a, b = shared[a, b], low + left[a], low + right[b]
        hit = like(a, b, shared)
        found.append(np.stack([component[a[hit]], component[b[hit]]], 1))
    return _joining(np.unique(np.concatenate(found), axis=0))


_GROUP = ["family", "kind", "low", "high"]


def _group_starts(batch: pa.RecordBatch) -> np.ndarray:
    """Where groups begin, and the end."""
    keys = np.stack([batch.column(name).to_numpy() for name in _GROUP], 1)
    return np.concatenate([[0], np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1, [batch.num_rows]])


def _compare_blocks(threshold: float, tokens: int):
    """Links of groups that come sorted one after the other; several whole groups are compared at once."""
    def told(batch: pa.RecordBatch) -> pa.RecordBatch:
        links = _linked(batch, threshold)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            if sum(len(b.column("tokens").flatten()) for b in held) < tokens:
                continue
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            last = int(_group_starts(whole)[-2])  # the last group may go on
            if last:
                yield told(whole.slice(0, last))
            held = [whole.slice(last)]
        if held:
            yield told(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
    return run


def _block_pairs(rows: DataFrame, block_tokens: int, block_rows: int) -> DataFrame:
    """The undecided rows of families once for each pair of blocks that they are in.

    A family's largest component is one side, all others the other; blocks of the first are held against those of
    the second, and those of the second against each other. Blocks have a bounded number of rows and tokens.
    """
    parts = rows.groupBy("family", "component").agg(F.count("*").alias("m"), F.sum("n").alias("tokens"))
    split = parts.groupBy("family").agg(F.max(F.struct("m", "tokens", "component")).alias("main"),
                                        F.sum("m").alias("m"), F.sum("tokens").alias("tokens")).where("m > main.m")
    blocks = lambda m, tokens: F.greatest(F.ceil(m / block_rows), F.ceil(tokens / block_tokens)).cast("int")
    split = split.select(
        "family", F.col("main.component").alias("main"), blocks(F.col("main.m"), F.col("main.tokens")).alias("mains"),
        blocks(F.col("m") - F.col("main.m"), F.col("tokens") - F.col("main.tokens")).alias("others"))
    is_main = F.col("component") == F.col("main")
    placed = rows.join(split, "family").withColumn("block", F.pmod(
        F.xxhash64("node"), F.when(is_main, F.col("mains")).otherwise(F.col("others"))).cast("int"))
    pair = lambda kind, low, high, leftmost: F.struct(
        F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"), leftmost.alias("leftmost"))
    upto = lambda count: F.sequence(F.lit(0), count - 1)
    block = F.col("block")
    met = F.when(is_main, F.transform(upto(F.col("others")), lambda x: pair(1, block, x, F.lit(True)))).otherwise(F.concat(
        F.transform(upto(F.col("mains")), lambda x: pair(1, x, block, F.lit(False))),
        F.transform(upto(F.col("others")), lambda x: pair(0, F.least(x, block), F.greatest(x, block), block <= x))))
    return placed.select("family", "node", "component", F.explode(met).alias("pair")).select(
        "family", "pair.*", "node", "component")


def near_components(docs: DataFrame, threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS, leaders: int = 1,
                    block_tokens: int = 1 << 17, block_rows: int = 1024) -> DataFrame:
    """(node, component) of the texts that share a band bucket with another text.

    A text is named by a 64-bit hash. In a bucket nobody meets everybody: every text is held against the `leaders`
    best leaders of its buckets, a bucket's leader being the member that shares most buckets. That joins most of a
    family of copies, one verified link a text. Buckets that then still hold several components are not decided;
    the texts of such buckets that hang together are a family, and its members are held against each other in
    blocks of bounded size, but for the members of its largest component among themselves. So each two texts that
    share a bucket are either in one component or have been compared, and only links that join components leave a task.
    """
    named = docs.select(F.xxhash64(text_of()).alias("node"), text_of().alias("text"))
    signed = named.mapInArrow(_sign(bands, rows), "node long, n long, keys array<long>")
    member = (signed.select("node", "n", F.explode("keys").alias("key"))
              .groupBy("key", "node").agg(F.max("n").alias("n")))
    member = keep_table(member, "members")
    sizes = member.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    member = keep_table(member.join(sizes, "key"), "members")
    # Who shares most buckets is likest to most: an original that many were copied from leads before its copies do.
    degree = member.groupBy("node").agg(F.sum("size").alias("degree"))
    member = keep_table(member.drop("size").join(degree, "node"), "members")
    texts = keep_table(named.join(degree.select("node"), "node", "left_semi").dropDuplicates(["node"]), "texts")

    close = F.least("n", "head.n") >= threshold * F.greatest("n", "head.n")
    head = member.groupBy("key").agg(F.max(F.struct("degree", "node", "n")).alias("head"))
    # A text has a head a band at most.
    best = (member.join(head, "key").where("node <> head.node").where(close).groupBy("node")
            .agg(F.sort_array(F.collect_set(F.struct("head.degree", "head.node")), asc=False).alias("heads")))
    pairs = best.select("node", F.explode(F.slice("heads", 1, leaders)).alias("head")).select(
        F.greatest("node", "head.node").alias("a"), F.least("node", "head.node").alias("b")).distinct()
    links = _verified(keep_table(pairs, "pairs"), texts, threshold)
    joined = components(links)
    state = keep_table(member.join(joined, "node", "left").select(
        "key", "node", "n", "degree", F.coalesce("component", "node").alias("component")), "state")

    open_rows = keep_table(_undecided(state), "undecided")
    centre = open_rows.groupBy("key").agg(F.max(F.struct("degree", "node")).alias("centre"))
    ties = open_rows.join(centre, "key").where("node <> centre.node").select(
        F.col("node").alias("a"), F.col("centre.node").alias("b")).distinct()
    family = components(ties).withColumnRenamed("component", "family")
    family = keep_table(open_rows.select("node", "n", "component").distinct().join(family, "node"), "families")
    tokens = texts.join(family.select("node"), "node", "left_semi").mapInArrow(
        _count_tokens, "node long, tokens array<long>")
    met = _block_pairs(family, block_tokens, block_rows).join(tokens, "node")
    more = keep_table(met.repartition(*_GROUP).sortWithinPartitions(*_GROUP).select(
        *_GROUP, "leftmost", "component", "tokens").mapInArrow(
        _compare_blocks(threshold, block_tokens), "a long, b long"), "links")
    into = components(more).withColumnRenamed("component", "into").withColumnRenamed("node", "component")
    return state.select("node", "component").distinct().join(into, "component", "left").select(
        "node", F.coalesce("into", "component").alias("component"))


def _placed(docs: DataFrame, how: dict) -> DataFrame:
    joined = near_components(docs, **how)
    named = docs.select("doc_id", F.xxhash64(text_of()).alias("node"))
    placed = keep_table(named.join(joined, "node", "left").select(
        "doc_id", "node", F.coalesce("component", "node").alias("component")), "placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")).alias("first")
    sizes = placed.groupBy("component").agg(first, F.count("*").alias("class_size"))
    return placed.join(sizes, "component").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "class_size",
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("node") == F.col("first.node")))
        .alias("is_representative"), "node")


def classes(docs: DataFrame, **how) -> DataFrame:
    """A row per document: doc_id, class_id (the smallest doc_id of its class), class_size, is_representative."""
    return _placed(docs, how).drop("node")


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The documents with one of each class left, that with the smallest doc_id; columns stay as they are.

    Ids go before nulls, and of texts with an equal id the one with the smallest hash stays. Rows that repeat an id
    and a text count once.
    """
    placed = keep_table(_placed(docs, how), "placed")
    repeated = not placed.where("is_representative").groupBy("doc_id", "node").count().where("count > 1").isEmpty()
    gone = placed.where(~F.col("is_representative")).select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"))
    kept = docs.join(gone.distinct(), docs["doc_id"].eqNullSafe(gone["_id"])
                     & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["_node"]), "left_anti")
    if not repeated:
        return kept
    node = free_name(kept, "node")
    return kept.withColumn(node, F.xxhash64(text_of())).dropDuplicates(["doc_id", node]).drop(node)
