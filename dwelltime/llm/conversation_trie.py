"""Conversation prefix trie: nodes by position-salted hashes of turns, subtree totals by time-forward processing.

Conversations are rebuilt: c has the first h turns of conversation c - c % 20, then its own turns after its first h, h
being the CRC-32 of its decimal id modulo 4. A node is a distinct sequence of first d rebuilt turns. It is named by d
and two 64-bit exclusive sums of turn hashes salted with their place, so a prefix needs no list of its turns and a
long conversation is summed in pieces.

Totals pass from nodes to parents, level by level from the deepest. A node with one member needs none: it has one leaf
below it and saves nothing. Nodes with more than a limit of members form the top of the trie; what hangs below them
are the shards, each of at most so many conversations, whole in one task. There the nodes come sorted by reverse level,
and a spilling priority queue holds the totals sent to parents. The totals of shard roots are then added up by parent,
and the same processing runs over the top, which the limit keeps below a fixed number of nodes.

Defined results: null roles and texts are empty; turns come by number, null first, equal numbers by role and text;
rows without a conv_id belong to no conversation and are left out; repeated rows are turns of their own; no rows give
no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwelltime.llm.tables import keep_table

FAMILY, HEADS = 20, 3
#: A shard has at most this many conversations, or a fixed part of all turns where that is more.
SHARD_MEMBERS, TOP_NODES = 4096, 50_000
QUEUE_ROWS = 1 << 16

_NODE = ["depth", "k1", "k2"]
_PARENT = ["p1", "p2"]


def _head_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % (HEADS + 1)).cast("long")


def _family(conv_id: Column) -> Column:
    return conv_id - conv_id % FAMILY


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, part, place, x1, x2, words of every turn, numbered from 0 in its conversation.

    Sorted by ranges, so that a conversation of any length is dealt over tasks; a task's rows have consecutive
    numbers, and places follow from the first number and the sizes of a conversation's earlier parts.
    """
    text = F.coalesce("text", F.lit(""))
    given = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    # Rows that are equal in all but the seeded number can change places: it deals them over several ranges.
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "deal"]
    ranged = given.withColumn("deal", F.rand(11)).repartitionByRange(*order).sortWithinPartitions(*order)
    turns = keep_table(ranged.select(
        "conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("number"),
        F.xxhash64("role", "text").alias("x1"), F.xxhash64(F.lit("second"), "text", "role").alias("x2"),
        F.coalesce(F.size(F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))), F.lit(0))
        .cast("long").alias("words")), "turns")
    parts = turns.groupBy("conv_id", "part").agg(F.min("number").alias("first"), F.count("*").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    return keep_table(turns.join(parts, ["conv_id", "part"]).select(
        "conv_id", "part", (F.col("before") + F.col("number") - F.col("first")).alias("place"), "x1", "x2", "words"), "turns")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): conv_id of each, and conv_id, part, depth from 1, s1, s2, words of the rebuilt turns."""
    heads = (turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS)).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("place", "x1", "x2", "words"))).alias("heads"))
             .withColumnRenamed("conv_id", "family"))
    parts = turns.groupBy("conv_id", "part").agg(F.max("place").alias("place"))
    convs = parts.select("conv_id").distinct().select(
        "conv_id", _family(F.col("conv_id")).alias("family"), _head_turns(F.col("conv_id")).alias("h"))
    convs = convs.join(heads, "family", "left").select(
        "conv_id", "h", F.slice(F.coalesce("heads", F.array().cast(
            "array<struct<place:bigint,x1:bigint,x2:bigint,words:bigint>>")), 1, F.col("h").cast("int")).alias("heads"))
    convs = keep_table(convs, "conversations")
    shared = convs.select("conv_id", F.lit(-1).alias("part"), F.explode("heads").alias("turn")).select(
        "conv_id", "part", (F.col("turn.place") + 1).alias("depth"), "turn.x1", "turn.x2", "turn.words")
    # The shift is joined to a conversation's parts first, so that a long one meets it part by part.
    shifts = parts.join(convs.select("conv_id", "h", F.size("heads").cast("long").alias("m")), "conv_id")
    own = turns.join(shifts.drop("place"), ["conv_id", "part"]).where("place >= h").select(
        "conv_id", "part", (F.col("place") - F.col("h") + F.col("m") + 1).alias("depth"), "x1", "x2", "words")
    salted = [F.xxhash64(x, "depth").alias(s) for x, s in (("x1", "s1"), ("x2", "s2"))]
    rebuilt = shared.unionByName(own).select("conv_id", "part", "depth", *salted, "words")
    return convs.select("conv_id"), keep_table(rebuilt, "rebuilt")


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """conv_id, depth, words, the name of each prefix (k1, k2) and of the one before it (p1, p2).

    Running sums over a part, plus the sums of a conversation's earlier parts.
    """
    up_to = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = rebuilt.select("*", F.bit_xor("s1").over(up_to).alias("r1"), F.bit_xor("s2").over(up_to).alias("r2"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rebuilt.groupBy("conv_id", "part").agg(F.bit_xor("s1").alias("t1"), F.bit_xor("s2").alias("t2")).select(
        "conv_id", "part", *[F.coalesce(F.bit_xor(t).over(earlier), F.lit(0)).alias(c)
                             for t, c in (("t1", "c1"), ("t2", "c2"))])
    named = running.join(sums, ["conv_id", "part"]).select(
        "conv_id", "depth", "words", "s1", "s2",
        F.col("r1").bitwiseXOR(F.col("c1")).alias("k1"), F.col("r2").bitwiseXOR(F.col("c2")).alias("k2"))
    return named.select("conv_id", "depth", "words", "k1", "k2", F.col("k1").bitwiseXOR(F.col("s1")).alias("p1"),
                        F.col("k2").bitwiseXOR(F.col("s2")).alias("p2"))


class SpillingQueue:
    """A priority queue of (key, values): a heap that is sorted and packed away as a run when it is full.

    Runs are arrays of integers, a tenth of the heap's size a row; their heads are merged with the heap.
    """

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.heap, self.runs, self.heads = limit, [], [], []

    def push(self, row: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, row)
        if len(self.heap) > self.limit:
            self.runs.append([np.array(sorted(self.heap), np.int64), 0])
            self.heap = []
            heapq.heappush(self.heads, (*self.runs[-1][0][0].tolist(), len(self.runs) - 1))

    def peek(self) -> tuple[int, ...] | None:
        if self.heads and (not self.heap or self.heads[0][:-1] < self.heap[0]):
            return self.heads[0][:-1]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple[int, ...]:
        if not self.heads or (self.heap and self.heap[0] <= self.heads[0][:-1]):
            return heapq.heappop(self.heap)
        *row, number = heapq.heappop(self.heads)
        run = self.runs[number]
        run[1] += 1
        if run[1] < len(run[0]):
            heapq.heappush(self.heads, (*run[0][run[1]].tolist(), number))
        else:
            run[0] = None
        return tuple(row)


def time_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtree totals of nodes sorted by shard, then deepest first, then name.

    A node takes what its children sent it, which came before it, and sends the sum on to its parent. What is sent to
    a parent in another shard is left behind: the caller has it as the total of a shard root.
    """
    queue, shard = SpillingQueue(), None
    names = ["shard1", "shard2", *_NODE, *_PARENT, "leaves", "saved"]
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in names]
        leaves_out, saved_out = [], []
        for s1, s2, depth, k1, k2, p1, p2, leaves, saved in zip(*columns, strict=True):
            if (s1, s2) != shard:
                shard, queue = (s1, s2), SpillingQueue()
            own = (-depth, k1, k2)
            while (head := queue.peek()) is not None and head[:3] <= own:
                sent = queue.pop()
                if sent[:3] == own:
                    leaves += sent[3]
                    saved += sent[4]
            leaves_out.append(leaves)
            saved_out.append(saved)
            if depth:
                queue.push((1 - depth, p1, p2, leaves, saved))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(name) for name in (*_NODE, *_PARENT)], pa.array(leaves_out, pa.int64()),
             pa.array(saved_out, pa.int64())], [*_NODE, *_PARENT, "leaves", "saved"])


_TOTALS = "depth long, k1 long, k2 long, p1 long, p2 long, leaves long, saved long"


def _totals(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("shard1", "shard2").sortWithinPartitions("shard1", "shard2", F.desc("depth"), "k1", "k2").select(
        "shard1", "shard2", *_NODE, *_PARENT, "leaves", "saved").mapInArrow(time_forward, _TOTALS)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash a node over its conversations' ids, which come sorted by node and id and are not gathered."""
    def told(node, digest):
        return pa.RecordBatch.from_arrays(
            [*[pa.array([value], pa.int64()) for value in node], pa.array([digest.hexdigest()])], [*_NODE, "ends_sha256"])

    node, digest = None, None
    for batch in batches:
        keys = np.stack([batch.column(name).to_numpy() for name in _NODE], 1)
        ids = batch.column("conv_id").to_pylist()
        cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        finished = []
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
            if high == low:
                continue
            here, spelled = tuple(keys[low].tolist()), ",".join(map(str, ids[low:high]))
            if here == node:
                digest.update(("," + spelled).encode())
            else:
                if node is not None:
                    finished.append(told(node, digest))
                node, digest = here, hashlib.sha256(spelled.encode())
        if finished:
            yield pa.Table.from_batches(finished).combine_chunks().to_batches()[0]
    if node is not None:
        yield told(node, digest)


def _ends(convs: DataFrame, found: DataFrame) -> DataFrame:
    """The hash of the conversations that end at each node; those without a turn end at the root."""
    last = found.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2")).alias("last"))
    ending = convs.join(last, "conv_id", "left").select("conv_id", *[
        F.coalesce(F.col(f"last.{name}"), F.lit(0)).alias(name) for name in _NODE])
    return ending.repartition(*_NODE).sortWithinPartitions(*_NODE, "conv_id").mapInArrow(
        _hash_ends, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame, shard_members: int = SHARD_MEMBERS) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, rebuilt = rebuilt_turns(numbered_turns(conversations))
    found = keep_table(prefixes(rebuilt), "prefixes")
    inner = found.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                                      *[F.first(name).alias(name) for name in (*_PARENT, "words")])
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        *[zero.alias(name) for name in _NODE], "conv_id", "n_convs", *[zero.alias(n) for n in (*_PARENT, "words")])
    nodes = keep_table(inner.unionByName(root), "nodes")

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"),
                                                F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single"))
    nodes = keep_table(nodes.join(children, _NODE, "left").fillna(0, ["n_children", "single"]), "nodes")
    shared = nodes.where("n_convs > 1").select(
        *_NODE, *_PARENT, "conv_id", "n_convs",
        (F.col("single") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))

    # More members than the limit: at most a node for each so many turns, hence fewer than TOP_NODES and one a level.
    limit = max(shard_members, found.count() // TOP_NODES)
    top = keep_table(shared.where(F.col("n_convs") > limit), "top")
    names = F.broadcast(top.select(*_NODE))
    above = names.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    below = found.join(above, ["depth", *_PARENT], "left_semi").join(names, _NODE, "left_anti")
    shard = below.select("conv_id", F.col("k1").alias("shard1"), F.col("k2").alias("shard2"))
    light = shared.where(F.col("n_convs") <= limit).join(shard, "conv_id", "left").fillna(0, ["shard1", "shard2"])
    low = keep_table(_totals(light), "totals")
    sent = low.join(above, ["depth", *_PARENT], "left_semi").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    upper = top.join(sent, _NODE, "left").select(
        *_NODE, *_PARENT, F.lit(0).alias("shard1"), F.lit(0).alias("shard2"),
        (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"))
    totals = low.unionByName(_totals(upper)).select(*_NODE, "leaves", "saved")

    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return (nodes.join(totals, _NODE, "left").join(_ends(convs, found), _NODE, "left")
            .join(parents, ["depth", *_PARENT], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", empty).alias("ends_sha256")))
