"""Target-distribution importance resampling over hashed features, CRCs taken in matrices of equal length.

The features of a text are its runs of consecutive words, hashed by CRC-32 into buckets. A bucket's gain is the log
ratio of its smoothed shares in the target texts and in all documents; a document weighs the mean of its gains. The
draw adds Gumbel noise made from the id and keeps the highest scores, so it is a sample without replacement in
proportion to the weights and comes out the same in every run.

The distinct features of a batch are grouped by length into two-dimensional byte matrices; a matrix takes one column
at a time, updating the CRCs of all its rows, and the values are scattered back to where the features stand.

Defined results: words are runs of ASCII letters, digits and all non-ASCII characters, A-Z lowered; a null or wordless
text has no feature and weight 0; a null id counts as empty in the noise; equal scores go by the smaller id, ids
before null, then by fewer features and by lower weight; rows that repeat an id and a text count each. No documents
give no rows; without target texts all gains follow from smoothing. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwelltime.llm.arrays import pieces, utf8
from dwelltime.llm.tables import keep_table

BUCKETS, SEED, SHARE, LEAST_WORDS = 10_000, 2024, 10, 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[ord("0"):ord("9") + 1] = _INSIDE[ord("a"):ord("z") + 1] = _INSIDE[0x80:] = True

_POLYNOMIAL = np.uint32(0xEDB88320)


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ _POLYNOMIAL, value >> 1).astype(np.uint32)
    return value


_TABLE = _crc_table()


def crc_columns(matrix: np.ndarray) -> np.ndarray:
    """The CRC-32 of every row of a byte matrix, a column at a time."""
    value = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        value = _TABLE[(value ^ column) & np.uint32(0xFF)] ^ (value >> np.uint32(8))
    return ~value


def crc_by_length(features: pa.LargeBinaryArray) -> np.ndarray:
    """The CRC-32 of every feature: those of one length are one matrix, a view of the sorted bytes."""
    offsets = np.frombuffer(features.buffers()[1], np.int64)[features.offset:features.offset + len(features) + 1]
    order = np.argsort(np.diff(offsets), kind="stable")
    grouped = features.take(pa.array(order))
    _, at, data = grouped.buffers()
    at = np.frombuffer(at, np.int64)[:len(grouped) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lengths, out = np.diff(at), np.empty(len(grouped), np.uint32)
    edges = np.flatnonzero(np.diff(lengths, prepend=-1, append=-1))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        out[order[low:high]] = crc_columns(data[at[low]:at[high]].reshape(high - low, int(lengths[low])))
    return out


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    taken = data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(taken)])


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, word starts, word ends, and the text of each word."""
    offsets, data = utf8(column)
    data = _LOWER[data]
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return data, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _runs(data, starts, ends, text, low: int, high: int):
    """(feature, text) of all runs of low to high words of a text, the words joined by one space."""
    lengths = ends - starts
    begin = np.concatenate([[0], np.cumsum(lengths + 1)]).astype(np.int64)
    stream = np.full(begin[-1], ord(" "), np.uint8)
    stream[np.repeat(begin[:-1] - np.concatenate([[0], np.cumsum(lengths)])[:-1], lengths)
           + np.arange(lengths.sum())] = data[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
                                              + np.arange(lengths.sum())]
    for size in range(low, high + 1):
        first = np.arange(max(0, len(starts) - size + 1))
        first = first[text[first] == text[first + size - 1]]
        yield _gathered(stream, begin[first], begin[first + size] - 1), text[first]


def _hashed(buckets: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            n = batch.num_rows
            data, starts, ends, text = _words(batch.column("text"))
            bucket, owner = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
            found = [(_gathered(data, starts, ends), text)] if (low, high) == (1, 1) else _runs(
                data, starts, ends, text, low, high)
            for features, where in found:
                coded = features.dictionary_encode()
                value = (crc_by_length(coded.dictionary) % np.uint32(buckets)).astype(np.int32)
                bucket.append(value[coded.indices.to_numpy()])
                owner.append(where)
            bucket, owner = np.concatenate(bucket), np.concatenate(owner)
            bucket = bucket[np.argsort(owner, kind="stable")]
            ends_at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.bincount(text, minlength=n).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends_at), pa.array(bucket))], ["doc_id", "n_words", "buckets"])
    return run


def hashed_features(texts: DataFrame, buckets: int = BUCKETS, low: int = 1, high: int = 1) -> DataFrame:
    """doc_id, n_words and the bucket of every feature, repeats included, of (doc_id, text)."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "text").mapInArrow(
        _hashed(buckets, low, high), f"doc_id {kind}, n_words long, buckets array<int>")


def bucket_counts(hashed: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all rows fall in each bucket; Spark counts, the driver gets one number a bucket."""
    counted = hashed.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count().collect()
    out = np.zeros(buckets, np.float64)
    for row in counted:
        out[row["bucket"]] = row["count"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of the smoothed shares, floored."""
    buckets = len(source)
    return np.floor(1000 * np.log((target + 1) * (source.sum() + buckets) / (
        (source + 1) * (target.sum() + buckets)))).astype(np.int64)


def _weighed(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("buckets")
            ends = held.offsets.to_numpy()
            total = np.concatenate([[0], np.cumsum(gain[held.values.to_numpy()[:ends[-1]]])])
            number = np.diff(ends).astype(np.int64)
            weight = (total[ends[1:]] - total[ends[:-1]]) // np.maximum(number, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(number), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"])
    return run


def scored(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, low: int = 1, high: int = 1,
           seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document; target is a table of texts."""
    source = keep_table(hashed_features(docs, buckets, low, high), "buckets")
    wanted = hashed_features(target.select(F.lit(0).alias("doc_id"), "text"), buckets, low, high)
    gain = gains(bucket_counts(source, buckets), bucket_counts(wanted, buckets))
    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = source.mapInArrow(_weighed(gain), f"doc_id {kind}, n_words long, n_features long, weight long")
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    part = (F.conv(F.substring(mark, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(part))).cast("long"))


def _starts(rows: DataFrame) -> DataFrame:
    """Per score, how many rows have a higher one.

    Scores are thousandths of logarithms of counts: at most some ten thousand different ones at any size. They are
    summed by blocks of 256 scores, then within a block.
    """
    by_score = rows.groupBy("score").agg(F.sum("copies").alias("copies")).withColumn(
        "block", F.floor(F.col("score") / 256))
    higher = lambda of: of.rowsBetween(Window.unboundedPreceding, -1)
    summed = lambda window: F.coalesce(F.sum("copies").over(higher(window)), F.lit(0))
    blocks = by_score.groupBy("block").agg(F.sum("copies").alias("copies")).select(
        "block", summed(Window.orderBy(F.desc("block"))).alias("before"))
    within = by_score.withColumn("inside", summed(Window.partitionBy("block").orderBy(F.desc("score"))))
    return within.join(blocks, "block").select("score", (F.col("before") + F.col("inside")).alias("start"))


def _spread(rows: DataFrame, times, step: int = 4096) -> DataFrame:
    """Every row `times` times, numbered from 0; in steps, so that no list grows with the number."""
    steps = rows.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((times - 1) / step))))
    last = F.least((F.col("_step") + 1) * step, times) - 1
    return steps.withColumn("number", F.explode(F.sequence(F.col("_step") * step, last))).drop("_step")


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS,
             **how) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document.

    Of the N documents with at least `least_words` words the floor(share * N / 100) highest scores are drawn and
    ranked from 1; all others have no rank.
    """
    rows = scored(docs, target, **how)
    able = F.col("n_words") >= least_words
    columns = ["doc_id", "n_features", "weight", "score"]
    rows = keep_table(rows.groupBy(*columns, able.alias("able")).agg(F.count("*").alias("copies")), "scored")
    ranked = rows.where("able")
    total = ranked.agg(F.sum("copies")).first()[0] or 0
    draws = share * total // 100
    starts = F.broadcast(keep_table(_starts(ranked), "starts"))
    placed = rows.join(starts.withColumn("able", F.lit(True)), ["score", "able"], "left")
    near = placed.where(F.col("start") < draws)
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight")
    first = F.coalesce(F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = near.withColumn("first", F.col("start") + first)
    drawn = _spread(near.where(F.col("first") < draws), F.least("copies", draws - F.col("first")))
    left = near.withColumn("rest", F.col("copies") - F.greatest(
        F.lit(0), F.least(F.col("copies"), draws - F.col("first")))).where("rest > 0")
    rest = placed.where(F.coalesce(F.col("start") >= draws, F.lit(True))).withColumn("rest", F.col("copies"))
    undrawn = _spread(rest.select(*columns, "rest").unionByName(left.select(*columns, "rest")), F.col("rest"))
    return drawn.select(*columns, (F.col("first") + F.col("number") + 1).alias("rank")).unionByName(
        undrawn.select(*columns, F.lit(None).cast("long").alias("rank")))
