"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

A window has as many words as the benchmark item it is held against. It is made at every start where it holds as many
places of shingles of the item, in any order, as the threshold asks for; others cannot reach it. Window and item each get
a 64-bit SimHash of their shingles. The bits are cut into eight blocks: two fingerprints within 23 bits differ by at
most two bits in one block at least, so looking up every block among the item's block values within two bits finds
all fingerprints within the radius. What is found is verified by the weighted similarity of the shingle multisets.

Only DataFrame functions are used. Words are lower-cased and split at space and \\x09-\\x0D.

Defined results: null texts and items are empty and match nothing; an item of fewer than five words is one shingle;
a document shorter than the item is one window; per document and item the most similar window is given, the first of equals; rows that repeat an id and a text give one result; documents may lack an id. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwelltime.llm.tables import keep_table, text_of

SHINGLE = 5
BLOCKS, BLOCK_BITS, SLACK = 8, 8, 2
RADIUS = BLOCKS * (SLACK + 1) - 1
#: Tables of up to this many narrow rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


def bounded(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a written table if it has been counted to be small, else leave the join to the planner."""
    return F.broadcast(frame) if frame.count() <= rows else frame


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+", -1), "")


def _hashes(words: Column, size: int) -> Column:
    """A hash of every run of size words, by position; runs that reach past the end are cut off."""
    each = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)]))
    return F.slice(each, 1, F.greatest(F.size(words) - (size - 1), F.lit(0)))


def _shingle_texts(words: Column, size: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - size + 1, F.lit(1))),
                       lambda i: F.array_join(F.slice(words, i, size), " "))


def _simhash(shingles: Column) -> Column:
    """64 bits; a bit is set if it is set in more than half of the shingles' hashes."""
    hashes = F.transform(shingles, lambda s: F.xxhash64(s))

    def bit(done: Column, k: Column) -> Column:
        ones = F.size(F.filter(hashes, lambda h: F.getbit(h, k) == 1))
        set_bit = done.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), k))
        return F.when(2 * ones > F.size(shingles), set_bit).otherwise(done)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), bit)


def _block(bits: Column, k: Column) -> Column:
    return F.call_function("shiftrightunsigned", bits, k * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def _similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two multisets given as arrays."""
    shared = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda done, x: done + F.least(
        F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))
    return shared / (F.size(a) + F.size(b) - shared)


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id, words, size, width and the shingle texts and fingerprint of every item with a word."""
    items = benchmark.select("item_id", words_of(text_of()).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("size", F.size("words")).withColumn("width", F.least(F.size("words"), F.lit(SHINGLE)))
    items = items.withColumn("shingles", _shingle_texts(F.col("words"), F.col("width")))
    return items.withColumn("bits", _simhash(F.col("shingles")))


def row_key() -> Column:
    return F.xxhash64("doc_id", text_of())


def _starts(width: int, threshold: float) -> Column:
    """The starts, from places in order, of all windows that hold enough places: some `need` of them lie inside."""
    length = F.least("n", "size")  # a shorter document is one window
    reach = length - width
    need = F.ceil(threshold / (1 + threshold) * (reach + F.col("size") - width + 2) - F.lit(1e-9)).cast("int")

    def from_place(place: Column, i: Column) -> Column:
        last = F.coalesce(F.get("places", i + F.greatest(need, F.lit(1)) - 1), F.lit(2**31 - 1))
        low = F.greatest(F.lit(0), last - reach)
        high = F.least(place, F.col("n") - length)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.array_distinct(F.flatten(F.transform("places", from_place)))


def windows(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(key, item_id, at): the item-sized windows of a document that may be as similar as the threshold."""
    found = None
    for (width,) in items.select("width").distinct().orderBy("width").collect():  # at most five values
        own = items.where(F.col("width") == width)
        anchors = keep_table(own.select("item_id", "size", F.explode(F.array_distinct(_hashes(F.col("words"), width)))
                                        .alias("hash")), "anchors")
        split = docs.select(row_key().alias("key"), words_of(text_of()).alias("words"))
        runs = split.select("key", F.size("words").alias("n"), F.posexplode(_hashes(F.col("words"), width))
                            .alias("place", "hash"))
        met = (runs.join(bounded(anchors), "hash").groupBy("key", "item_id", "n", "size")
               .agg(F.sort_array(F.collect_set("place")).alias("places"))
               .select("key", "item_id", F.explode(_starts(width, threshold)).alias("at")))
        found = met if found is None else found.unionByName(met)
    return None if found is None else found.distinct()


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity, key) of documents that hold an item."""
    items = keep_table(items_of(benchmark), "items")
    found = windows(docs, items, threshold)
    if found is None:
        found = docs.select(row_key().alias("key"), F.lit(0).alias("at")).join(items.select("item_id"), F.lit(False))
    found = keep_table(found, "windows")
    some = docs.select("doc_id", row_key().alias("key"), text_of().alias("text"))
    sized = found.join(bounded(items.select("item_id", "size", "width")), "item_id")
    cut = some.join(bounded(keep_table(sized, "windows")), "key")
    cut = cut.select("doc_id", "key", "item_id", "at", "width",
                     F.slice(words_of(F.col("text")), F.col("at") + 1, F.col("size")).alias("part"))
    cut = keep_table(cut.dropDuplicates(["key", "item_id", "at"]), "cuts")
    cut = cut.withColumn("own", _shingle_texts(F.col("part"), F.col("width"))).withColumn("seen", _simhash(F.col("own")))
    cut = keep_table(cut.select("doc_id", "key", "item_id", "at", F.size("part").alias("n_words"), "own", "seen"), "cuts")
    # The index of the items: every block value within two bits of theirs.
    masks = [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= SLACK]
    index = (items.select("item_id", "bits", "shingles", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
             .select("item_id", "bits", "block", _block(F.col("bits"), F.col("block")).alias("value"))
             .select("item_id", "bits", "block", F.explode(F.transform(
                 F.array(*map(F.lit, masks)), lambda m: F.col("value").bitwiseXOR(m))).alias("value")))
    asked = cut.select("key", "item_id", "at", "seen", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    asked = asked.withColumn("value", _block(F.col("seen"), F.col("block")))
    near = (asked.join(bounded(keep_table(index, "index")), ["item_id", "block", "value"])
            .withColumn("hamming", F.bit_count(F.col("seen").bitwiseXOR(F.col("bits"))))
            .where(F.col("hamming") <= RADIUS).groupBy("key", "item_id", "at").agg(F.min("hamming").alias("hamming")))
    checked = (cut.join(near, ["key", "item_id", "at"])
               .join(bounded(items.select("item_id", "shingles")), "item_id")
               .withColumn("similarity", _similarity(F.col("own"), F.col("shingles")))
               .where(F.col("similarity") >= threshold))
    best = checked.groupBy("key", "doc_id", "item_id").agg(F.max(F.struct(
        "similarity", (-F.col("at")).alias("back"), "n_words", "hamming")).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.back")).alias("start_word"), "best.n_words", "best.hamming",
                       "best.similarity", "key")


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The documents that hold no benchmark item; columns stay as they are."""
    held = keep_table(matches(docs, benchmark, threshold).select(F.col("key").alias("_held")).distinct(), "held")
    return docs.join(bounded(held), F.xxhash64(docs["doc_id"], F.coalesce(docs["text"], F.lit(""))) == held["_held"],
                     "left_anti")
