"""Personal data: base patterns, and bootstrapped contextual extraction of identifiers they miss.

Base spans come from four patterns. They are the seeds: a lexical pattern is the word before or after a token that
holds digits or an at sign, together with the token's coarse form. Patterns and the tokens they surround make a graph
that is scored in rounds: a pattern is as good as the share of its distinct tokens that are known for a kind, a token
as likely as the patterns around it make it, and tokens of good patterns are known in the next round. Occurrences of
what was found this way, where no base span lies, are added.

Only DataFrame functions are used. Positions are code points, ends exclusive.

Defined results: a null text is empty and has no spans; rows that repeat an id and a text have the same spans;
contexts reach 64 characters to either side. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dwelltime.llm.tables import free_name, keep_table, text_of

KINDS = ("email", "ip", "card", "phone")
# Each finds what the plain pattern of its kind finds; possessive runs and the look behind only keep the time linear.
# A match may also start where the last one ended, inside a run.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+(?:\x20[(+]?[0-9][^\x20\x09-\x0D]*+)*+"
CONTEXT = 64


def _luhn(digits: Column) -> Column:
    """Of 13 to 19 digits: every second from the right counts double, less 9 if above it; the sum ends in 0."""
    turned = F.reverse(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.lit(19)), F.lit(0), lambda done, i: done + F.coalesce(
        _doubled(F.try_element_at(F.split(turned, ""), i).cast("int"), i), F.lit(0)))
    return (F.length(digits).between(13, 19)) & (total % 10 == 0)


def _doubled(digit: Column, i: Column) -> Column:
    twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
    return F.when(i % 2 == 0, twice).otherwise(digit)


def _holds(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]+", "")
    if kind == "ip":
        return hit.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _may_hold(kind: str, text: Column) -> Column:
    """A cheap test that all texts with a valid match pass."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9](?:[\x20-]?[0-9]){12}")


def stored(frame: DataFrame, **columns: Column) -> DataFrame:
    """The frame with more columns, computed once a row; as mere projections Spark would merge them into what reads
    them, and a lambda that looks into an array would make the whole array anew for each of its elements."""
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return frame.select("*", F.inline(F.array(row)))


#: Running sums are taken in blocks of so many, then over the blocks: a growing array is copied at every step.
BLOCK = 256


def _running(values: Column) -> Column:
    """Running sums of a short array."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("sums"))
    step = lambda done, value: F.struct((done["at"] + value).alias("at"), F.concat(
        done["sums"], F.array(done["at"] + value)).alias("sums"))
    return F.aggregate(values, start, step, lambda done: done["sums"])


def with_matches(texts: DataFrame, forms: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds, for each name, all matches of a pattern in order as structs (start, end, hit, before, after).

    A form goes with a test that every text with a match passes. The time is linear in the matches of a text.
    """
    of = lambda name, part: F.col(f"_{name}_{part}")
    strings = F.array().cast("array<string>")
    out = stored(texts, **{f"_{name}_{part}": F.when(test, column).otherwise(strings)
                           for name, (form, test) in forms.items() for part, column in (
                               ("hits", F.regexp_extract_all("text", F.lit(form), F.lit(0))),
                               ("rest", F.split("text", form, -1)))})

    def blocks(name: str) -> Column:
        hits, rest = of(name, "hits"), of(name, "rest")
        sums = F.transform(F.sequence(F.lit(0), F.size(hits) - 1, F.lit(BLOCK)), lambda first: _running(F.transform(
            F.slice(hits, first + 1, BLOCK), lambda hit, i: F.length(hit) + F.length(F.get(rest, first + i)))))
        return F.when(F.size(hits) > 0, sums).otherwise(F.array().cast("array<array<int>>"))

    out = stored(out, **{f"_{name}_sums": blocks(name) for name in forms})
    out = stored(out, **{f"_{name}_before": F.concat(F.array(F.lit(0)), _running(F.transform(
        of(name, "sums"), lambda block: F.element_at(block, -1)))) for name in forms})

    def found(name: str) -> Column:
        def one(hit: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            end = F.get(of(name, "before"), block) + F.get(F.get(of(name, "sums"), block), i % BLOCK)
            return F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit"),
                            F.get(of(name, "rest"), i).alias("before"), F.get(of(name, "rest"), i + 1).alias("after"))
        return F.transform(of(name, "hits"), one)

    out = stored(out, **{name: found(name) for name in forms})
    return out.select(*texts.columns, *forms)


def _spans(kind: str) -> Column:
    """The valid spans of a base kind, from the matches in the column named like it."""
    return F.transform(F.filter(kind, lambda m: _holds(kind, m["hit"])), lambda m: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def _no_spans() -> Column:
    return F.array().cast("array<struct<kind:int,start:int,end:int>>")


def _tokens(matches: str) -> Column:
    """Occurrences that may be identifiers: the core of a token, its place and the words around it."""
    def core(m: Column) -> Column:
        lead = F.regexp_extract(m["hit"], r"^[^A-Za-z0-9+@(]*", 0)
        body = F.regexp_extract(F.substr(m["hit"], F.length(lead) + 1), r"(?s)^.*[A-Za-z0-9]", 0)
        start = m["start"] + F.length(lead)
        word = lambda part, form: F.lower(F.regexp_replace(F.regexp_extract(part, form, 1), "[0-9]+", "0"))
        return F.struct(start.alias("start"), (start + F.length(body)).alias("end"), body.alias("core"),
                        word(F.right(m["before"], F.lit(CONTEXT)), r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$").alias("left"),
                        word(F.left(m["after"], F.lit(CONTEXT)), r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)").alias("right"))

    return F.filter(F.transform(matches, core), lambda t: F.length(t["core"]) > 0)


def row_key() -> Column:
    return F.xxhash64("doc_id", text_of())


def base_table(docs: DataFrame) -> DataFrame:
    """doc_id, key, the base spans in order and the tokens of every row; the one pass over the texts."""
    texts = docs.select("doc_id", row_key().alias("key"), text_of().alias("text"))
    forms = {kind: (FORMS[kind], _may_hold(kind, F.col("text"))) for kind in KINDS}
    placed = with_matches(texts, forms | {"token": (TOKEN, F.col("text").rlike("[0-9@]"))})
    spans = F.concat(*map(_spans, KINDS))
    return keep_table(placed.select("doc_id", "key", spans.alias("base"), _tokens("token").alias("tokens")), "base")


def _free_tokens(base: DataFrame) -> DataFrame:
    """key, the token's columns, the kind of the base span that it equals, and whether no base span touches it.

    A text's spans and tokens are put in one order, in which running ends and next starts tell what overlaps; no
    token is held against all spans of its text.
    """
    rows = base.dropDuplicates(["key"])
    tokens = rows.select("key", F.size("base").alias("spans"), F.explode("tokens").alias("token")).select("key", "spans", "token.*")
    bare = tokens.where("spans = 0").drop("spans").withColumns({"seed": F.lit(None).cast("int"), "free": F.lit(True)})
    strings = {name: F.lit(None).cast("string") for name in ("core", "left", "right")}
    spans = rows.select("key", F.explode("base").alias("span")).select("key", "span.start", "span.end", "span.kind")
    both = spans.withColumns(strings).withColumn("is_token", F.lit(False)).unionByName(
        tokens.where("spans > 0").drop("spans").withColumns({"kind": F.lit(None).cast("int"), "is_token": F.lit(True)}))
    order = ["start", "is_token", "end", "kind"]
    line = Window.partitionBy("key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("key").orderBy(*map(F.desc, order)).rowsBetween(Window.unboundedPreceding, -1)
    marked = both.withColumns({
        "reach": F.max(F.when(~F.col("is_token"), F.col("end"))).over(line),
        "ahead": F.min(F.when(~F.col("is_token"), F.col("start"))).over(back),
        "seed": F.min("kind").over(Window.partitionBy("key", "start", "end"))})
    touched = (F.coalesce(F.col("reach") > F.col("start"), F.lit(False))
               | F.coalesce(F.col("ahead") < F.col("end"), F.lit(False)))
    return bare.unionByName(marked.where("is_token").withColumn("free", ~touched).select(*bare.columns))


def discovered(base: DataFrame, rounds: int = 3, min_known: int = 3, min_share: float = 0.8,
               min_score: float = 0.8) -> DataFrame:
    """(key, kind, start, end) of identifiers that only their contexts give away.

    A pattern counts from min_known distinct known tokens and a share of min_share on; a token is known from a
    score of min_score on. Every round is two groupings of the pattern-token graph, written to the shared folder.
    """
    place = keep_table(_free_tokens(base), "tokens")
    digits = F.length(F.regexp_replace("core", "[^0-9]+", ""))
    form = F.when(F.contains("core", F.lit("@")), "at").otherwise(
        F.concat(F.lit("d"), F.when(digits <= 4, 1).when(digits <= 8, 2).when(digits <= 12, 3).otherwise(4)))
    edges = place.select("core", F.explode(F.array(
        F.when(F.col("left") != "", F.concat(F.lit("<"), "left", F.lit(" "), form)),
        F.when(F.col("right") != "", F.concat(F.lit(">"), "right", F.lit(" "), form)))).alias("pattern"))
    edges = keep_table(edges.where("pattern is not null").distinct(), "edges")
    sizes = keep_table(edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") > min_known), "sizes")
    edges = keep_table(edges.join(sizes, "pattern"), "edges")
    seeds = place.where("seed is not null").groupBy("core", F.col("seed").alias("kind")).agg(F.lit(1.0).alias("score"))
    known = keep_table(seeds, "known")
    for _ in range(rounds):
        good = (edges.join(known, "core").groupBy("pattern", "n", "kind")
                .agg(F.sum("score").alias("weight"), F.count("*").alias("support"))
                .where((F.col("support") >= min_known) & (F.col("weight") >= min_share * F.col("n")))
                .select("pattern", "kind", (F.col("weight") / (F.col("n") + 1)).alias("trust")))
        likely = (edges.join(good, "pattern").groupBy("core", "kind")
                  .agg((1 - F.exp(F.sum(F.log1p(-F.col("trust"))))).alias("score"))
                  .where(F.col("score") >= min_score))
        known = keep_table(known.unionByName(likely).groupBy("core", "kind").agg(F.max("score").alias("score")), "known")
    best = known.groupBy("core").agg(F.max(F.struct("score", (-F.col("kind")).alias("kind"))).alias("best"))
    return (place.where("free").join(best, "core")
            .select("key", (-F.col("best.kind")).alias("kind"), "start", "end").distinct())


def find(docs: DataFrame, **how) -> DataFrame:
    """doc_id, key, base and spans per row; spans holds the base spans and those discovered, by kind and start."""
    base = base_table(docs)
    extra = (discovered(base, **how).groupBy("key")
             .agg(F.collect_set(F.struct("kind", "start", "end")).alias("extra")))
    both = base.select("doc_id", "key", "base").join(extra, "key", "left")
    return both.select("doc_id", "key", "base", F.sort_array(F.concat("base", F.coalesce("extra", _no_spans())))
                       .alias("spans"))


def _listed(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, **how) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans and all spans, per document."""
    return find(docs, **how).select(
        "doc_id",
        *[F.size(_of_kind(k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_discovered"))


def _of_kind(kind: int) -> Column:
    return F.filter("base", lambda s: s["kind"] == kind)


def mask(docs: DataFrame, **how) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; n_chars follows, other columns stay."""
    key, spans = free_name(docs, "key"), free_name(docs, "spans")
    some = (find(docs, **how).where(F.size("spans") > 0).groupBy(F.col("key").alias(key))
            .agg(F.min("spans").alias(spans)))
    names = F.array(*[F.lit(f"<{kind.upper()}>") for kind in KINDS])
    out = docs.withColumn(key, row_key()).join(some, key, "left")
    chars, kept = free_name(docs, "chars"), free_name(docs, "kept")
    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    # Of spans that overlap the first one is named, and what they cover together goes.
    empty = F.array().cast("array<struct<start:int,end:int,kind:int>>")

    def merge(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))))
        return F.when((F.size(done) > 0) & (s["start"] < last["end"]), joined).otherwise(F.concat(done, F.array(s)))

    out = stored(out, **{chars: F.when(F.col(spans).isNotNull(), F.split("text", "")), kept: F.aggregate(
        by_start, empty, merge)})
    between = lambda low, high: F.array_join(F.slice(chars, low + 1, high - low), "")
    masked = F.concat(F.array_join(F.transform(kept, lambda s, i: F.concat(
        between(F.when(i == 0, 0).otherwise(F.get(F.col(kept), i - 1)["end"]), s["start"]), F.get(names, s["kind"]))), ""),
        between(F.element_at(kept, -1)["end"], F.size(chars)))
    out = out.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(masked))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast("long")))
    return out.select(*docs.columns)
