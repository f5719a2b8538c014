"""Quality rules: a decision list learned by sequential covering, applied as Spark conditional expressions.

Statistics of a text are column expressions. Labelled rows grow one rule after the other, each a conjunction of
thresholds, and prune it on rows kept aside; what a rule covers leaves the data before the next one is grown.

Defined results: a null text is empty; a text without a word fails the base rule; labels that are null or belong to
no document are left out; repeated rows are judged alike; without labels of both kinds there is no learned rule.
Columns of the input other than the text pass through untouched, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwelltime.llm.tables import keep_table

SEPARATORS = r"[\x20\x09-\x0D]+"
BASE_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["n_words", "mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
            "digit_share", "stop_mark_share", "short_word_share", "distinct_share"]


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _left_over(text: Column, kept: str) -> Column:
    """Number of characters of a class."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def with_statistics(docs: DataFrame, text: str = "text", into: str = "stats") -> DataFrame:
    """Adds one struct column with the counts and the learner's features.

    The steps are columns of their own, each read at least twice by the next one: Spark then computes an array once
    a row instead of once for every element that a lambda asks for.
    """
    own = docs.columns
    body, words, lines, threes, placed, again = (F.col(f"{into}_{x}") for x in (
        "body", "words", "lines", "threes", "placed", "again"))
    out = docs.withColumn(f"{into}_body", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumns({
        f"{into}_words": F.array_remove(F.split(body, SEPARATORS, -1), ""),
        f"{into}_lines": F.filter(F.split(body, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))})
    n = F.size(words)
    # Three words in a row as one hash. A hash and its position are sorted only where a hash comes twice.
    out = out.withColumn(f"{into}_threes", F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        1, F.greatest(n - 2, F.lit(0))))
    out = out.withColumn(f"{into}_placed", F.when(
        F.size(F.array_distinct(threes)) < F.size(threes),
        F.sort_array(F.transform(threes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    out = out.withColumn(f"{into}_again", F.transform(
        F.filter(placed, lambda s, i: (s["h"] == F.get(placed, i - 1)["h"]) | (s["h"] == F.get(placed, i + 1)["h"])),
        lambda s: s["i"]))
    covered = F.size(F.array_union(F.array_union(again, F.transform(again, lambda i: i + 1)),
                                   F.transform(again, lambda i: i + 2)))
    counts = {
        "n_words": n.cast("long"), "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": _left_over(body, "#*$%&|<>"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.when(again.isNull(), F.lit(0)).otherwise(covered).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_upper": _left_over(body, r"\p{Lu}"), "n_digits": _left_over(body, "0-9"),
        "n_marks": _left_over(body, ".,;:!?"), "n_distinct": F.size(F.array_distinct(words)).cast("long"),
        "n_short": F.size(F.filter(words, lambda w: F.length(w) <= 3)).cast("long"),
    }
    # A generator of one row: filters on the statistics stay above it, else Spark would copy the whole computation
    # into the filter and repeat it for every element that a lambda asks for.
    out = out.select(*[F.col(f"`{name}`") for name in own],
                     F.inline(F.array(F.struct(*[v.alias(f"{into}_{k}") for k, v in counts.items()]))))
    at = {k: F.col(f"{into}_{k}") for k in counts}
    return out.select(*[F.col(f"`{name}`") for name in own], F.struct(
        *[at[name].alias(name) for name in BASE_COUNTS],
        _share(at["word_chars"], at["n_words"]).alias("mean_word_chars"),
        _share(at["n_symbols"], at["word_chars"]).alias("symbol_share"),
        _share(at["n_dup_lines"], at["n_lines"]).alias("dup_line_share"),
        _share(at["n_repeat_words"], at["n_words"]).alias("repeat_share"),
        _share(at["n_upper"], at["word_chars"]).alias("upper_share"),
        _share(at["n_digits"], at["word_chars"]).alias("digit_share"),
        _share(at["n_marks"], at["n_words"]).alias("stop_mark_share"),
        _share(at["n_short"], at["n_words"]).alias("short_word_share"),
        _share(at["n_distinct"], at["n_words"]).alias("distinct_share")).alias(into))


def base_failed(stats: str = "stats") -> Column:
    """Too few words, or over half of them in repeated three-word windows."""
    n, again = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < 50) | (100 * again > 50 * n)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, stats: str) -> Column:
        value = F.col(f"{stats}.{self.feature}")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds rejects the text, none keeps it."""

    rules: tuple[tuple[Condition, ...], ...]

    def reason(self, stats: str = "stats") -> Column:
        """The text of the first rule that holds, else null: one conditional expression."""
        out = F.lit(None).cast("string")
        for rule in reversed(self.rules):
            holds = F.lit(True)
            for condition in rule:
                holds = holds & condition.column(stats)
            out = F.when(holds, F.lit(" and ".join(map(str, rule)))).otherwise(out)
        return out


def _level(value: Column, cuts: list) -> Column:
    """How many cuts lie below the value."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda cut: cut < value))


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -math.inf


def learn(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000, max_rules: int = 10, max_conditions: int = 4,
          levels: int = 32, min_precision: float = 0.9, min_cover: int = 8) -> DecisionList:
    """A decision list for quality = 0.

    Fitted on at most max_labels labelled rows, taken by a hash of the id (the documented bound); the sample is what
    is broadcast, and only counts by feature and level come to the driver. A rule is kept if on rows kept aside,
    one in three, min_precision of what it covers is of low quality.
    """
    asked = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))
    sample = docs.select(F.col("doc_id"), F.col("text")).join(F.broadcast(asked), "doc_id")
    sample = with_statistics(sample).where(~base_failed())
    sample = keep_table(sample.select((F.col("quality") == 0).cast("int").alias("y"), "stats",
                                      (F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(3)) == 0).alias("aside")), "rules")
    grid = [(i + 0.5) / levels for i in range(levels)]
    cuts = sample.agg(*[F.percentile_approx(f"stats.{f}", grid, 10_000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(cuts[f] or [])) for f in FEATURES}
    if not any(cuts.values()):
        return DecisionList(())
    level = {f: _level(F.col(f"stats.{f}"), cuts[f]) for f in FEATURES}
    rest = keep_table(sample.select("y", "aside", "stats", F.array(*[
        F.struct(F.lit(k).alias("feature"), level[f].alias("level")) for k, f in enumerate(FEATURES)])
        .alias("levels")).coalesce(1), "rules")
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < max_rules:
        rule: list[Condition] = []
        seen = rest.where(~F.col("aside"))
        while len(rule) < max_conditions:
            found = (seen.select("y", F.explode("levels").alias("at")).groupBy("at.feature", "at.level")
                     .agg(F.sum("y").alias("p"), F.count("*").alias("all")).collect())
            best = _best_condition(found, cuts, min_cover)
            if best is None:
                break
            rule.append(best)
            seen = seen.where(best.column("stats"))
        if not rule:
            break
        rule = _prune(rest.where("aside"), rule, min_precision, min_cover // 2)
        if not rule:
            break
        rules.append(tuple(rule))
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column("stats")
        rest = rest.where(~holds)
    return DecisionList(tuple(rules))


def _best_condition(found: list, cuts: dict, min_cover: int) -> Condition | None:
    """The threshold with the largest information gain, from counts by feature and level."""
    first = [r for r in found if r["feature"] == 0]
    p0, all0 = sum(r["p"] for r in first), sum(r["all"] for r in first)
    if p0 < min_cover or p0 == all0:
        return None
    best, most = None, 1e-9
    for k, feature in enumerate(FEATURES):
        rows = {r["level"]: (r["p"], r["all"] - r["p"]) for r in found if r["feature"] == k}
        p = n = 0
        for i, cut in enumerate(cuts[feature]):
            p, n = p + rows.get(i, (0, 0))[0], n + rows.get(i, (0, 0))[1]
            for above, (a, b) in ((False, (p, n)), (True, (p0 - p, all0 - p0 - n))):
                gain = _gain(a, b, p0, all0 - p0) if a >= min_cover else -math.inf
                if gain > most and (a, b) != (p0, all0 - p0):
                    best, most = Condition(feature, above, float(cut)), gain
    return best


def _prune(aside: DataFrame, rule: list[Condition], min_precision: float, min_cover: int) -> list[Condition]:
    """The prefix of a rule that does best on the rows kept aside; none if that isn't precise enough."""
    sums, holds = [], F.lit(True)
    for k, condition in enumerate(rule):
        holds = holds & condition.column("stats")
        sums += [F.sum(F.when(holds, F.col("y")).otherwise(0)).alias(f"p{k}"),
                 F.sum(F.when(holds, 1).otherwise(0)).alias(f"all{k}")]
    row, best, most = aside.agg(*sums).first(), [], -math.inf
    for k in range(len(rule)):
        p, every = row[f"p{k}"] or 0, row[f"all{k}"] or 0
        if every >= min_cover and p >= min_precision * every and (2 * p - every) > most:
            best, most = rule[:k + 1], 2 * p - every
    return best


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """A row per document: its counts, the base verdict, the rule that rejected it and whether it is kept."""
    judged = with_statistics(docs.select(F.col("doc_id"), F.col("text")))
    judged = judged.select("doc_id", "stats", F.coalesce(base_failed(), F.lit(True)).alias("base_failed"),
                           rules.reason().alias("reason"))
    return judged.select("doc_id", *[f"stats.{name}" for name in BASE_COUNTS], "base_failed",
                         (~F.col("base_failed") & F.col("reason").isNull()).alias("kept"), "reason")


def filter_quality(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The documents that the base rule and the learned list keep, with their own columns."""
    names = docs.columns
    own = docs.select(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(names)],
                      F.col("text").alias("_text"))
    judged = with_statistics(own, "_text", "_stats")
    return (judged.where(~base_failed("_stats") & rules.reason("_stats").isNull())
            .select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)]))
