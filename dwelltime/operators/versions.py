"""Which timetable version describes a service day, and how versions differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dwelltime.functions import clock, text

DAY_KEYS = ["feed", "service_date"]


def _preference(fetched: Column, starts: Column, version: Column) -> Column:
    """Smallest is best: in force at day start, newest first; then the nearest later one."""
    in_force = fetched <= starts
    return F.struct(F.when(in_force, 0).otherwise(1).alias("later"),
                    F.when(in_force, -fetched).otherwise(fetched).alias("distance"),
                    version.alias("version"))


def choose_versions(versions: DataFrame, running: DataFrame, zone: str) -> DataFrame:
    """The version to judge each feed and day by: best of those that list any service.

    `running` says which versions serve which days, so only serving pairs are formed. The
    choice is a minimum per feed and day, which merges on the map side.
    """
    serving = running.select("feed", "version", "service_date").distinct()
    known = versions.select("feed", "version", F.unix_micros("fetched_at").alias("fetched"))
    starts = clock.day_base(F.col("service_date"), zone) * 1_000_000
    ranked = serving.join(known, ["feed", "version"]).select(
        *DAY_KEYS, _preference(F.col("fetched"), starts, F.col("version")).alias("rank"))
    best = ranked.groupBy(*DAY_KEYS).agg(F.min("rank").alias("rank"))
    return best.select(
        *DAY_KEYS, F.col("rank.version").alias("version"),
        (F.col("rank.later") == 0).alias("in_force"),
        F.timestamp_micros(F.abs("rank.distance")).alias("fetched_at"))


def missing_days(wanted: DataFrame, chosen: DataFrame) -> DataFrame:
    """Feeds and days no version serves."""
    return wanted.join(chosen, DAY_KEYS, "left_anti")


def _ranked_versions(versions: DataFrame) -> DataFrame:
    """Versions of a feed numbered by fetch time: `newer` with the better of equal times last, `nearer` first.

    So the versions better than a choice are a stretch of one of the two numbers.
    """
    known = versions.select("feed", "version", F.unix_micros("fetched_at").alias("fetched"))
    feed = Window.partitionBy("feed")
    return known.withColumns({
        "newer": F.row_number().over(feed.orderBy("fetched", F.desc("version"))),
        "nearer": F.row_number().over(feed.orderBy("fetched", "version"))})


def _better_stretch(versions: DataFrame, chosen: DataFrame, zone: str) -> tuple[DataFrame, DataFrame]:
    """(ranked versions, choices with the first and last number of what was preferred to them).

    How many versions a day start has behind it is read off one ordered list of versions and days;
    no version is paired with a day.
    """
    ranked = _ranked_versions(versions)
    starts = clock.day_base(F.col("service_date"), zone) * 1_000_000
    marks = ranked.select("feed", F.col("fetched").alias("at"), F.lit(0).alias("kind"),
                          F.lit(None).cast("date").alias("service_date")).unionByName(
        chosen.select("feed", starts.alias("at"), F.lit(1).alias("kind"), "service_date"))
    # At equal instants versions come first: a version fetched at the day's start is in force.
    behind = F.sum(1 - F.col("kind")).over(Window.partitionBy("feed").orderBy("at", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    as_of = marks.withColumn("behind", behind).where("kind = 1").select(*DAY_KEYS, "behind")
    own = ranked.select("feed", "version", "newer", "nearer")
    ahead = chosen.select(*DAY_KEYS, "version", "in_force").join(own, ["feed", "version"]).join(as_of, DAY_KEYS)
    return ranked, ahead.select(
        *DAY_KEYS, F.col("version").alias("chosen"), "in_force",
        F.when(F.col("in_force"), F.col("newer") + 1).otherwise(1).cast("int").alias("first"),
        F.when(F.col("in_force"), F.col("behind")).otherwise(F.col("nearer") - 1).cast("int").alias("last"))


def passed_over_counts(versions: DataFrame, chosen: DataFrame, zone: str) -> DataFrame:
    """How many versions were preferred to each chosen one but list no service that day."""
    _, ahead = _better_stretch(versions, chosen, zone)
    return ahead.select(*DAY_KEYS, "chosen", F.greatest(F.lit(0), F.col("last") - F.col("first") + 1).alias("passed_over"))


def passed_over(versions: DataFrame, chosen: DataFrame, zone: str) -> DataFrame:
    """Versions preferred to the chosen one that list no service that day, a row each.

    A choice is spread over the numbers of its stretch and meets one version per number, so the join
    makes the rows it returns and no others.
    """
    ranked, ahead = _better_stretch(versions, chosen, zone)
    stretch = ahead.where(F.col("first") <= F.col("last")).withColumn("place", F.explode(F.sequence("first", "last")))
    number = F.explode(F.array(F.struct(F.lit(True).alias("in_force"), F.col("newer").alias("place")),
                               F.struct(F.lit(False).alias("in_force"), F.col("nearer").alias("place"))))
    placed = ranked.select("feed", "version", "fetched", number.alias("number")).select(
        "feed", "version", "fetched", "number.*")
    return stretch.join(placed, ["feed", "in_force", "place"]).select(
        *DAY_KEYS, "version", "chosen", F.timestamp_micros("fetched").alias("fetched_at"))


def claimed_windows(feed_info: DataFrame) -> DataFrame:
    """The dates each version claims to cover; blank on either side means it does not say."""
    return (feed_info.where((F.col("feed_start_date") != "") & (F.col("feed_end_date") != ""))
            .groupBy("feed", "version").agg(
                F.min(F.struct("feed_start_date", "feed_end_date")).alias("window"))
            .select("feed", "version", "window.*"))


def coverage_warnings(chosen: DataFrame, feed_info: DataFrame) -> DataFrame:
    """Each choice with its claimed window; `covers` is NULL where the version does not say."""
    day = clock.compact_date(F.col("service_date"))
    return (chosen.join(claimed_windows(feed_info), ["feed", "version"], "left")
            .withColumn("covers", day.between(F.col("feed_start_date"), F.col("feed_end_date"))))


def newest_etags(manifest: DataFrame) -> DataFrame:
    """Tag of the newest saved version per feed, by upload time."""
    newest = F.max(F.struct("updated_at", "version", "source_etag")).alias("newest")
    return manifest.groupBy("feed").agg(newest).select(
        "feed", F.col("newest.version").alias("version"),
        F.col("newest.source_etag").alias("source_etag"),
        F.col("newest.updated_at").alias("updated_at"))


def changed_versions(offered: DataFrame, manifest: DataFrame) -> DataFrame:
    """Offered timetables worth saving: all but those tagged like the newest saved copy.

    A missing tag proves nothing, so such a timetable is always saved. A tag seen before but
    since replaced counts as changed.
    """
    saved = newest_etags(manifest).select("feed", "source_etag").where(F.col("source_etag") != "")
    return offered.join(saved, ["feed", "source_etag"], "left_anti")


def new_versions(offered: DataFrame, manifest: DataFrame) -> DataFrame:
    """Offers worth saving when several of a feed come at once: in order of fetch time, those whose
    tag differs from the offer before, the first one from the newest saved copy.

    An offer that comes twice counts once. A missing tag proves nothing, so it is always saved.
    """
    saved = newest_etags(manifest).select("feed", F.col("source_etag").alias("saved_etag"))
    order = Window.partitionBy("feed").orderBy("fetched_at", "path")
    placed = offered.distinct().join(saved, "feed", "left").withColumn(
        "before", F.coalesce(F.lag("source_etag").over(order), "saved_etag"))
    return placed.where((F.col("source_etag") == "") | ~F.col("source_etag").eqNullSafe(F.col("before"))).drop(
        "saved_etag", "before")


def version_name(feed: Column, day: Column, etag: Column, content: Column | None = None) -> Column:
    """`<feed>-<date>-<tag>`, the whole tag; without one the hash of the content stands for it."""
    spare = F.lit("noetag") if content is None else F.sha2(content, 256)
    return F.concat_ws("-", feed, day.cast("string"), F.coalesce(F.nullif(etag, F.lit("")), spare))


def short_name(version: Column) -> Column:
    """A version as it is shown: the tag cut to eight characters."""
    return F.regexp_replace(version, r"^(.*-\d{4}-\d{2}-\d{2}-.{8}).*$", "$1")


def published_lines(routes: DataFrame) -> DataFrame:
    """Distinct line codes per version, blanks dropped."""
    code = text.line_code(F.col("route_id"))
    return routes.select("feed", "version", code.alias("line")).where(F.col("line") != "").distinct()


def line_drift(published: DataFrame, recorded: DataFrame, keys: list[str]) -> DataFrame:
    """Lines on one side only: `added` is published but not recorded, `gone` the reverse.

    One grouping over both sides instead of two anti-joins.
    """
    sides = published.select(*keys, "line", F.lit(True).alias("published")).unionByName(
        recorded.select(*keys, "line", F.lit(False).alias("published")))
    seen = sides.groupBy(*keys, "line").agg(
        F.bool_or("published").alias("published"), F.bool_and("published").alias("only_published"))
    return (seen.where(~F.col("published") | F.col("only_published"))
            .select(*keys, "line", F.when(F.col("published"), "added").otherwise("gone").alias("change")))


def recorded_lines(spark) -> DataFrame:
    """The lines the recorder subscribes to, and which of them only run on game days."""
    from dwelltime import fixed_values as fixed

    rows = [(fixed.BUS_AGENCY, line, line in fixed.EVENT_ONLY_LINES) for line in fixed.BUS_LINES]
    rows += [(fixed.RAIL_AGENCY, line, False) for line in fixed.RAIL_LINES]
    return spark.createDataFrame(rows, "agency string, line string, event_only boolean")
