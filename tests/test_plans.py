"""What the plans must look like, and what a hot key must not do to them."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from frames import rows
from dwelltime.bindings import star
from dwelltime.bindings.queries import QUERIES
from dwelltime.operators import grains, observe

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[1]
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", ["arrivals", "headlines", "stop_totals", "hour_of_week_profile", "by_agency", "version_as_of"])
def test_core_stays_in_the_jvm_and_never_crosses(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit", "Exchange SinglePartition"):
        assert word not in plan, word


@needs_data
def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["headlines"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_returnflag), Not(EqualTo(l_returnflag,R))" in plan
    assert "o_custkey" not in plan and "l_suppkey" not in plan


@needs_data
def test_match_moves_neither_side_again(spark):
    """Stops and reports are grouped by the join's keys, so the join adds no exchange to either."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["headlines"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("== Initial Plan ==")[-1].splitlines()
    at = next(i for i, line in enumerate(lines) if "LeftOuter" in line)
    below = [line.split("+- ")[-1].split(":- ")[-1].strip() for line in lines[at + 1:at + 4]]
    assert below[0].startswith("Sort") and below[1].startswith("HashAggregate"), below


@needs_data
def test_every_oracle_has_its_query():
    from dwelltime.bindings.oracles import ORACLES

    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_a_third_of_all_reports_at_one_stop(spark):
    """The hot stop leaves the map side as one row per task and stop id."""
    many = spark.range(0, 60_000, 1, 8).select(
        F.lit("2026-08-18").cast("date").alias("service_date"), F.lit("A").alias("agency"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("trip_id"),
        F.when(F.col("id") % 2 == 0, "STOPPED_AT").otherwise("IN_TRANSIT_TO").alias("status"),
        F.lit(1).alias("stop_sequence"), (F.col("id") % 7).cast("string").alias("stop_id"), F.col("id").alias("ts"))
    observed = observe.observed_stops(many)
    assert rows(observed.where("trip_id = 'hot'").drop("service_date", "agency")) == [
        ("hot", 1, 0, 59994, 59997, True, 7, "0")]
    plan = plan_of(observed)
    assert plan.index("partial_min") > plan.index("Exchange")


def test_a_hot_lines_quantiles_are_exact(spark):
    rows_in = spark.range(0, 30_000, 1, 8).select(
        F.lit("A").alias("agency"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("line"),
        (F.col("id") % 1000 - 200).cast("int").alias("delay_seconds"))
    head = grains.headlines(rows_in).where("line = 'hot'").first()
    values = sorted(i % 1000 - 200 for i in range(0, 30_000, 3))
    exact = lambda q: values[int(q * 9999)] + (q * 9999 % 1) * (values[int(q * 9999) + 1] - values[int(q * 9999)])
    assert abs(head.med - exact(0.5)) <= 0.5 and abs(head.p90 - exact(0.9)) <= 0.5
    assert head.scheduled == head.measured == 10_000


def test_no_row_at_a_time_python_and_no_local_checkpoint():
    source = "\n".join(p.read_text() for p in (REPO / "dwelltime").rglob("*.py"))
    for word in ("localCheckpoint", "F.udf", ".rdd", "toPandas", "crossJoin", "applyInPandas"):
        assert word not in source, word


@needs_data
@pytest.mark.parametrize("name", ["headlines", "stop_totals", "hour_of_week_profile", "stop_dayparts", "daily_report"])
def test_quantiles_need_no_buffers(spark, name):
    """Counted values and running sums: nothing that falls back to sorting past a number of groups."""
    plan = plan_of(QUERIES[name](spark, SF))
    for word in ("ObjectHashAggregate", "SortAggregate"):
        assert word not in plan, word


@needs_data
def test_all_grains_come_from_one_scan_and_equal_those_of_the_rows(spark):
    view = star.view(spark, SF)
    plan = plan_of(grains.histogram(view))
    assert plan.split("== Initial Plan ==")[-1].count("Expand [") == 1
    counts = grains.histogram(view)
    for direct, counted in ((grains.headlines, grains.headlines_of), (grains.profiles, grains.profiles_of),
                            (grains.stop_cells, grains.stop_cells_of), (grains.stop_totals, grains.stop_totals_of),
                            (grains.site_totals, grains.all_site_totals_of)):
        assert rows(direct(view)) == rows(counted(counts)), direct.__name__


def test_merged_partitions_are_bounded(spark):
    """Tasks of small shuffles are merged, but not beyond what the sorts and hash tables of one task may take."""
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16MB"
