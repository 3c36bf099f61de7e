"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from martwright.operators import joins, quality, windows
from martwright.operators.staging import cast_trips
from martwright.plans import contracts, marts
from martwright.plans.trips import coerce_for_checks
from martwright.schemas import STAGED_TRIPS
from martwright.sources.files import read_facts
from tests.test_staging import raw_trips
from workloads import roles

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: Jobs and landings, which run many plans of their own.
JOBS = {
    "trips_end_to_end", "trips_end_to_end_duration", "trips_end_to_end_zones", "trips_end_to_end_payment",
    "gated_publish", "run_log", "stream_landing", "stream_to_marts", "land_month_file", "append_sink",
    "snapshot_end_to_end", "indicators_end_to_end", "indicators_gated",
}
QUICK = sorted(set(entry_points.QUERIES) - JOBS)


@pytest.mark.parametrize("name", QUICK)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry_points.QUERIES[name](spark, FOLDER))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonUDF"):
        assert operator not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_suite_reads_the_table_once(spark, tmp_path):
    raw_trips(spark, {}, {}).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    report = quality.run_suite(coerce_for_checks(raw), contracts.raw_trip_suite())
    text = plan(report)
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1


def test_contract_with_references_reads_the_table_once(spark, tmp_path):
    staged = cast_trips(raw_trips(spark, {}, {}))
    staged.write.parquet(str(tmp_path / "facts_here"))
    facts = spark.read.parquet(str(tmp_path / "facts_here"))
    contract = contracts.staged_trips_contract(["2025-11"])
    assert len(contract.references) == 2 and not contract.unique
    zones = spark.createDataFrame([(1,), (None,), (1,)], "location_id int")
    report = quality.run_contract(facts, contract, {"zones": zones})
    assert plan(report).count("facts_here") == 1
    found = {(r.check_kind, r.column_name): r.n_failing for r in report.collect()}
    assert found["relationship", "pickup_location_id"] == 0


def test_month_filter_reaches_the_scan(spark):
    facts = read_facts(
        spark,
        roles.table_path(FOLDER, "lineitem"),
        roles.layout("lineitem"),
        time_column="l_shipdate",
        month="1997-06",
    ).select("l_quantity")
    text = plan(facts)
    assert "GreaterThanOrEqual(l_shipdate,1997-06-01T00:00)" in text
    assert "LessThan(l_shipdate,1997-07-01T00:00)" in text
    assert re.search(r"ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>", text)


def test_stored_trips_prune_partitions_and_push_filters(spark, tmp_path):
    trips = cast_trips(raw_trips(spark, {}))
    trips.write.partitionBy("source_month").parquet(str(tmp_path / "t"))
    stored = spark.read.schema(STAGED_TRIPS).parquet(str(tmp_path / "t"))
    chosen = stored.where((F.col("source_month") == "2025-11") & (F.col("fare_amount") > 5))
    text = plan(chosen.select("extra"))
    assert re.search(r"PartitionFilters: \[.*source_month", text)
    assert "GreaterThan(fare_amount,5.0)" in text


def test_marts_join_only_the_pickup_zone(spark):
    trips = roles.trips(spark, FOLDER)
    joined = joins.with_zones(trips, roles.zones(spark, FOLDER), ["pickup"])
    text = plan(marts.daily_revenue(joined))
    assert text.count("region.parquet") == 1
    assert "supplier.parquet" not in text


def test_change_mart_shares_one_window_over_the_rows(spark):
    text = plan(windows.with_change(roles.series(spark, FOLDER)))
    assert text.count("Window [") == 2


def test_small_lookups_are_broadcast_and_large_ones_are_not(spark):
    facts = spark.range(100_000).select((F.col("id") % 100).alias("k"), "id")
    few = spark.range(50).groupBy(F.col("id").alias("k")).agg(F.count("*").alias("n"))
    many = spark.range(3_000_000).groupBy(F.col("id").alias("k")).agg(F.max(F.xxhash64("id")).alias("n"))
    small = plan(joins.lookup_join(facts, few, "k", "left"))
    assert "BroadcastHashJoin" in small and "Exchange hashpartitioning" not in small
    assert "SortMergeJoin" in plan(joins.lookup_join(facts, many, "k", "left"))
