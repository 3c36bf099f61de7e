from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martwright.operators import quality as q
from martwright.plans import contracts
from martwright.plans.trips import coerce_for_checks
from martwright.schemas import RAW_TRIP_COLUMNS
from tests.test_staging import raw_trips


def report(df, *checks):
    return [row.asDict() for row in q.run_suite(df, checks).orderBy("check_no").collect()]


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize(
    "check, passing, failing",
    [
        (q.not_null("x"), [1.0, 2.0], [1.0, None]),
        (q.between("x", low=0), [0.0, None], [-0.1, 5.0]),
        (q.between("x", high=4), [4.0], [4.5]),
        (q.in_set("x", [1.0, 2.0]), [1.0, None], [3.0]),
        (q.row_count(1, 2), [1.0, 2.0], [1.0, 2.0, 3.0]),
    ],
)
def test_each_kind(spark, check, passing, failing):
    assert report(numbers(spark, passing), check)[0]["passed"]
    assert not report(numbers(spark, failing), check)[0]["passed"]


def test_greater_ignores_rows_with_both_null(spark):
    rows = [(2, 1), (None, None), (3, 2)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert report(df, q.greater("a", "b"))[0]["n_evaluated"] == 2
    one_null = spark.createDataFrame([(2, 1), (None, 1)], "a int, b int")
    line = report(one_null, q.greater("a", "b", mostly=0.6))[0]
    assert (line["n_failing"], line["passed"]) == (1, False)


@pytest.mark.parametrize("share", [0.97, 0.95, 0.88, 0.07, 0.55])
def test_mostly_exactly_at_the_threshold(spark, share):
    good = round(share * 100)
    at = numbers(spark, [1.0] * good + [-1.0] * (100 - good))
    below = numbers(spark, [1.0] * (good - 1) + [-1.0] * (101 - good))
    check = q.between("x", low=0, mostly=share)
    assert report(at, check)[0]["passed"]
    assert not report(below, check)[0]["passed"]


def test_column_set(spark):
    df = spark.range(1).select("id", F.lit(1).alias("x"))
    assert report(df, q.column_set(["x", "id"]))[0]["passed"]
    line = report(df, q.column_set(["id", "y"]))[0]
    assert (line["n_failing"], line["passed"]) == (2, False)


def test_empty_table_passes_row_checks(spark):
    df = numbers(spark, [1.0]).where("x > 9")
    assert all(line["passed"] for line in report(df, q.not_null("x"), q.between("x", low=0)))


def test_raw_suite_has_16_checks_and_passes_clean_trips(spark):
    checks = contracts.raw_trip_suite(rows=(1, 10))
    assert len(checks) == 16
    assert q.suite_passed(q.run_suite(coerce_for_checks(raw_trips(spark, {}, {})), checks))


@pytest.mark.parametrize(
    "cells",
    [{column: None} for column in contracts.RAW_NOT_NULL]
    + [
        {"TPEP_DROPOFF_DATETIME": "2025-11-05 09:00:00"},
        {"FARE_AMOUNT": "-1"},
        {"TRIP_DISTANCE": "-1"},
        {"RATECODEID": "7.0"},
    ],
)
def test_each_raw_expectation_can_fail(spark, cells):
    checks = contracts.raw_trip_suite(rows=(1, 10))
    verdict = q.suite_verdict(q.run_suite(coerce_for_checks(raw_trips(spark, cells)), checks))
    assert verdict.first().success is False


def test_raw_suite_rows_and_columns_can_fail(spark):
    raw = coerce_for_checks(raw_trips(spark, {}))
    assert not q.suite_passed(q.run_suite(raw, contracts.raw_trip_suite()))
    narrower = contracts.raw_trip_suite(rows=(1, 10), columns=RAW_TRIP_COLUMNS[1:])
    assert not q.suite_passed(q.run_suite(raw, narrower))


def test_contract_sizes():
    trips = [
        contracts.staged_trips_contract(),
        contracts.zones_contract(),
        contracts.TRIPS_JOINED,
        contracts.DAILY_REVENUE,
        contracts.PICKUP_ZONES,
        contracts.PAYMENT_SUMMARY,
        contracts.TRIP_DURATION,
    ]
    assert sum(contract.size() for contract in trips) == 38
    assert contracts.staged_series_contract().size() + contracts.INDICATOR_CHANGE.size() == 6
    snapshot = [
        contracts.snapshot_series_contract(),
        contracts.country_contract(),
        contracts.COUNTRY_SNAPSHOT,
    ]
    assert sum(contract.size() for contract in snapshot) == 14


def test_contract_finds_duplicates_and_orphans(spark):
    zones = spark.createDataFrame([(1, "EWR"), (2, "Mars"), (2, None)], "location_id int, borough string")
    lines = q.run_contract(zones, contracts.zones_contract(), {}).collect()
    failing = {(r.check_kind, r.column_name): r.n_failing for r in lines if not r.passed}
    assert failing == {("unique", "location_id"): 1, ("in_set", "borough"): 1}
    child = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    contract = q.Contract(checks=(q.not_null("k"),), references={"k": ("zones", "location_id")})
    lines = q.run_contract(child, contract, {"zones": zones}).collect()
    assert {r.check_kind: r.n_failing for r in lines} == {"not_null": 1, "relationship": 1}


@pytest.mark.parametrize(
    "age, status", [(45, "pass"), (46, "warn"), (60, "warn"), (61, "error")]
)
def test_freshness(spark, age, status):
    today = date(2025, 6, 1)
    loaded = datetime(2025, 6, 1, 12) - timedelta(days=age)
    df = spark.createDataFrame([(loaded,)], "loaded_at timestamp_ntz")
    row = q.freshness(df, today).first()
    assert (row.age_days, row.status) == (age, status)


def test_range_tests_cover_both_documented_bounds(spark):
    rows = [("UNRATE", -0.1), ("UNRATE", 25.0), ("UNRATE", 25.1), ("FEDFUNDS", 31.0), ("UNRATE", None)]
    df = spark.createDataFrame(rows, "series_id string, value double")
    unemployment = q.out_of_range(df, "UNRATE", *contracts.UNEMPLOYMENT_RANGE)
    assert sorted(r.value for r in unemployment.collect()) == [-0.1, 25.1]
    interest = q.out_of_range(df, "FEDFUNDS", *contracts.INTEREST_RANGE)
    assert [r.value for r in interest.collect()] == [31.0]


def test_large_changes_skip_null(spark):
    df = spark.createDataFrame([(50.0,), (-50.1,), (None,)], "mom_change double")
    assert [r.mom_change for r in q.large_changes(df).collect()] == [-50.1]
