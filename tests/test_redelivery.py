"""A month that is delivered again, or run again with other limits, leaves nothing stale."""

from martwright.plans import trips
from tests.test_jobs import CHECKS, ZONES, delivery, revenue

MONTH = "2025-11"


def run(spark, folder, raw, run_id, **more):
    zones = spark.createDataFrame([("1.0", "EWR", "Newark", "EWR")], ZONES)
    return trips.run_month(spark, raw, zones, folder, MONTH, run_id, CHECKS, **more)


def test_a_failed_month_is_repaired_by_its_next_delivery(spark, tmp_path):
    folder = str(tmp_path)
    bad = delivery(spark, MONTH, ("2025-11-05", None), ("2025-11-06", None))
    good = delivery(spark, MONTH, ("2025-11-05", "10.0"), ("2025-11-06", "2.5"))
    assert not run(spark, folder, bad, "r1")
    assert run(spark, folder, good, "r2")
    assert revenue(spark, folder) == [("2025-11-05", 1, 10.0), ("2025-11-06", 1, 2.5)]
    assert run(spark, folder, delivery(spark, MONTH, ("2025-11-07", "9.0")), "r3")
    assert len(revenue(spark, folder)) == 2, "a built month keeps its delivery"


def test_a_replaced_month_leaves_no_stale_days(spark, tmp_path):
    folder = str(tmp_path)
    first = delivery(spark, MONTH, ("2025-11-05", "10.0"), ("2025-11-06", "2.0"), ("2025-12-01", "7.0"))
    assert run(spark, folder, first, "r1")
    again = delivery(spark, MONTH, ("2025-11-06", "3.0"), ("2025-11-06", "1.0"))
    assert run(spark, folder, again, "r2", replace=True)
    assert revenue(spark, folder) == [("2025-11-06", 2, 4.0)]
    # A fare that is not positive is no valid trip, so nothing of this delivery stays.
    empty = delivery(spark, MONTH, *[("2025-11-06", "0.0")] * 2)
    run(spark, folder, empty, "r3", replace=True)
    assert revenue(spark, folder) == []


def test_a_rerun_with_other_limits_equals_a_fresh_build(spark, tmp_path):
    raw = delivery(spark, MONTH, ("2025-11-05", "10.0"), ("2025-11-06", "2.0"))
    narrow = trips.TripSettings(shortest=11, longest=20)
    assert run(spark, str(tmp_path / "a"), raw, "r1")
    durations = f"{tmp_path}/a/mart_trip_duration"
    assert spark.read.parquet(durations).count() == 2
    run(spark, str(tmp_path / "a"), raw, "r2", settings=narrow)
    assert spark.read.parquet(durations).count() == 0


def test_a_run_leaves_no_work_tables(spark, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr("martwright.session.shared_folder", lambda spark: str(shared))
    assert run(spark, str(tmp_path / "t"), delivery(spark, MONTH, ("2025-11-05", "10.0")), "r1")
    assert (shared / "work").is_dir() and not list((shared / "work").iterdir())
