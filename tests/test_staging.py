from datetime import date, datetime

from pyspark.sql import functions as F

from martwright.operators import staging
from martwright.schemas import RAW_TRIPS, STAGED_TRIPS


def raw_trip(**cells):
    defaults = dict.fromkeys(RAW_TRIPS.names, "1.0") | {
        "TPEP_PICKUP_DATETIME": "2025-11-05 10:00:30",
        "TPEP_DROPOFF_DATETIME": "2025-11-05 10:20:10",
        "STORE_AND_FWD_FLAG": "N",
        "SOURCE_MONTH": "2025-11",
    }
    return tuple((defaults | cells)[name] for name in RAW_TRIPS.names)


def raw_trips(spark, *rows):
    return spark.createDataFrame([raw_trip(**row) for row in rows], RAW_TRIPS)


def test_cast_trips_layout_and_values(spark):
    raw = raw_trips(spark, {"RATECODEID": "99.0", "FARE_AMOUNT": "12.5", "PASSENGER_COUNT": None})
    staged = staging.cast_trips(raw)
    assert [(f.name, f.dataType) for f in staged.schema] == [
        (f.name, f.dataType) for f in STAGED_TRIPS
    ]
    row = staged.first()
    assert (row.rate_code_id, row.fare_amount, row.passenger_count) == (99, 12.5, None)
    assert row.pickup_datetime == datetime(2025, 11, 5, 10, 0, 30)
    assert (row.pickup_date, row.trip_duration_minutes) == (date(2025, 11, 5), 20)


def kept(spark, **cells):
    return staging.valid_trips(staging.cast_trips(raw_trips(spark, cells))).count() == 1


def test_validity_bounds(spark):
    late = "2026-12-31 00:00:00"
    assert kept(spark)
    assert not kept(spark, TPEP_PICKUP_DATETIME="junk")
    assert not kept(spark, TPEP_DROPOFF_DATETIME=None)
    assert not kept(spark, TPEP_DROPOFF_DATETIME="2025-11-05 10:00:30")
    assert not kept(spark, FARE_AMOUNT="0")
    assert not kept(spark, FARE_AMOUNT="nan")
    assert not kept(spark, FARE_AMOUNT="NaN")
    assert not kept(spark, TRIP_DISTANCE="-1")
    assert kept(spark, TPEP_PICKUP_DATETIME="2025-01-01 00:00:00")
    assert not kept(spark, TPEP_PICKUP_DATETIME="2024-12-31 23:59:59")
    assert kept(spark, TPEP_PICKUP_DATETIME="2026-02-28 23:59:59", TPEP_DROPOFF_DATETIME=late)
    assert not kept(spark, TPEP_PICKUP_DATETIME="2026-03-01 00:00:00", TPEP_DROPOFF_DATETIME=late)


def test_zones(spark):
    raw = spark.createDataFrame(
        [("1.0", "EWR", "Newark", "EWR"), ("x", None, None, None)],
        "LOCATIONID string, BOROUGH string, ZONE string, SERVICE_ZONE string",
    )
    assert staging.stage_zones(raw).collect() == [(1, "EWR", "Newark", "EWR"), (None,) * 4]


def test_series_variants(spark):
    rows = [("2025-01-01", 1.0), ("2025-02-01", None), (None, 3.0)]
    raw = spark.createDataFrame(rows, "date string, value double").select(
        F.col("date").cast("date").alias("date"),
        "value",
        F.lit("A").alias("indicator_name"),
        F.lit("A").alias("series_name"),
        F.lit("a").alias("series_id"),
        F.current_timestamp().alias("loaded_at"),
    )
    kept_null = staging.stage_series(raw)
    assert [row.value for row in kept_null.collect()] == [1.0, None]
    dropped = staging.stage_series_with_value(raw)
    assert [row.indicator_value for row in dropped.collect()] == [1.0, 3.0]
