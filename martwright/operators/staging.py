"""Cleaning and typing of raw tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions.calendar import minutes_crossed
from martwright.functions.casts import parse_columns, safe_int
from martwright.schemas import (
    STAGED_TRIPS,
    TRIP_INTEGERS,
    TRIP_MEASURES,
    TRIP_TEXTS,
    TRIP_TIMES,
)

# Pickups are plausible from the first day up to, not including, the second.
TRIP_WINDOW = (date(2025, 1, 1), date(2026, 3, 1))


def cast_trips(raw: DataFrame) -> DataFrame:
    """Raw text trips to typed columns, plus pickup date and duration in minutes."""
    typed = parse_columns(
        raw, measures=TRIP_MEASURES, integers=TRIP_INTEGERS, times=TRIP_TIMES, keep=TRIP_TEXTS
    )
    return with_trip_times(typed).select(STAGED_TRIPS.names)


def with_trip_times(trips: DataFrame) -> DataFrame:
    """Add pickup date and duration, counted in minute boundaries."""
    return trips.withColumns(
        {
            "trip_duration_minutes": minutes_crossed(
                F.col("pickup_datetime"), F.col("dropoff_datetime")
            ),
            "pickup_date": F.col("pickup_datetime").cast("date"),
        }
    )


def valid_trips(
    trips: DataFrame, first_day: date = TRIP_WINDOW[0], end_day: date = TRIP_WINDOW[1]
) -> DataFrame:
    """Trips that end after they start, inside the window, with a fare and a distance."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return trips.where(
        pickup.isNotNull()
        & dropoff.isNotNull()
        & (pickup < dropoff)
        & (pickup >= F.lit(first_day).cast("timestamp_ntz"))
        & (pickup < F.lit(end_day).cast("timestamp_ntz"))
        & (F.col("fare_amount") > 0)
        & (F.col("trip_distance") > 0)
    )


def stage_zones(raw: DataFrame) -> DataFrame:
    return raw.select(
        safe_int(F.col("LOCATIONID")).alias("location_id"),
        F.col("BOROUGH").alias("borough"),
        F.col("ZONE").alias("zone"),
        F.col("SERVICE_ZONE").alias("service_zone"),
    )


def stage_series(raw: DataFrame) -> DataFrame:
    """Typed observations; rows without a date go, rows without a value stay."""
    return raw.where(F.col("date").isNotNull()).select(
        F.col("date").cast("date").alias("observation_date"),
        "indicator_name",
        "series_id",
        F.col("value").cast("double").alias("value"),
        "loaded_at",
    )


def stage_series_with_value(raw: DataFrame) -> DataFrame:
    """Renamed observations; rows without a value go."""
    return raw.where(F.col("value").isNotNull()).select(
        "series_id",
        "series_name",
        F.col("date").alias("observation_date"),
        F.col("value").alias("indicator_value"),
        "loaded_at",
    )


def stage_country(raw: DataFrame) -> DataFrame:
    """Renamed country indicators; rows without a value go."""
    return raw.where(F.col("value").isNotNull()).select(
        "country_code",
        "country_name",
        "indicator_id",
        "indicator_name",
        F.col("year").alias("observation_year"),
        F.col("value").alias("indicator_value"),
        "loaded_at",
    )
