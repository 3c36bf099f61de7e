"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.labels import hour_label, recode

HOURS = range(24)


def widen(
    df: DataFrame, keys: Sequence[str | Column], identifier: str, value: str, names: Mapping[str, str]
) -> DataFrame:
    """One column per identifier, ``{output: identifier}``, holding the largest value.

    A fixed list of identifiers needs no job to discover them and one hash
    aggregation; other identifiers add no column but keep their group.
    """
    columns = [
        F.max(F.when(F.col(identifier) == code, F.col(value))).alias(name)
        for name, code in names.items()
    ]
    return df.groupBy(*keys).agg(*columns)


def annual(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Staged monthly series to one row per year with the largest month of each series."""
    year = F.year("observation_date").alias("observation_year")
    return widen(df, [year], "series_id", "indicator_value", names)


def hour_grid(zone_hours: DataFrame) -> DataFrame:
    """Zone by hour, mean trips per cell, 0 where there are none; columns ``h00`` to ``h23``."""
    cells = [
        F.coalesce(F.avg(F.when(F.col("hour_of_day") == hour, F.col("total_trips"))), F.lit(0.0))
        .alias(f"h{hour:02d}")
        for hour in HOURS
    ]
    return zone_hours.groupBy("pickup_zone").agg(*cells)


def hour_cells(grid: DataFrame) -> DataFrame:
    """The grid as one row per zone and labelled hour."""
    columns = [f"h{hour:02d}" for hour in HOURS]
    long = grid.unpivot(["pickup_zone"], columns, "hour_column", "trips")
    hour = F.substring("hour_column", 2, 2).cast("int")
    return long.select("pickup_zone", hour_label(hour).alias("hour_label"), "trips")


def metrics_long(
    df: DataFrame, key: str, labels: Mapping[str, str], metric: str = "metric", value: str = "minutes"
) -> DataFrame:
    """Several metric columns to rows of ``(key, metric label, value)``."""
    long = df.unpivot([key], list(labels), metric, value)
    return long.withColumn(metric, recode(F.col(metric), dict(labels)))
