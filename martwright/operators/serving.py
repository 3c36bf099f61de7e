"""What the reports read from the marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.calendar import years_before
from martwright.functions.labels import change_polarity, change_text, value_text
from martwright.functions.measures import plain_mean
from martwright.operators.joins import keep_matching
from martwright.sources.files import lower_names

# The columns each report shows and the order it shows them in.
DAILY_REVENUE = (
    ["pickup_date", "pickup_borough", "total_trips", "total_revenue", "avg_fare", "avg_tip"],
    ["pickup_date", "pickup_borough"],
)
PICKUP_ZONES = (
    ["pickup_borough", "pickup_zone", "hour_of_day", "total_trips"],
    ["pickup_borough", "pickup_zone", "hour_of_day"],
)
PAYMENT_SUMMARY = (
    ["payment_label", "total_trips", "total_revenue", "avg_tip_rate_pct"],
    ["-total_trips", "payment_label"],
)
TRIP_DURATION = (
    [
        "trip_date",
        "pickup_borough",
        "avg_duration_minutes",
        "median_duration_minutes",
        "total_trips",
    ],
    ["trip_date", "pickup_borough"],
)
INDICATORS = (
    ["observation_date", "indicator_name", "series_id", "value", "prev_value", "mom_change"],
    ["indicator_name", "observation_date"],
)
TOP_ZONES = 20


def serve(mart: DataFrame, report: tuple[Sequence[str], Sequence[str]]) -> DataFrame:
    """A report's columns in its order; ``-column`` sorts descending."""
    columns, order = report
    keys = [F.desc(key[1:]) if key.startswith("-") else F.asc(key) for key in order]
    return lower_names(mart).select(*columns).orderBy(*keys)


def choose(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with one of the values; no values means all rows."""
    return df.where(F.col(column).isin(*values)) if values else df


def last_years(df: DataFrame, indicator: str, years: int, as_of: date) -> DataFrame:
    """One indicator from ``years`` before ``as_of`` on."""
    if not 1 <= years <= 24:
        raise ValueError("years must be between 1 and 24")
    return df.where(
        (F.col("indicator_name") == indicator)
        & (F.col("observation_date") >= years_before(F.lit(as_of), years))
    )


def top_zones(zone_hours: DataFrame, n: int = TOP_ZONES) -> DataFrame:
    """The zones with most trips; equal totals in name order."""
    totals = zone_hours.groupBy("pickup_zone").agg(F.sum("total_trips").alias("total_trips"))
    return totals.orderBy(F.desc("total_trips"), "pickup_zone").limit(n)


def only_top_zones(grid: DataFrame, zone_hours: DataFrame, n: int = TOP_ZONES) -> DataFrame:
    """Grid rows of the top zones; at most ``n`` of them, so they are broadcast."""
    return keep_matching(grid, F.broadcast(top_zones(zone_hours, n)), "pickup_zone")


def duration_by_borough(mart: DataFrame) -> DataFrame:
    """Unweighted mean of the daily averages and medians, and all trips, per borough."""
    return mart.groupBy("pickup_borough").agg(
        plain_mean("avg_duration_minutes").alias("avg_duration_minutes"),
        plain_mean("median_duration_minutes").alias("median_duration_minutes"),
        F.sum("total_trips").alias("total_trips"),
    )


def latest(df: DataFrame, key: str = "indicator_name", at: str = "observation_date") -> DataFrame:
    """Per key the newest non-null value of every column, possibly of different dates.

    Of several values of one date the largest counts, whatever order the rows come in.
    """
    columns = [name for name in df.columns if name != key]
    return df.groupBy(key).agg(
        *[
            F.max_by(
                name, F.when(F.col(name).isNotNull(), F.struct(F.col(at), F.col(name)))
            ).alias(name)
            for name in columns
        ]
    )


def cards(
    newest: DataFrame,
    rates: Sequence[str],
    inverse: Sequence[str],
    neutral: Sequence[str],
) -> DataFrame:
    """Headline texts per indicator: value, change and how to colour the change."""
    name = F.col("indicator_name")
    return newest.select(
        "indicator_name",
        value_text(name, F.col("value"), rates).alias("value_text"),
        change_text(name, F.col("mom_change"), rates).alias("delta_text"),
        change_polarity(name, inverse, neutral).alias("delta_color"),
    )
