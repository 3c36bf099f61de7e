"""The marts. Trip marts take trips that already carry their pickup zone columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.labels import payment_label
from martwright.functions.measures import (
    exact_sum,
    merged,
    ratio_of,
    round_half_up,
    value_of,
)
from martwright.operators.windows import RATE_SERIES, with_change

# Shortest and longest trip, in minutes, that counts for the duration mart.
DURATION_BAND = (1, 180)
SNAPSHOT_FIRST_YEAR = 2000
MINUTES = "trip_duration_minutes"


# Trip marts are built in two steps. Parts are exact counts and sums that can be added
# up, so a job stores them per delivered month and never reads old trips again; the
# mart is worked out from the summed parts. Built in one go from trips, both steps
# group by the same keys and share one shuffle.


def _parts(trips: DataFrame, keys: Sequence[str | Column], measures: Sequence[str]) -> DataFrame:
    """Rows, sums and value counts per group; all sums are exact."""
    sums = [
        (F.sum(name) if name == MINUTES else exact_sum(F.col(name))).alias(f"{name}_sum")
        for name in measures
    ]
    counts = [F.count(name).alias(f"{name}_n") for name in measures]
    return trips.groupBy(*keys).agg(F.count("*").alias("n"), *sums, *counts)


def _trips() -> Column:
    return F.sum("n").alias("total_trips")


def _total(measure: str) -> Column:
    return round_half_up(value_of(merged(f"{measure}_sum")), 2)


def _mean(measure: str) -> Column:
    values = F.sum(f"{measure}_n")
    if measure == MINUTES:
        return round_half_up(ratio_of(F.sum(f"{MINUTES}_sum"), values), 1)
    return round_half_up(ratio_of(value_of(merged(f"{measure}_sum")), values), 2)


def daily_revenue_parts(trips: DataFrame, *also: str) -> DataFrame:
    return _parts(
        trips.where(F.col("pickup_borough").isNotNull()),
        [*also, "pickup_date", "pickup_borough"],
        ["fare_amount", "tip_amount", "total_amount", "trip_distance", MINUTES],
    )


def daily_revenue_of(parts: DataFrame) -> DataFrame:
    return parts.groupBy("pickup_date", "pickup_borough").agg(
        _trips(),
        _total("fare_amount").alias("total_fare_revenue"),
        _total("tip_amount").alias("total_tips"),
        _total("total_amount").alias("total_revenue"),
        _mean("fare_amount").alias("avg_fare"),
        _mean("tip_amount").alias("avg_tip"),
        _mean("trip_distance").alias("avg_distance_miles"),
        _mean(MINUTES).alias("avg_duration_minutes"),
    )


def daily_revenue(trips: DataFrame) -> DataFrame:
    """Trips and money per day and pickup borough."""
    return daily_revenue_of(daily_revenue_parts(trips))


def pickup_zones_parts(trips: DataFrame, *also: str) -> DataFrame:
    hour = F.hour("pickup_datetime").alias("hour_of_day")
    return _parts(
        trips.where(F.col("pickup_zone").isNotNull() & F.col("pickup_borough").isNotNull()),
        [*also, "pickup_borough", "pickup_zone", hour],
        ["fare_amount", "trip_distance", MINUTES],
    )


def pickup_zones_of(parts: DataFrame) -> DataFrame:
    return parts.groupBy("pickup_borough", "pickup_zone", "hour_of_day").agg(
        _trips(),
        _mean("fare_amount").alias("avg_fare"),
        _mean("trip_distance").alias("avg_distance_miles"),
        _mean(MINUTES).alias("avg_duration_minutes"),
    )


def pickup_zones(trips: DataFrame) -> DataFrame:
    """Activity per pickup zone and hour of day."""
    return pickup_zones_of(pickup_zones_parts(trips))


def tip_rate() -> Column:
    """A trip's tip in percent of its fare, NULL without a fare."""
    fare = F.col("fare_amount")
    return F.when(fare > 0, F.col("tip_amount") / fare * 100)


def mean_tip_rate() -> Column:
    """Aggregate: mean of the trips' own tip rates, not the rate of the sums."""
    rate = tip_rate()
    return round_half_up(ratio_of(value_of(exact_sum(rate)), F.count(rate)), 2)


def payment_summary_parts(trips: DataFrame, *also: str) -> DataFrame:
    return _parts(
        trips.withColumn("tip_rate", tip_rate()),
        [*also, "payment_type"],
        ["total_amount", "fare_amount", "tip_amount", "tip_rate", "trip_distance", MINUTES],
    )


def payment_summary_of(parts: DataFrame) -> DataFrame:
    """The label follows from the code, so it is added after the aggregation."""
    summed = parts.groupBy("payment_type").agg(
        _trips(),
        _total("total_amount").alias("total_revenue"),
        _mean("fare_amount").alias("avg_fare"),
        _mean("tip_amount").alias("avg_tip"),
        _mean("tip_rate").alias("avg_tip_rate_pct"),
        _mean("trip_distance").alias("avg_distance_miles"),
        _mean(MINUTES).alias("avg_duration_minutes"),
    )
    return summed.withColumn("payment_label", payment_label(F.col("payment_type")))


def payment_summary(trips: DataFrame) -> DataFrame:
    """Trips, money and tip rate per payment code."""
    return payment_summary_of(payment_summary_parts(trips))


def trip_duration_parts(
    trips: DataFrame, *also: str, shortest: int = DURATION_BAND[0], longest: int = DURATION_BAND[1]
) -> DataFrame:
    """Trips per whole minute of the band.

    That leaves at most one row per minute in any day and borough, however many
    trips it has, so the exact median never needs them in one task.
    """
    minutes = F.col(MINUTES)
    return _parts(
        trips.where(F.col("pickup_borough").isNotNull() & minutes.between(shortest, longest)),
        [*also, F.col("pickup_date").alias("trip_date"), "pickup_borough", MINUTES],
        ["trip_distance"],
    )


def trip_duration_of(parts: DataFrame) -> DataFrame:
    minutes, n = F.col(MINUTES), F.col("n")
    return parts.groupBy("trip_date", "pickup_borough").agg(
        _trips(),
        round_half_up(ratio_of(F.sum(minutes * n), F.sum("n")), 1).alias("avg_duration_minutes"),
        round_half_up(F.percentile(minutes, 0.5, n), 1).alias("median_duration_minutes"),
        _mean("trip_distance").alias("avg_distance_miles"),
        F.min(minutes).alias("min_duration_minutes"),
        F.max(minutes).alias("max_duration_minutes"),
    )


def trip_duration(
    trips: DataFrame, shortest: int = DURATION_BAND[0], longest: int = DURATION_BAND[1]
) -> DataFrame:
    """Duration statistics with the exact median per day and pickup borough."""
    return trip_duration_of(trip_duration_parts(trips, shortest=shortest, longest=longest))


def indicator_change(
    series: DataFrame, rate_series: Sequence[str] = tuple(RATE_SERIES)
) -> DataFrame:
    """Every observation with the one before it and the change between them."""
    return with_change(series, rate_series).select(
        "observation_date", "indicator_name", "series_id", "value", "prev_value", "mom_change"
    )


def country_snapshot(country_years: DataFrame, first_year: int = SNAPSHOT_FIRST_YEAR) -> DataFrame:
    """Country-year figures in display units beside the US values of the year."""

    def shown(column: Column, name: str) -> Column:
        return round_half_up(column, 2).alias(name)

    unemployment, us_unemployment = F.col("unemployment_rate"), F.col("us_unemployment_fred")
    return country_years.where(F.col("observation_year") >= first_year).select(
        "country_code",
        "country_name",
        "observation_year",
        shown(F.col("gdp_usd") / 1e9, "gdp_billions_usd"),
        shown(F.col("inflation_rate"), "inflation_rate_pct"),
        shown(unemployment, "unemployment_rate_pct"),
        shown(us_unemployment, "us_unemployment_fred_pct"),
        shown(F.col("us_cpi_fred"), "us_cpi_index"),
        shown(F.col("us_real_gnp_fred") / 1e3, "us_real_gnp_trillions"),
        shown(unemployment - us_unemployment, "unemployment_vs_us_delta"),
    )


def stamped(mart: DataFrame) -> DataFrame:
    """Add the time the mart was built."""
    return mart.withColumn("updated_at", F.current_timestamp())
