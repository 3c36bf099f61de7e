"""Previous value and period change along a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.functions.measures import round_half_up
from martwright.operators.joins import hold
from martwright.operators.ranges import with_range

# Series quoted in percent, whose change is a difference.
RATE_SERIES = ["UNRATE", "FEDFUNDS"]


def previous_value(
    df: DataFrame,
    key: str,
    order_by: str | Sequence[str],
    value: str,
    name: str = "prev_value",
    ranges: int | None = None,
) -> DataFrame:
    """``lag(value)`` along each series, without a whole series in one task.

    Key and order are cut into ranges of like size wherever the rows are, so a series
    that holds most of them, or most of them at one time, is spread over many tasks. The
    first row of a range takes the last value of the nearest earlier range of its series,
    found among one row per series and range. Series and range are packed in a struct,
    in which NULL equals NULL, so the rows are joined as the window left them. ``df`` is
    read four times, three of them by few columns: ``hold`` it when it is costly.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    placed = with_range(df, [key, *order], "_range", ranges)
    grouped = placed.withColumn(
        "_stretch", F.struct(F.col(key).alias("key"), F.col("_range").alias("range"))
    ).drop("_range")
    inside = Window.partitionBy("_stretch").orderBy(*order)
    lagged = grouped.withColumns(
        {"_inside": F.lag(value).over(inside), "_place": F.row_number().over(inside)}
    )

    ordering = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    last = grouped.groupBy("_stretch").agg(F.max_by(value, ordering).alias("_last"))
    # No more rows than ranges: these are few however long the series is.
    along = Window.partitionBy("_stretch.key").orderBy("_stretch.range")
    carried = last.select("_stretch", F.lag("_last").over(along).alias("_carried"))

    first_in_stretch = F.col("_place") == 1
    return (
        lagged.join(carried, "_stretch", "left")
        .withColumn(name, F.when(first_in_stretch, F.col("_carried")).otherwise(F.col("_inside")))
        .drop("_stretch", "_inside", "_place", "_carried")
    )


def change(value: Column, previous: Column, is_rate: Column) -> Column:
    """Difference for rates, percent change otherwise; NULL without a usable previous value."""
    percent = F.try_divide(value - previous, previous) * 100
    return round_half_up(F.when(is_rate, value - previous).otherwise(percent), 2)


def with_change(series: DataFrame, rate_series: Sequence[str] = tuple(RATE_SERIES)) -> DataFrame:
    """Add ``prev_value`` and ``mom_change`` to a staged series table.

    Observations of one date follow each other in order of series and value.
    """
    order = ["observation_date", "series_id", "value"]
    lagged = previous_value(hold(series), "indicator_name", order, "value")
    is_rate = F.col("series_id").isin(*rate_series)
    return lagged.withColumn(
        "mom_change", change(F.col("value"), F.col("prev_value"), is_rate)
    )
