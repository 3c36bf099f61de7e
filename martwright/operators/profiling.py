"""Column profiles, each one pass over the table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.measures import exact_sum, plain_mean, ratio_of, round_half_up, value_of
from martwright.operators.quantiles import exact_quantiles


def null_shares(df: DataFrame) -> DataFrame:
    """Type of every column and its percent of NULL cells."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count(name).alias(name) for name in df.columns]
    )
    shares = counts.select(
        [
            round_half_up(ratio_of((F.col("_rows") - F.col(name)) * 100, F.col("_rows")), 2).alias(name)
            for name in df.columns
        ]
    )
    long = shares.unpivot([], df.columns, "column_name", "null_percentage")
    types = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    return long.select(
        "column_name", types[F.col("column_name")].alias("column_type"), "null_percentage"
    )


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each column, in one row."""
    bounds = [[F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")] for c in columns]
    return df.agg(*[bound for pair in bounds for bound in pair])


def anomaly_counts(trips: DataFrame) -> DataFrame:
    """Rows with impossible times, fares, distances or passenger counts."""
    passengers = F.col("passenger_count")
    return trips.agg(
        F.count_if(F.col("pickup_datetime") >= F.col("dropoff_datetime")).alias("bad_times"),
        F.count_if(F.col("fare_amount") <= 0).alias("bad_fares"),
        F.count_if(F.col("trip_distance") <= 0).alias("bad_distances"),
        F.count_if((passengers <= 0) | (passengers > 6)).alias("bad_passengers"),
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, NULL left out."""
    texts = df.select([F.col(name).cast("string").alias(name) for name in columns])
    return (
        texts.unpivot([], list(columns), "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n_rows"))
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column.

    NULL and NaN stay out; a column without other values has no row.
    """
    measures = df.select(
        [F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")).alias(name) for name in columns]
    )
    long = measures.unpivot([], list(columns), "measure", "amount")
    quartiles = exact_quantiles(long, ["measure"], "amount", {"q25": 0.25, "q50": 0.5, "q75": 0.75})

    def told(**aggregates: Callable[[str], Column]) -> Column:
        """One row per column from one row of aggregates."""
        lines = [
            F.struct(F.lit(c).alias("measure"), *[F.col(f"{name}_{c}").alias(name) for name in aggregates])
            for c in columns
        ]
        return F.inline(F.array(*lines))

    first = {"n_rows": F.count, "min": F.min, "max": F.max, "mean": plain_mean}
    totals = measures.agg(*[f(c).alias(f"{name}_{c}") for name, f in first.items() for c in columns]).first()
    # Squares are taken around the mean, so that they keep their digits.
    second = {
        **{name: (lambda c, name=name: F.lit(totals[f"{name}_{c}"])) for name in first},
        "squares": lambda c: value_of(exact_sum(F.pow(F.col(c) - F.lit(totals[f"mean_{c}"]).cast("double"), 2))),
    }
    kinds = {"n_rows": "long", "min": "double", "max": "double", "mean": "double", "squares": "double"}
    moments = measures.agg(
        *[f(c).cast(kinds[name]).alias(f"{name}_{c}") for name, f in second.items() for c in columns]
    ).select(told(**second))
    deviation = F.sqrt(F.try_divide(F.col("squares"), F.col("n_rows") - 1))
    return moments.join(quartiles, "measure").select(
        "measure",
        "n_rows",
        round_half_up(F.col("mean"), 4).alias("mean"),
        round_half_up(deviation, 4).alias("std"),
        "min",
        *[round_half_up(F.col(name), 4).alias(name) for name in ("q25", "q50", "q75")],
        "max",
    )


def shape(df: DataFrame, key: str) -> DataFrame:
    """Rows, columns, distinct keys and whether any cell is NULL."""
    any_null = F.lit(False)
    for name in df.columns:
        any_null = any_null | F.col(name).isNull()
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.count_distinct(key).alias("n_distinct"),
        F.coalesce(F.bool_or(any_null), F.lit(False)).alias("any_null"),
    )


def load_report(
    trips: DataFrame, dimension: DataFrame, *, month: str = "source_month"
) -> DataFrame:
    """Rows in total, per month and in the dimension."""
    months = trips.groupBy(F.col(month).alias("item")).agg(F.count("*").alias("n_rows"))
    total = months.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    size = dimension.agg(F.count("*").alias("n_rows"))

    def section(name: str, df: DataFrame, item) -> DataFrame:
        return df.select(F.lit(name).alias("section"), item.alias("item"), "n_rows")

    return (
        section("total", total, F.lit("trips"))
        .unionByName(section("month", months, F.col("item")))
        .unionByName(section("dimension", size, F.lit("zones")))
    )


def first_rows(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """A stable sample: the first ``n`` rows in order."""
    return df.orderBy(*order_by).limit(n)
