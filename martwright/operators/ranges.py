"""Ranges of rows in some order, cut where the data are, so that each holds a like share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.operators.joins import hold

#: Ranges for each shuffle partition of the session, and sampled rows for each range.
RANGES_PER_PARTITION = 4
SAMPLED_PER_RANGE = 20


def place_among(df: DataFrame, cuts: str, at: Column, most: int, name: str) -> DataFrame:
    """Add ``name``: how many of the ascending ``cuts`` are below or at ``at``.

    ``cuts`` is an array column of at most ``most`` values. The search halves what is
    left at every step, so thousands of cuts cost a dozen comparisons, in generated code.
    """
    df = df.withColumn(name, F.lit(0))
    for power in reversed(range(max(1, most).bit_length())):
        step = 1 << power
        reached = F.get(F.col(cuts), F.col(name) + F.lit(step - 1)) <= at
        df = df.withColumn(name, F.col(name) + F.when(reached, step).otherwise(0))
    return df


def with_range(
    df: DataFrame, order: Sequence[str], name: str, ranges: int | None = None
) -> DataFrame:
    """Add ``name``: the number of the range of ``order`` that a row falls into.

    The cuts come from a sample, so a stretch that holds most of the rows is cut
    most often; rows equal in all of ``order`` stay together. NULL comes first, as in a
    window. The cuts are held: a task that runs again places its rows alike. ``df`` is
    read twice more for them, by the columns of ``order`` alone.
    """
    spark = df.sparkSession
    if ranges is None:
        ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = F.struct(*order)
    keys = df.select(at.alias("at"))
    share = min(1.0, ranges * SAMPLED_PER_RANGE / max(1, keys.count()))
    sampled = keys if share == 1 else keys.sample(fraction=share, seed=0)
    # Bounded by the ranges, as Spark's own range exchange samples on its driver.
    sorted_keys = sampled.agg(F.array_sort(F.collect_list("at")).alias("keys"))
    step = F.greatest(F.lit(1), F.ceil(F.size("keys") / F.lit(ranges)))
    every = F.filter("keys", lambda _, place: F.pmod(place, step) == step - 1)
    cuts = hold(sorted_keys.select(F.array_distinct(every).alias("cuts")))
    placed = place_among(df.withColumn("_cuts", cuts.scalar()), "_cuts", at, ranges, name)
    return placed.drop("_cuts")
