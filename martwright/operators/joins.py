"""Joins of facts to dimensions, and the checks built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.session import work_path


def hold(df: DataFrame) -> DataFrame:
    """Write a result that is used more than once to the shared folder and read it back.

    It survives lost executors, is read column by column, and from then on Spark
    knows its size.
    """
    path = work_path(df.sparkSession, "held")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str,
    *,
    held: bool = False,
) -> DataFrame:
    """Join facts to a table derived from other data, without shuffling the facts if it is small.

    Spark only guesses the size of an aggregate, and guesses high, so it would
    shuffle the facts. Held, the lookup has a known size: below the session's
    broadcast threshold it is broadcast; above it this is an ordinary shuffled
    join, where adaptive execution splits the hot keys. Pass ``held`` when the
    lookup is a stored table already.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return facts.join(lookup if held else hold(lookup), keys, how)


def _zone_columns(zones: DataFrame, side: str) -> DataFrame:
    return zones.select(
        F.col("location_id").alias(f"{side}_location_id"),
        F.col("borough").alias(f"{side}_borough"),
        F.col("zone").alias(f"{side}_zone"),
        F.col("service_zone").alias(f"{side}_service_zone"),
    )


def with_zones(
    trips: DataFrame, zones: DataFrame, sides: Sequence[str] = ("pickup", "dropoff")
) -> DataFrame:
    """Borough, zone and service zone of each named side; trips without a zone stay.

    A mart that reads only pickup columns should ask for that side alone: Spark
    does not know that zone keys are unique and would keep an unused join. The
    zone table is a stored file, so Spark's own size threshold decides on
    broadcasting it.
    """
    for side in sides:
        key = f"{side}_location_id"
        trips = trips.join(_zone_columns(zones, side), key, "left")
    return trips


def country_with_us(country_years: DataFrame, us_years: DataFrame) -> DataFrame:
    """Country rows with the US values of the same year, for every country."""
    return country_years.join(us_years, "observation_year", "left")


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is not in the parent; rows with a NULL key pass."""
    known = parent.select(F.col(parent_key).alias(key))
    return child.where(F.col(key).isNotNull()).join(known, key, "left_anti")


def count_unknown_keys(
    facts: DataFrame, keys: Sequence[str], parent: DataFrame, parent_key: str
) -> DataFrame:
    """Rows per key column whose value is not in the parent; NULL keys count as unknown.

    All key columns are checked in one scan of the facts.
    """
    flagged = facts.select(*keys)
    for key in keys:
        known = parent.select(F.col(parent_key).alias(key), F.lit(True).alias(f"{key}_known"))
        flagged = flagged.join(known.distinct(), key, "left")
    counts = flagged.agg(*[F.count_if(F.col(f"{key}_known").isNull()).alias(key) for key in keys])
    return counts.unpivot([], list(keys), "column_name", "n_unknown")


def keep_matching(df: DataFrame, chosen: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is among the chosen ones."""
    return df.join(chosen, on, "left_semi")
