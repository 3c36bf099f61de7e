"""Incremental upkeep: watermarks, keyed upsert and recompute of touched keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.operators.joins import hold, lookup_join
from martwright.sources import versions
from martwright.sources.sinks import (
    overwrite,
    read_if_exists,
    replace_partition,
    replace_partitions,
)

APPLIED = "applied"


def newer_months(df: DataFrame, day: str, target: DataFrame, target_day: str) -> DataFrame:
    """Rows of months after the target's last one; all rows while the target is empty.

    The watermark is one value, read up front so that it prunes partitions and
    row groups. Late rows of earlier months are not picked up: see
    ``recompute_touched``.
    """
    last = target.agg(F.max(F.trunc(target_day, "MM")).alias("last_month")).first()[0]
    if last is None:
        return df
    return df.where(F.col(day) >= F.add_months(F.lit(last), 1).cast(df.schema[day].dataType))


def unloaded_months(batch: DataFrame, target: DataFrame, month: str = "source_month") -> DataFrame:
    """Rows of months the target does not hold yet."""
    return lookup_join(batch, target.select(month).distinct(), month, "left_anti")


def after_watermark(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    at: str,
    default: Column,
    *,
    inclusive: bool,
) -> DataFrame:
    """Rows at or after each key's newest loaded value, ``default`` for a new key.

    ``inclusive`` reads the newest loaded row again, to pick up its revision.
    """
    newest = target.groupBy(*keys).agg(F.max(at).alias("_newest"))
    joined = lookup_join(batch, newest, keys, "left")
    floor = F.coalesce(F.col("_newest"), default)
    kept = F.col(at) >= floor if inclusive else F.col(at) > floor
    return joined.where(kept).select(batch.columns)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def upsert(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], touched: DataFrame | None = None
) -> DataFrame:
    """The target with changed keys replaced and new keys added.

    Keys of ``touched`` that ``changes`` no longer has are removed. ``changes`` is read
    twice; ``hold`` it first when it is costly to build.
    """
    gone = (changes if touched is None else touched).select(*keys)
    kept = lookup_join(target, gone, list(keys), "left_anti")
    return kept.select(changes.columns).unionByName(changes)


def only_partitions_of(df: DataFrame, chosen: DataFrame, partition: str) -> DataFrame:
    """Rows of the partitions named in ``chosen``.

    Partition values are few by design, so they are read up front and become
    literals that prune the scan.
    """
    values = [row[0] for row in chosen.select(partition).distinct().collect()]
    return df.where(F.col(partition).isin(values))


def recompute_touched(
    touched: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    build: Callable[[DataFrame], DataFrame],
    *,
    partition: str | None = None,
) -> DataFrame:
    """Mart rows of every key in ``touched``, built from all facts of those keys.

    Right for late rows and stray dates, and the same when run twice. Name the
    ``partition`` column of the facts, also present in ``touched``, to read only
    the partitions that hold such keys.
    """
    if partition is not None:
        facts = only_partitions_of(facts, touched, partition)
    chosen = touched.select(*keys).distinct()
    return build(lookup_join(facts, chosen, list(keys), "left_semi"))


def merge_into(
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    partition: str,
    staging: str,
    touched: DataFrame | None = None,
) -> None:
    """Upsert into a partitioned parquet table, rewriting only the touched partitions.

    ``partition`` must follow from the keys, so a key never moves. ``touched`` may name
    more keys and their partitions: those without a change lose their row. The merged
    partitions are complete in ``staging`` before the table is touched. A job
    that dies while moving them loses nothing: the next merge moves them first.
    """
    spark = changes.sparkSession
    changes = hold(changes)
    repeated = repeated_keys(changes, keys).first()
    if repeated is not None:
        raise ValueError(f"key occurs more than once in the batch: {repeated.asDict()}")
    finish_merge(spark, path, keys, partition, staging)
    target = read_if_exists(spark, path)
    if target is None:
        replace_partitions(changes, path, partition, sort_by=keys)
        return
    named = changes if touched is None else touched
    version = versions.latest_version(spark, staging)
    merged = upsert(only_partitions_of(target, named, partition), changes, keys, touched)
    candidate = versions.stage(merged, staging)
    partitions = f"{candidate.folder}_partitions"
    overwrite(named.select(partition).distinct(), f"{staging}/{partitions}")
    # Of two merges into one table the second fails here, before the table is touched.
    versions.commit(candidate, version, extra={"partitions": partitions})
    finish_merge(spark, path, keys, partition, staging)


def finish_merge(
    spark: SparkSession, path: str, keys: Sequence[str], partition: str, staging: str
) -> None:
    """Move fully staged partitions into the table unless that has been done.

    A partition left without rows is emptied.
    """
    staged = versions.latest_entry(spark, staging)
    if staged is None or staged.version <= versions.latest_version(spark, staging, APPLIED):
        return
    rows = versions.read_refreshed(spark, staging)
    replace_partitions(rows, path, partition, sort_by=keys)
    wanted = spark.read.schema(rows.select(partition).schema).parquet(f"{staging}/{staged.extra['partitions']}")
    empty = wanted.join(rows.select(partition).distinct(), partition, "left_anti")
    for row in empty.where(F.col(partition).isNotNull()).collect():
        replace_partition(rows, path, partition, str(row[0]))
    versions.add_entry(spark, staging, staged.version, APPLIED)
    # Nobody reads the staging area but merges: only the newest version stays.
    versions.expire(spark, staging, timedelta(0))
