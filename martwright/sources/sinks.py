"""Table writers. Each fails the job when the write does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.schemas import RUN_LOG
from martwright.sources.versions import full_refresh, read_refreshed  # noqa: F401


def read_if_exists(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table at ``path``, or None before its first load."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _file_per_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring each partition's rows together before writing, so not every task writes all of them.

    Adaptive execution splits a partition that holds most of the rows and joins
    the small ones.
    """
    return df.hint("rebalance", *[F.col(name) for name in columns])


def append_partitioned(df: DataFrame, path: str, by: str = "SOURCE_MONTH") -> None:
    _file_per_partition(df, [by]).write.mode("append").partitionBy(by).parquet(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    by: str | Sequence[str],
    *,
    sort_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Overwrite only the partitions present in ``df``; safe to run again.

    ``sort_by`` orders the rows of each file, which readers can skip by.
    """
    columns = [by] if isinstance(by, str) else list(by)
    rows = _file_per_partition(df, columns) if rebalance else df
    if sort_by:
        rows = rows.sortWithinPartitions(*columns, *sort_by)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def replace_partition(df: DataFrame, path: str, by: str, value: str) -> None:
    """Overwrite one partition with the rows of ``df`` that belong to it, also with none."""
    rows = df.where(F.col(by) == value).drop(by)
    rows.write.mode("overwrite").parquet(f"{path}/{by}={value}")


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_month(
    df: DataFrame,
    path: str,
    month: str,
    by: str = "SOURCE_MONTH",
    then_by: Sequence[str] = (),
    *,
    replace: bool = False,
) -> bool:
    """Write one month unless the table already has it; True when written.

    The look-up prunes to the month's partition and stops at its first row. The
    write replaces that partition, so a load that died halfway can be repeated.
    With ``replace`` a month that is there gives way to the new delivery, even an
    empty one.
    """
    spark = df.sparkSession
    if replace and not then_by:
        replace_partition(df, path, by, month)
        return True
    loaded = read_if_exists(spark, path)
    if loaded is not None and not loaded.where(F.col(by) == month).isEmpty():
        return False
    rows = df.where(F.col(by) == month)
    replace_partitions(rows, path, [by, *then_by], rebalance=bool(then_by))
    return True


def log_run(
    spark: SparkSession,
    path: str,
    *,
    run_id: str,
    month: str,
    status: str,
    task: str,
    message: str,
) -> None:
    """Append one row to the run log."""
    values = (run_id, month, status, task, message)
    row = spark.range(1).select(
        [F.lit(value).alias(name) for name, value in zip(RUN_LOG.names, values, strict=True)]
    )
    row.coalesce(1).write.mode("append").parquet(path)


def publish(df: DataFrame, name: str, layer: str, folder: str) -> DataFrame:
    """Staging and intermediate layers become views, marts become tables."""
    if layer in ("staging", "intermediate"):
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    path = f"{folder}/{layer}/{name}"
    overwrite(df, path)
    return df.sparkSession.read.parquet(path)
