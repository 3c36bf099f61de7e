"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from martwright.session import work_path

BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, unless the user chose a size."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, None) in (None, "10000"):
        spark.conf.set(name, BATCH_ROWS)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """``df`` with every Arrow batch passed through ``function``."""
    small_batches(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(each, schema)


def texts_of(column: pa.Array) -> list[str]:
    """The texts of an Arrow column, null as empty."""
    return pc.fill_null(column, "").to_pylist()


def record_batch(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(columns[field.name], field.type) for field in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def stored(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut.

    What was shuffled for it is no longer needed then and leaves the executors' disks.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(schema or df.schema).parquet(path)
