"""Pick up newly landed trip files as a stream that stops when it has caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.schemas import TRIP_FILE
from martwright.sources.landing import month_in, stringify
from martwright.sources.sinks import read_if_exists

#: Files that one batch adds to a month at most.
FILES_PER_MONTH = 4


def new_files(
    spark: SparkSession, drop_folder: str, schema: T.StructType = TRIP_FILE, max_files: int = 1000
) -> DataFrame:
    """Stream of delivered rows as text, under the month that their file is named after.

    A file without a month in its name stops the stream.
    """
    files = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .parquet(drop_folder)
    )
    return stringify(files, month_in(F.col("_metadata.file_path")))


def land_new_files(
    spark: SparkSession,
    drop_folder: str,
    table: str,
    checkpoint: str,
    schema: T.StructType = TRIP_FILE,
    max_files: int = 1000,
) -> int:
    """Append files not seen before to the text table; returns the rows it gained.

    The checkpoint remembers the files and the sink's own log the finished
    batches, so a run that is killed and repeated adds every row once. Rows of a month
    are spread over a few tasks by their content: a batch adds few files, and a month
    that holds most of it is not one task's.
    """
    before = _rows(spark, table)
    rows = new_files(spark, drop_folder, schema, max_files)
    share = F.pmod(F.xxhash64(*rows.columns), F.lit(FILES_PER_MONTH))
    query = (
        rows.repartition("SOURCE_MONTH", share)
        .writeStream.format("parquet")
        .partitionBy("SOURCE_MONTH")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _rows(spark, table) - before


def _rows(spark: SparkSession, table: str) -> int:
    stored = read_if_exists(spark, table)
    return 0 if stored is None else stored.count()
