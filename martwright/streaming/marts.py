"""New trip files straight into the marts, each batch once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators.joins import hold
from martwright.operators.quality import suite_passed
from martwright.plans.audit import AuditFailed
from martwright.plans.trips import (
    Prepared,
    TripSettings,
    TripTables,
    drop_prepared,
    mart_report,
    prepare_marts,
    publish_marts,
    staged_trips,
)
from martwright.schemas import TRIP_FILE
from martwright.session import tune, work_scope
from martwright.streaming.landing import new_files

Publish = Callable[[SparkSession, TripTables, Sequence[Prepared], str], None]


def stream_to_marts(
    spark: SparkSession,
    drop_folder: str,
    folder: str,
    checkpoint: str,
    zones: DataFrame,
    settings: TripSettings | None = None,
    *,
    name: str = "stream",
    schema: T.StructType = TRIP_FILE,
    max_files: int = 1000,
    publish: Publish = publish_marts,
) -> None:
    """Bring the marts up to date with files not seen before, and stop when caught up.

    A batch stores its parts under its own number, in place of those that the same
    batch left when it died, and recomputes the days it touches from all parts. So a
    batch that Spark replays counts once, wherever it broke off: before its parts, between
    two marts or before the checkpoint knew that it was done. ``name`` goes with the
    checkpoint: two streams into one folder need two names. A batch whose marts would
    break their contracts stops the stream and changes nothing.
    """
    tune(spark)
    settings = settings or TripSettings()
    tables = TripTables(folder)

    def build(batch: DataFrame, number: int) -> None:
        label = f"{name}-{number:09d}"
        with work_scope(spark):
            typed = staged_trips(batch, settings).withColumn("source_month", F.lit(label))
            prepared = prepare_marts(spark, tables, hold(typed), zones, label, settings)
            report = mart_report(prepared)
            if not suite_passed(report):
                lines = report.collect()
                drop_prepared(prepared)
                raise AuditFailed(lines)
            publish(spark, tables, prepared, label)

    query = (
        new_files(spark, drop_folder, schema, max_files)
        .writeStream.foreachBatch(build)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
