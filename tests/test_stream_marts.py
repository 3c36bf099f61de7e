"""The stream into the marts: every batch counts once, wherever it dies."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators.staging import stage_zones
from martwright.plans import trips
from martwright.schemas import TRIP_FILE
from martwright.sources.versions import read_refreshed
from martwright.streaming.marts import stream_to_marts
from tests.test_jobs import ZONES, breaks_contract, delivery, revenue

LAYOUT = T.StructType([T.StructField(f.name, T.StringType()) for f in TRIP_FILE])


def drop(spark, tmp_path, month, *rows):
    cells = delivery(spark, month, *rows)
    named = cells.select([F.col(f.name.upper()).alias(f.name) for f in LAYOUT])
    named.coalesce(1).write.parquet(f"{tmp_path}/drop/yellow_tripdata_{month}.parquet")


def stream(spark, tmp_path, **options):
    zones = stage_zones(spark.createDataFrame([("1.0", "EWR", "Newark", "EWR")], ZONES))
    folder = str(tmp_path / "marts")
    stream_to_marts(
        spark, f"{tmp_path}/drop", folder, f"{tmp_path}/state", zones, schema=LAYOUT, **options
    )
    return folder


def dies_after(marts_done):
    """Publishes so many marts, one more only up to its parts, and dies."""

    def publish(spark, tables, prepared, label):
        trips.publish_marts(spark, tables, prepared[:marts_done], label)
        for one in prepared[marts_done : marts_done + 1]:
            path = f"{tables.folder}/parts/{one.rollup.mart}"
            trips.replace_partition(one.parts, path, "source_month", label)
        raise RuntimeError("killed")

    return publish


@pytest.mark.parametrize("marts_done", [0, 2, 4])
def test_a_batch_that_dies_and_is_repeated_counts_once(spark, tmp_path, marts_done):
    drop(spark, tmp_path, "2025-11", ("2025-11-05", "10.0"), ("2025-12-01", "1.5"))
    folder = stream(spark, tmp_path)
    assert revenue(spark, folder) == [("2025-11-05", 1, 10.0), ("2025-12-01", 1, 1.5)]
    drop(spark, tmp_path, "2025-12", ("2025-12-01", "2.0"), ("2025-11-05", "4.0"), ("2025-12-02", "3.0"))
    with pytest.raises(Exception, match="killed"):
        stream(spark, tmp_path, publish=dies_after(marts_done))
    expected = [("2025-11-05", 2, 14.0), ("2025-12-01", 2, 3.5), ("2025-12-02", 1, 3.0)]
    for _ in range(2):
        stream(spark, tmp_path)
        assert revenue(spark, folder) == expected
    assert read_refreshed(spark, f"{folder}/mart_payment_summary").first().total_trips == 5
    assert read_refreshed(spark, f"{folder}/mart_pickup_zones").agg(F.sum("total_trips")).first()[0] == 5
    durations = spark.read.parquet(f"{folder}/mart_trip_duration")
    assert durations.agg(F.sum("total_trips")).first()[0] == 5


def test_a_batch_that_breaks_a_contract_changes_nothing(spark, tmp_path, monkeypatch):
    drop(spark, tmp_path, "2025-11", ("2025-11-05", "10.0"))
    folder = stream(spark, tmp_path)
    drop(spark, tmp_path, "2025-12", ("2025-12-01", "2.0"), ("2025-11-05", "4.0"))
    finish = trips.marts.payment_summary_of
    with monkeypatch.context() as patch:
        patch.setattr(trips.marts, "payment_summary_of", lambda parts: breaks_contract(finish(parts)))
        with pytest.raises(Exception, match="mart_payment_summary not_null total_trips"):
            stream(spark, tmp_path)
    assert revenue(spark, folder) == [("2025-11-05", 1, 10.0)]
    stream(spark, tmp_path)
    assert revenue(spark, folder) == [("2025-11-05", 2, 14.0), ("2025-12-01", 1, 2.0)]
