import os
from datetime import date, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martwright.sources import documents, files, landing, sinks
from martwright.streaming.landing import land_new_files

NAMES = {"GDP": "GDP (Billions USD)", "UNRATE": "Unemployment Rate"}


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_zone_csv(spark, tmp_path):
    text = 'LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n264,N/A,,N/A\n'
    write(tmp_path, "zones.csv", text)
    df = files.read_zones_csv(spark, str(tmp_path / "zones.csv"))
    assert df.columns == ["LOCATIONID", "BOROUGH", "ZONE", "SERVICE_ZONE"]
    assert df.orderBy("LOCATIONID").collect() == [
        ("1", "EWR", "Newark, Airport", "EWR"),
        ("264", None, None, None),
    ]


def test_series_documents(spark, tmp_path):
    pretty = """{
      "count": 3,
      "observations": [
        {"date": "2025-01-01", "value": "3.5"},
        {"date": "2025-02-01", "value": "."},
        {"date": "2025-03-01", "value": "nan"}
      ]
    }"""
    write(tmp_path, "series_id=GDP/page.json", pretty)
    write(tmp_path, "series_id=UNRATE/page.json", '{"observations": []}')
    rows = documents.read_series(spark, str(tmp_path), NAMES).orderBy("date").collect()
    assert rows == [
        (date(2025, 1, 1), 3.5, "GDP (Billions USD)", "GDP"),
        (date(2025, 2, 1), None, "GDP (Billions USD)", "GDP"),
        (date(2025, 3, 1), None, "GDP (Billions USD)", "GDP"),
    ]


def test_strict_series_documents(spark, tmp_path):
    good = '{"observations":[{"date":"2025-01-01","value":"."},{"date":"2025-02-01","value":"2"}]}'
    write(tmp_path, "good/series_id=GDP/page.json", good)
    rows = documents.read_series_strict(spark, str(tmp_path / "good"), NAMES)
    assert [row.value for row in rows.orderBy("date").collect()] == [None, 2.0]
    bad = '{"observations":[{"date":"2025-01-01","value":"withheld"}]}'
    write(tmp_path, "bad/series_id=GDP/page.json", bad)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        documents.read_series_strict(spark, str(tmp_path / "bad"), NAMES).collect()


WHOLE = '{"observations":[{"date":"2025-01-01","value":"1.5"},{"date":"2025-02-01","value":"2"}]}'
BROKEN = {
    "cut": (WHOLE[: len(WHOLE) // 2], "not a whole JSON document"),
    "late": (WHOLE[:-1], "not a whole JSON document"),
    "html": ("<html>busy</html>", "not a whole JSON document"),
    "empty": ("", "empty"),
    "blank": (" \n", "empty"),
    "error": ('{"error_code": 400, "error_message": "Bad Request"}', "no observations"),
    "other": ('{"observations": "none"}', "not a whole JSON document"),
}


@pytest.mark.parametrize("name", BROKEN)
def test_an_unreadable_series_document_is_told_and_stops_the_load(spark, tmp_path, name):
    text, reason = BROKEN[name]
    write(tmp_path, "series_id=GDP/1.json", WHOLE)
    write(tmp_path, f"series_id=GDP/{name}.json", text)
    write(tmp_path, "series_id=UNRATE/3.json", WHOLE)
    told = documents.rejected(documents.series_documents(spark, str(tmp_path))).collect()
    assert [(r.source_id, r.file_path.rsplit("/", 1)[1], r.reason) for r in told] == [("GDP", f"{name}.json", reason)]
    for read in (documents.read_series, documents.read_series_strict):
        with pytest.raises(Exception, match=f"{name}.json: {reason}"):
            read(spark, str(tmp_path), NAMES).collect()
    assert documents.read_series(spark, str(tmp_path), NAMES, skip=True).count() == 4
    with pytest.raises(documents.UnreadableDocuments, match=f"{name}.json: {reason}"):
        documents.refuse_rejected(documents.series_documents(spark, str(tmp_path)))


def test_unreadable_country_documents(spark, tmp_path):
    row = '{"countryiso3code":"DEU","country":{"id":"DE","value":"Germany"},"date":"2020","value":3.8}'
    whole = f'[{{"page": 1}}, [{row}]]'
    for name, text in {
        "whole": whole, "cut": whole[:60], "empty": "", "list": '[{"message": []}]', "none": '[{"page": 0}, null]',
        "object": '{"message": "bad"}', "odd": '[{"page": 1}, "busy"]',
    }.items():
        write(tmp_path, f"indicator_id=X/{name}.json", text)
    read = documents.country_documents(spark, str(tmp_path))
    told = {r.file_path.rsplit("/", 1)[1]: r.reason for r in documents.rejected(read).collect()}
    assert told == {
        "cut.json": "not a whole JSON document", "empty.json": "empty", "odd.json": "rows of another layout"
    }
    with pytest.raises(Exception, match="json: "):
        documents.read_country_indicators(spark, str(tmp_path), {"X": "x"}).collect()
    assert documents.read_country_indicators(spark, str(tmp_path), {"X": "x"}, skip=True).count() == 1


def test_country_documents(spark, tmp_path):
    rows = """[{"page": 1},
      [{"country": {"id": "DE", "value": "Germany"}, "countryiso3code": "DEU",
        "date": "2020", "value": 3.8},
       {"country": {"id": "DE", "value": "Germany"}, "countryiso3code": "DEU",
        "date": "2021", "value": null}]]"""
    write(tmp_path, "indicator_id=SL.UEM/deu.json", rows)
    write(tmp_path, "indicator_id=SL.UEM/error.json", '[{"message": "bad"}]')
    write(tmp_path, "indicator_id=007/none.json", '[{"page": 0}, null]')
    df = documents.read_country_indicators(spark, str(tmp_path), {"SL.UEM": "unemployment"})
    assert df.collect() == [("DEU", "Germany", "SL.UEM", "unemployment", 2020, 3.8)]


def test_stringify(spark):
    df = spark.createDataFrame(
        [(1.0, float("nan"), None), (2.5, 3.0, "None")], "VendorID double, Fare double, Flag string"
    )
    raw = landing.stringify(df, "2025-11")
    assert raw.columns == ["VENDORID", "FARE", "FLAG", "SOURCE_MONTH"]
    assert raw.collect() == [("1.0", None, None, "2025-11"), ("2.5", "3.0", None, "2025-11")]


@pytest.mark.parametrize("wanted, expected", [(50, 50), (999, 999), (1000, 1000), (5000, 1000)])
def test_sample_size_and_month(spark, wanted, expected):
    df = months(spark, m2025_11=1000, m2025_12=300)
    sample = files.sample_month(df, "m2025-11", wanted, seed=3)
    assert sample.count() == expected == sample.select("id").distinct().count()
    assert {r[0] for r in sample.select("SOURCE_MONTH").distinct().collect()} == {"m2025-11"}


def test_sample_is_spread_over_the_month(spark):
    ids = [r.id for r in files.sample_month(months(spark, m2025_11=10_000), "m2025-11", 400).collect()]
    assert 4000 < sum(ids) / len(ids) < 6000


def test_month_bounds():
    assert files.month_bounds("2025-12") == (date(2025, 12, 1), date(2026, 1, 1))


def months(spark, **counts):
    frames = [
        spark.range(n).select("id", F.lit(name.replace("_", "-")).alias("SOURCE_MONTH"))
        for name, n in counts.items()
    ]
    df = frames[0]
    for more in frames[1:]:
        df = df.unionByName(more)
    return df


def month_counts(spark, path):
    df = spark.read.schema("id long, SOURCE_MONTH string").parquet(path)
    return dict(df.groupBy("SOURCE_MONTH").count().collect())


def test_load_month_skips_what_is_there(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert sinks.load_month(months(spark, m2025_11=3), path, "m2025-11")
    assert not sinks.load_month(months(spark, m2025_11=5), path, "m2025-11")
    assert sinks.load_month(months(spark, m2025_11=5, m2025_12=2), path, "m2025-12")
    assert month_counts(spark, path) == {"m2025-11": 3, "m2025-12": 2}


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.append_partitioned(months(spark, m2025_11=3, m2025_12=1), path)
    sinks.append_partitioned(months(spark, m2025_11=2), path)
    assert month_counts(spark, path) == {"m2025-11": 5, "m2025-12": 1}
    sinks.replace_partitions(months(spark, m2025_11=4), path, "SOURCE_MONTH")
    assert month_counts(spark, path) == {"m2025-11": 4, "m2025-12": 1}


def test_rebalanced_write_makes_few_files(spark, tmp_path):
    path = str(tmp_path / "raw")
    many = spark.range(0, 8000, 1, 8).select("id", (F.col("id") % 10).cast("string").alias("SOURCE_MONTH"))
    sinks.append_partitioned(many, path)
    parts = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(parts) == 10


def test_publish_layers(spark, tmp_path):
    view = sinks.publish(spark.range(3), "staged_numbers", "staging", str(tmp_path))
    table = sinks.publish(view, "numbers", "mart", str(tmp_path))
    assert spark.table("staged_numbers").count() == 3
    assert table.count() == 3 and os.path.isdir(tmp_path / "mart" / "numbers")


def test_stream_reads_each_file_once_under_its_own_month(spark, tmp_path):
    drop, table, state = (str(tmp_path / name) for name in ("drop", "table", "state"))
    # All pickups are stray: no row has the month of its file.
    rows = spark.range(10).select("id", F.lit("2025-11-03").cast("timestamp_ntz").alias("at"))

    def land():
        return land_new_files(spark, drop, table, state, rows.schema)

    rows.repartition(3).write.parquet(f"{drop}/yellow_tripdata_2025-12.parquet")
    assert land() == 10
    assert land() == 0
    rows.coalesce(1).write.parquet(f"{drop}/2024-07/yellow_tripdata_2026-01.parquet")
    assert land() == 10
    stored = spark.read.parquet(table)
    assert stored.count() == 20
    assert set(stored.columns) == {"ID", "AT", "SOURCE_MONTH"}
    assert dict(stored.groupBy("SOURCE_MONTH").count().collect()) == {"2025-12": 10, "2026-01": 10}
    files = list((tmp_path / "table" / "SOURCE_MONTH=2025-12").glob("*.parquet"))
    assert len(files) <= 4


def test_stream_stops_at_a_file_without_a_month(spark, tmp_path):
    drop, table, state = (str(tmp_path / name) for name in ("drop", "table", "state"))
    rows = spark.range(3).select("id")
    rows.write.parquet(f"{drop}/trips_202511.parquet")
    with pytest.raises(Exception, match="no month in the name of"):
        land_new_files(spark, drop, table, state, rows.schema)


@pytest.mark.parametrize(
    "path, month",
    [
        ("/data/yellow_tripdata_2025-11.parquet", "2025-11"),
        ("/data/2024-01/yellow_tripdata_2025-12.parquet/part-00000.parquet", "2025-12"),
        ("/data/2024-01-31/trips", "2024-01"),
    ],
)
def test_month_of_a_name(path, month):
    assert landing.month_named(path) == month
    with pytest.raises(ValueError):
        landing.month_named("/data/trips_202511.parquet")


def test_random_ids_in_file_names_are_no_months(spark, tmp_path):
    ids = ["3b1f0c9e-1998-41ab-9a3e-0c1d2e3f4a5b", "aabb1998-12cd-4e5f-8a9b-0c1d2e3f4a5b", "0a1b2c3d-4e5f-4711-2001-07abcdef0123"]
    drop, table, state = (str(tmp_path / name) for name in ("drop", "table", "state"))
    rows = spark.range(3).select("id")
    for number, found in enumerate(ids):
        folder = tmp_path / "drop" / f"trips_2025-1{number}.parquet"
        folder.mkdir(parents=True)
        file = folder / f"part-00000-{found}-c000.snappy.parquet"
        pq.write_table(pa.table({"id": [1, 2, 3]}), file)
        assert landing.month_named(str(file)) == f"2025-1{number}"
    assert land_new_files(spark, drop, table, state, rows.schema) == 9
    stored = spark.read.parquet(table).groupBy("SOURCE_MONTH").count()
    assert dict(stored.collect()) == {"2025-10": 3, "2025-11": 3, "2025-12": 3}
    pq.write_table(pa.table({"id": [1]}), tmp_path / "drop" / f"trips-{ids[2]}.parquet")
    with pytest.raises(Exception, match="no month in the name of"):
        land_new_files(spark, drop, table, state, rows.schema)


def test_bounds_of_whole_numbers_come_from_the_footers(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(0, 1000, 1, 4).select(
        "id", (F.col("id") % 7).cast("int").alias("n"), F.date_add(F.lit(date(2025, 1, 1)), F.col("id").cast("int")).alias("day"),
        F.when(F.col("id") == 5, float("nan")).otherwise(F.col("id") / 2).alias("v"),
    ).write.parquet(path)
    layout = spark.read.parquet(path).schema
    with files.footer_aggregates(spark):
        df = spark.read.schema(layout).parquet(path).agg(*files._bounds(["id", "n", "day"]))
        text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(n), MAX(n), MIN(day), MAX(day)]" in text
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    row = files.profile_files(spark, path, layout, ["v", "id", "day"]).first()
    assert (row.n_rows, row.min_id, row.max_id, row.min_v) == (1000, 0, 999, 0.0)
    assert row.max_day == date(2025, 1, 1) + timedelta(days=999) and row.max_v != row.max_v
    assert files.profile_files(spark, path, layout, []).collect() == [(1000,)]


def test_files_without_bounds_are_scanned(spark, tmp_path):
    pq.write_table(pa.table({"id": list(range(50))}), str(tmp_path / "plain.parquet"), write_statistics=False)
    layout = spark.read.parquet(str(tmp_path)).schema
    row = files.profile_files(spark, str(tmp_path), layout, ["id"]).first()
    assert tuple(row) == (50, 0, 49)
