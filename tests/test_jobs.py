"""The end-to-end jobs on small made-up deliveries."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators import quality
from martwright.plans import contracts, indicators, snapshot, trips
from martwright.plans.audit import AuditFailed
from martwright.schemas import TRIP_FILE
from martwright.sources.documents import UnreadableDocuments
from martwright.sources.versions import read_refreshed
from tests.test_sources import write
from tests.test_staging import raw_trips

CHECKS = contracts.raw_trip_suite(rows=(1, 1000))
ZONES = "LOCATIONID string, BOROUGH string, ZONE string, SERVICE_ZONE string"


def delivery(spark, month, *rows):
    cells = [
        {
            "TPEP_PICKUP_DATETIME": f"{day} 10:00:00",
            "TPEP_DROPOFF_DATETIME": f"{day} 10:10:00",
            "FARE_AMOUNT": fare,
            "TOTAL_AMOUNT": fare,
            "SOURCE_MONTH": month,
        }
        for day, fare in rows
    ]
    return raw_trips(spark, *cells)


def run(spark, folder, raw, month, run_id, checks=CHECKS):
    zones = spark.createDataFrame([("1.0", "EWR", "Newark", "EWR")], ZONES)
    return trips.run_month(spark, raw, zones, folder, month, run_id, checks)


def revenue(spark, folder):
    mart = spark.read.parquet(f"{folder}/mart_daily_revenue")
    return sorted((str(r.pickup_date), r.total_trips, r.total_revenue) for r in mart.collect())


def log(spark, folder):
    rows = spark.read.parquet(f"{folder}/run_log").collect()
    return sorted((r.run_id, r.task_name, r.status) for r in rows)


def test_late_and_stray_rows_end_up_right_and_reruns_change_nothing(spark, tmp_path):
    folder = str(tmp_path)
    first = delivery(spark, "2025-11", ("2025-11-05", "10.0"), ("2025-12-01", "1.5"))
    second = delivery(
        spark, "2025-12", ("2025-12-01", "2.0"), ("2025-12-02", "3.0"), ("2025-11-05", "4.0")
    )
    assert run(spark, folder, first, "2025-11", "r1")
    assert revenue(spark, folder) == [("2025-11-05", 1, 10.0), ("2025-12-01", 1, 1.5)]
    expected = [("2025-11-05", 2, 14.0), ("2025-12-01", 2, 3.5), ("2025-12-02", 1, 3.0)]
    for run_id in ("r2", "r3"):
        assert run(spark, folder, second, "2025-12", run_id)
        assert revenue(spark, folder) == expected
    payments = read_refreshed(spark, f"{folder}/mart_payment_summary").first()
    assert (payments.total_trips, payments.total_revenue) == (5, 20.5)
    zones = read_refreshed(spark, f"{folder}/mart_pickup_zones").first()
    assert (zones.pickup_zone, zones.hour_of_day, zones.total_trips) == ("Newark", 10, 5)
    durations = spark.read.parquet(f"{folder}/mart_trip_duration").collect()
    assert {r.median_duration_minutes for r in durations} == {10.0}
    assert [line[1:] for line in log(spark, folder)] == [("run_complete", "SUCCESS")] * 3


def test_delivered_files_land_under_their_own_month(spark, tmp_path):
    folder = str(tmp_path / "tables")
    layout = T.StructType([T.StructField(f.name, T.StringType()) for f in TRIP_FILE])
    names = dict(zip([f.name.upper() for f in layout], layout.names))
    rows = delivery(spark, "2025-11", ("2025-11-05", "10.0"), ("2025-12-01", "1.5")).drop("SOURCE_MONTH")
    path = f"{tmp_path}/yellow_tripdata_2025-11.parquet"
    rows.select([F.col(upper).alias(name) for upper, name in names.items()]).write.parquet(path)
    write(tmp_path, "zones.csv", "LocationID,Borough,Zone,service_zone\n1,EWR,Newark,EWR\n")
    assert trips.land_month_file(spark, path, folder, schema=layout)
    assert not trips.land_month_file(spark, path, folder, schema=layout)
    trips.land_zone_file(spark, f"{tmp_path}/zones.csv", folder)
    told = {(r.section, r.item): r.n_rows for r in trips.landed_report(spark, folder).collect()}
    assert told == {("total", "trips"): 2, ("month", "2025-11"): 2, ("dimension", "zones"): 1}
    assert trips.run_delivery(spark, path, f"{tmp_path}/zones.csv", folder, "r1", CHECKS, schema=layout)
    assert revenue(spark, folder) == [("2025-11-05", 1, 10.0), ("2025-12-01", 1, 1.5)]


def breaks_contract(df):
    return df.withColumn("total_trips", F.lit(None).cast("long"))


def test_marts_that_break_their_contract_are_not_published(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    assert run(spark, folder, delivery(spark, "2025-11", ("2025-11-05", "10.0")), "2025-11", "r1")
    second = delivery(spark, "2025-12", ("2025-12-05", "3.0"), ("2025-11-05", "1.0"))
    finish = trips.marts.payment_summary_of
    with monkeypatch.context() as patch:
        patch.setattr(trips.marts, "payment_summary_of", lambda parts: breaks_contract(finish(parts)))
        assert not run(spark, folder, second, "2025-12", "r2")
    assert revenue(spark, folder) == [("2025-11-05", 1, 10.0)]
    assert read_refreshed(spark, f"{folder}/mart_payment_summary").first().total_trips == 1
    assert ("r2", "mart_contracts", "FAILED") in log(spark, folder)
    assert run(spark, folder, second, "2025-12", "r3")
    assert revenue(spark, folder) == [("2025-11-05", 2, 11.0), ("2025-12-05", 1, 3.0)]
    assert read_refreshed(spark, f"{folder}/mart_payment_summary").first().total_trips == 3


def test_failing_gate_logs_and_leaves_the_marts(spark, tmp_path):
    folder = str(tmp_path)
    assert run(spark, folder, delivery(spark, "2025-11", ("2025-11-05", "10.0")), "2025-11", "r1")
    bad = delivery(spark, "2025-12", ("2025-12-05", "-1"), ("2025-12-06", "-2"))
    assert not run(spark, folder, bad, "2025-12", "r2")
    assert revenue(spark, folder) == [("2025-11-05", 1, 10.0)]
    assert log(spark, folder) == [
        ("r1", "run_complete", "SUCCESS"),
        ("r2", "quality_gate", "FAILED"),
        ("r2", "run_complete", "FAILED"),
    ]


def test_staged_contract_guards_the_marts(spark, tmp_path):
    folder = str(tmp_path)
    zones = spark.createDataFrame([("1.0", "EWR", "Newark", "EWR")], ZONES)
    contract = contracts.staged_trips_contract()

    def run_checked(month, run_id, **cells):
        raw = raw_trips(spark, {"SOURCE_MONTH": month, **cells})
        return trips.run_month(
            spark, raw, zones, folder, month, run_id, CHECKS, contract=contract
        )

    assert run_checked("2025-11", "r1")
    assert not run_checked("2025-12", "r2", PULOCATIONID="77.0")
    assert sum(trip_count for _, trip_count, _ in revenue(spark, folder)) == 1
    assert log(spark, folder)[1:] == [
        ("r2", "run_complete", "FAILED"),
        ("r2", "staged_contract", "FAILED"),
    ]


def test_final_status_is_logged_when_the_run_breaks(spark, tmp_path):
    folder = str(tmp_path)
    raw = delivery(spark, "2025-11", ("2025-11-05", "10.0"))
    broken = raw.withColumn("FARE_AMOUNT", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        run(spark, folder, broken, "2025-11", "r1")
    assert log(spark, folder) == [("r1", "run_complete", "FAILED")]


def test_month_without_valid_trips_builds_empty_marts(spark, tmp_path):
    folder = str(tmp_path)
    raw = delivery(spark, "2025-11", ("2024-11-05", "10.0"))
    assert run(spark, folder, raw, "2025-11", "r1", [quality.not_null("SOURCE_MONTH")])
    assert log(spark, folder) == [("r1", "run_complete", "SUCCESS")]


def test_indicator_job_reloads_revised_history(spark, tmp_path):
    landing, folder = tmp_path / "landing", str(tmp_path / "tables")

    def land(*values):
        pairs = ",".join(
            f'{{"date": "2025-0{month}-01", "value": "{value}"}}'
            for month, value in enumerate(values, 1)
        )
        write(landing, "series_id=UNRATE/page.json", f'{{"observations": [{pairs}]}}')

    land("4.0", "4.25")
    indicators.refresh(spark, str(landing), folder)
    land("4.1", "4.25", ".")
    mart = indicators.refresh(spark, str(landing), folder)
    got = [(r.value, r.mom_change) for r in mart.orderBy("observation_date").collect()]
    assert got == [(4.1, None), (4.25, 0.15), (None, None)]
    card = indicators.headline(mart).first()
    assert tuple(card) == ("Unemployment Rate", "4.25%", "+0.15 pp", "inverse")


def test_indicator_job_publishes_nothing_that_fails(spark, tmp_path):
    landing, folder = tmp_path / "landing", str(tmp_path / "tables")

    def land(name, *values):
        pairs = ",".join(f'{{"date": "2025-0{m}-01", "value": "{v}"}}' for m, v in enumerate(values, 1))
        write(landing, f"series_id=UNRATE/{name}.json", f'{{"observations": [{pairs}]}}')

    def published():
        mart = read_refreshed(spark, f"{folder}/mart_economic_indicators")
        raw = read_refreshed(spark, f"{folder}/raw_series")
        return mart.count(), raw.count(), mart.agg(F.max("value")).first()[0]

    land("page", 4.0, 4.25)
    indicators.refresh(spark, str(landing), folder)
    land("page", 4.0, 4.25, 99.0)
    with pytest.raises(AuditFailed, match="value_range value: 1 failing"):
        indicators.refresh(spark, str(landing), folder)
    assert published() == (2, 2, 4.25)
    land("page", 4.0, 4.25, 4.5)
    write(landing, "series_id=UNRATE/more.json", '{"observations": [{"date": "2025-04-01", "va')
    with pytest.raises(UnreadableDocuments, match="more.json"):
        indicators.refresh(spark, str(landing), folder)
    assert published() == (2, 2, 4.25)
    assert spark.read.parquet(f"{folder}/rejected_documents").first().reason == "not a whole JSON document"
    (landing / "series_id=UNRATE" / "more.json").unlink()
    indicators.refresh(spark, str(landing), folder)
    assert published() == (3, 3, 4.5)
    with pytest.raises(AuditFailed, match="freshness loaded_at"):
        indicators.refresh(spark, str(landing), folder, as_of=date.today() + timedelta(days=61))
    lines = spark.read.parquet(f"{folder}/audit_log")
    assert lines.where("not passed").count() == 3 and lines.count() == 4 * 9


def test_snapshot_job_publishes_nothing_that_fails(spark, tmp_path):
    folder, series, country = str(tmp_path / "tables"), tmp_path / "series", tmp_path / "country"
    write(series, "series_id=UNRATE/page.json", '{"observations": [{"date": "2020-01-01", "value": "3.5"}]}')

    def land(code, value):
        row = f'{{"countryiso3code": "{code}", "country": {{"id": "x", "value": "Land"}}, "date": "2020", "value": {value}}}'
        write(country, f"indicator_id=NY.GDP.MKTP.CD/{code}.json", f'[{{"page": 1}}, [{row}]]')
        return snapshot.refresh(spark, str(series), str(country), folder)

    assert land("DEU", 1e9).count() == 1
    with pytest.raises(AuditFailed, match="stg_worldbank_indicators in_set country_code: 1 failing"):
        land("XXX", 2e9)
    assert read_refreshed(spark, f"{folder}/mart_global_economic_snapshot").count() == 1
    lines = spark.read.parquet(f"{folder}/audit_log")
    assert lines.count() == 2 * 14


def test_snapshot_job_loads_past_its_watermarks(spark, tmp_path):
    folder = str(tmp_path / "tables")

    def land(run, unemployment, gdp):
        """One delivery: US observations ``{date: value}`` and German GDP ``{year: value}``."""
        series, country = tmp_path / run / "series", tmp_path / run / "country"
        observations = ",".join(
            f'{{"date": "{day}", "value": "{value}"}}' for day, value in unemployment.items()
        )
        write(series, "series_id=UNRATE/page.json", f'{{"observations": [{observations}]}}')
        rows = ",".join(
            f"""{{"countryiso3code": "DEU", "country": {{"id": "DE", "value": "Germany"}},
                 "date": "{year}", "value": {value}}}"""
            for year, value in gdp.items()
        )
        write(country, "indicator_id=NY.GDP.MKTP.CD/deu.json", f'[{{"page": 1}}, [{rows}]]')
        mart = snapshot.refresh(spark, str(series), str(country), folder)
        return sorted(
            (r.observation_year, r.gdp_billions_usd, r.us_unemployment_fred_pct)
            for r in mart.collect()
        )

    first = land("r1", {"2019-12-01": 3.6, "2020-01-01": 3.5}, {1999: 1e9, 2000: 2e9, 2019: 3.9e12})
    assert first == [(2019, 3900.0, 3.6)]
    again = land("r2", {"2020-01-01": 3.55, "2020-04-01": 14.8}, {2019: 1.0, 2020: 3.8e12})
    assert again == [(2019, 3900.0, 3.6), (2020, 3800.0, 14.8)]
    series = spark.read.parquet(f"{folder}/raw_series").orderBy("date").collect()
    assert [r.value for r in series] == [3.6, 3.55, 14.8]
