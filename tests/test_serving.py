from datetime import date

import pytest
from pyspark.sql import functions as F

from martwright.operators import profiling, reshape, serving
from martwright.plans import marts


def test_latest_takes_each_columns_last_known_value(spark):
    rows = [
        ("A", date(2025, 1, 1), 1.0, 0.5),
        ("A", date(2025, 2, 1), None, 0.7),
        ("A", date(2025, 3, 1), 3.0, None),
        ("B", date(2025, 1, 1), None, None),
    ]
    layout = "indicator_name string, observation_date date, value double, mom_change double"
    got = serving.latest(spark.createDataFrame(rows, layout)).orderBy("indicator_name").collect()
    assert got == [("A", date(2025, 3, 1), 3.0, 0.7), ("B", date(2025, 1, 1), None, None)]


def zone_hours(spark, *rows):
    layout = "pickup_borough string, pickup_zone string, hour_of_day int, total_trips long"
    return spark.createDataFrame([("X", *row) for row in rows], layout)


def test_top_zones_break_ties_by_name(spark):
    rows = [(f"z{n:02d}", 1, 100 - n) for n in range(19)] + [("tie_b", 1, 5), ("tie_a", 1, 5)]
    names = [r.pickup_zone for r in serving.top_zones(zone_hours(spark, *rows)).collect()]
    assert len(names) == 20 and names[-1] == "tie_a"


def test_hour_grid_fills_missing_hours_with_zero(spark):
    df = zone_hours(spark, ("a", 0, 4), ("a", 0, 6), ("a", 23, 1), ("b", 5, 2))
    grid = {r.pickup_zone: r for r in reshape.hour_grid(df).collect()}
    assert (grid["a"].h00, grid["a"].h23, grid["a"].h12, grid["b"].h05) == (5.0, 1.0, 0.0, 2.0)
    cells = reshape.hour_cells(reshape.hour_grid(df))
    assert cells.count() == 48
    assert cells.where("pickup_zone = 'a' and hour_label = '00:00'").first().trips == 5.0


def test_only_top_zones(spark):
    df = zone_hours(spark, ("a", 0, 4), ("b", 0, 6), ("c", 0, 5))
    kept = serving.only_top_zones(reshape.hour_grid(df), df, 2)
    assert {r.pickup_zone for r in kept.collect()} == {"b", "c"}


def test_choose_nothing_means_everything(spark):
    df = zone_hours(spark, ("a", 0, 4), ("b", 0, 6))
    assert serving.choose(df, "pickup_zone", []).count() == 2
    assert serving.choose(df, "pickup_zone", ["b", "x"]).count() == 1


def test_look_back_includes_its_first_day(spark):
    rows = [("A", date(2015, 6, 1)), ("A", date(2015, 5, 31)), ("B", date(2020, 1, 1))]
    df = spark.createDataFrame(rows, "indicator_name string, observation_date date")
    got = serving.last_years(df, "A", 10, date(2025, 6, 1)).collect()
    assert [r.observation_date for r in got] == [date(2015, 6, 1)]
    with pytest.raises(ValueError, match="between 1 and 24"):
        serving.last_years(df, "A", 25, date(2025, 6, 1))


def test_borough_means_are_unweighted(spark):
    layout = (
        "pickup_borough string, avg_duration_minutes double, median_duration_minutes double,"
        " total_trips long"
    )
    df = spark.createDataFrame([("A", 10.0, 8.0, 1), ("A", 20.0, 9.0, 99)], layout)
    by_borough = serving.duration_by_borough(df)
    assert by_borough.collect() == [("A", 15.0, 8.5, 100)]
    names = {"avg_duration_minutes": "Average", "median_duration_minutes": "Median"}
    melted = reshape.metrics_long(by_borough, "pickup_borough", names).orderBy("metric").collect()
    assert melted == [("A", "Average", 15.0), ("A", "Median", 8.5)]


def test_serve_orders_and_projects(spark):
    rows = [("Cash", 5, 1.0, 2.0, "x"), ("Card", 9, 1.0, 2.0, "x"), ("Alt", 5, 1.0, 2.0, "x")]
    layout = (
        "PAYMENT_LABEL string, TOTAL_TRIPS long, TOTAL_REVENUE double, AVG_TIP_RATE_PCT double,"
        " OTHER string"
    )
    got = serving.serve(spark.createDataFrame(rows, layout), serving.PAYMENT_SUMMARY)
    assert got.columns == ["payment_label", "total_trips", "total_revenue", "avg_tip_rate_pct"]
    assert [r.payment_label for r in got.collect()] == ["Card", "Alt", "Cash"]


def trip_rows(spark, *rows):
    layout = (
        "pickup_date date, pickup_borough string, trip_duration_minutes long, trip_distance double,"
        " fare_amount double, tip_amount double, total_amount double, payment_type int"
    )
    return spark.createDataFrame([(date(2025, 1, 1), *row) for row in rows], layout)


def test_duration_band_and_interpolated_median(spark):
    rows = [("A", m, 1.0, 1.0, 0.0, 1.0, 1) for m in (0, 1, 2, 4, 180, 181)]
    rows.append((None, 5, 1.0, 1.0, 0.0, 1.0, 1))
    got = marts.trip_duration(trip_rows(spark, *rows)).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.total_trips, row.median_duration_minutes) == (4, 3.0)
    assert (row.avg_duration_minutes, row.min_duration_minutes, row.max_duration_minutes) == (
        46.8,
        1,
        180,
    )


def test_tip_rate_is_the_mean_of_ratios_over_positive_fares(spark):
    rows = [("A", 5, 1.0, fare, tip, 1.0, code) for fare, tip, code in
            ((10.0, 1.0, 1), (100.0, 30.0, 1), (0.0, 5.0, 1), (-1.0, 5.0, 1), (0.0, 5.0, None))]
    got = {r.payment_type: r for r in marts.payment_summary(trip_rows(spark, *rows)).collect()}
    assert (got[1].avg_tip_rate_pct, got[1].total_trips, got[1].payment_label) == (
        20.0,
        4,
        "Credit Card",
    )
    assert (got[None].avg_tip_rate_pct, got[None].payment_label) == (None, "Other")


def test_value_counts_and_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (None, "y"), (2, "x")], "a int, b string")
    got = {(r.column_name, r.value): r.n_rows for r in profiling.value_counts(df, ["a", "b"]).collect()}
    assert got == {("a", "1"): 2, ("a", "2"): 1, ("b", "x"): 2, ("b", "y"): 1}
    shares = {r.column_name: r.null_percentage for r in profiling.null_shares(df).collect()}
    assert shares == {"a": 25.0, "b": 25.0}
    shape = profiling.shape(df, "a").first()
    assert (shape.n_rows, shape.n_columns, shape.n_distinct, shape.any_null) == (4, 2, 2, True)


def test_snapshot_scales_and_keeps_the_floor_year(spark):
    layout = (
        "country_code string, country_name string, observation_year int, gdp_usd double,"
        " inflation_rate double, unemployment_rate double, us_unemployment_fred double,"
        " us_cpi_fred double, us_real_gnp_fred double"
    )
    rows = [
        ("DEU", "Germany", 1999, 1e12, 1.0, 1.0, 1.0, 1.0, 1.0),
        ("DEU", "Germany", 2000, 1.946e12, 1.444, 7.917, 4.1, 174.6, 13_138.0),
        ("JPN", "Japan", 2001, None, -0.7, 5.0, None, None, None),
    ]
    got = marts.country_snapshot(spark.createDataFrame(rows, layout)).orderBy("country_code").collect()
    assert got[0] == ("DEU", "Germany", 2000, 1946.0, 1.44, 7.92, 4.1, 174.6, 13.14, 3.82)
    assert got[1] == ("JPN", "Japan", 2001, None, -0.7, 5.0, None, None, None, None)


def test_annual_takes_the_largest_month(spark):
    rows = [("UNRATE", date(2020, m, 1), v) for m, v in ((1, 3.6), (4, 14.8), (12, 6.7))]
    df = spark.createDataFrame(rows, "series_id string, observation_date date, indicator_value double")
    got = reshape.annual(df, {"us_unemployment_fred": "UNRATE", "us_cpi_fred": "CPIAUCSL"})
    assert got.collect() == [(2020, 14.8, None)]


def test_stamp(spark):
    assert marts.stamped(spark.range(1)).where(F.col("updated_at").isNotNull()).count() == 1
