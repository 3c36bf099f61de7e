from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martwright.functions import calendar, casts, labels, measures


def column(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def test_safe_int(spark):
    values = ["1", "1.0", "1.5", "2.5", "-1.5", " 1 ", "x", None, "nan", "1e12", "1.0d", "Infinity"]
    expected = [1, 1, 2, 3, -2, 1, None, None, None, None, None, None]
    assert column(texts(spark, values), casts.safe_int(F.col("x"))) == expected


def test_safe_double(spark):
    values = ["1.25", "-2", "1e3", "nan", "NaN", "inf", "-Infinity", "3f", "", None]
    expected = [1.25, -2.0, 1000.0, None, None, None, None, None, None, None]
    assert column(texts(spark, values), casts.safe_double(F.col("x"))) == expected


def test_parse_columns_agrees_with_single_casts(spark):
    df = texts(spark, ["1.5", "x", None, "nan", "9e99", " 7 ", "2d"])
    parsed = casts.parse_columns(df, measures={"d": "x"}, integers={"i": "x"}).collect()
    assert [r.d for r in parsed] == column(df, casts.safe_double(F.col("x")))
    assert [r.i for r in parsed] == column(df, casts.safe_int(F.col("x")))


def test_safe_time(spark):
    values = ["2025-01-02 03:04:05", "not a time", None, "2025-13-01"]
    expected = [datetime(2025, 1, 2, 3, 4, 5), None, None, None]
    assert column(texts(spark, values), casts.safe_time(F.col("x"))) == expected


def test_na_tokens(spark):
    values = ["N/A", "", "nan", "NA", "Nadir", None]
    expected = [None, None, None, None, "Nadir", None]
    assert column(texts(spark, values), casts.null_if_in(F.col("x"), casts.NA_TOKENS)) == expected


def minutes(spark, start, end):
    row = spark.createDataFrame([(start, end)], "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b")
    )
    return column(row, calendar.minutes_crossed(F.col("a"), F.col("b")))[0]


def test_minutes_count_boundaries(spark):
    assert minutes(spark, "2025-01-01 00:00:59", "2025-01-01 00:01:01") == 1
    assert minutes(spark, "2025-01-01 00:00:00", "2025-01-01 00:00:59") == 0
    assert minutes(spark, "2025-01-01 00:01:01", "2025-01-01 00:00:59") == -1
    assert minutes(spark, "2025-01-01 23:59:59", "2025-01-02 00:00:00") == 1
    assert minutes(spark, "1960-01-01 00:00:30", "1960-01-01 00:02:10") == 2


def test_minutes_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert minutes(spark, "2025-03-09 01:30:00", "2025-03-09 03:30:00") == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_round_half_up(spark):
    df = spark.createDataFrame([(v,) for v in (2.5, -2.5, 0.125, -0.001, None)], "x double")
    assert column(df, measures.round_half_up(F.col("x"), 0)) == [3.0, -3.0, 0.0, 0.0, None]
    small = column(df, measures.round_half_up(F.col("x"), 2))
    assert small == [2.5, -2.5, 0.13, 0.0, None]
    assert str(small[3]) == "0.0"


def test_totals_are_exact(spark):
    df = spark.range(0, 100_000, 1, 16).select((F.lit(0.1)).alias("x"))
    assert df.agg(measures.total("x")).first()[0] == 10_000.0
    assert df.agg(measures.mean("x")).first()[0] == 0.1


def test_large_values_are_not_clamped(spark):
    df = spark.createDataFrame([(1e18,), (2e17,), (-9e16,), (1234567890123.45,)], "x double")
    assert column(df, measures.round_half_up(F.col("x"), 2)) == [1e18, 2e17, -9e16, 1234567890123.45]
    assert column(df, measures.round_half_up(F.col("x"), 4))[:3] == [1e18, 2e17, -9e16]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_totals_past_the_range_of_an_integer(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for value in (1e13, 1e18, 1e20, 1e300):
            df = spark.range(0, 100, 1, 8).select(F.lit(value).alias("x"))
            assert df.agg(measures.total("x")).first()[0] == pytest.approx(100 * value, rel=1e-14)
            parts = df.groupBy(F.spark_partition_id()).agg(measures.exact_sum(F.col("x")).alias("s"))
            again = parts.agg(measures.value_of(measures.merged("s"))).first()[0]
            assert again == pytest.approx(100 * value, rel=1e-14)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_small_values_are_not_cut(spark):
    df = spark.createDataFrame([(0.00004,)] * 4, "x double")
    assert df.agg(measures.total("x", 6)).first()[0] == 0.00016
    mixed = spark.createDataFrame([(1e14,), (12.34,), (-0.5,), (1 / 3,)], "x double")
    assert mixed.agg(measures.total("x", 4)).first()[0] == 100000000000012.17


def test_sums_do_not_depend_on_the_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.sin("id") * F.pow(F.lit(10.0), F.col("id") % 9)).alias("x"))
    sums = {
        df.repartition(n).agg(measures.value_of(measures.exact_sum(F.col("x")))).first()[0]
        for n in (1, 3, 8)
    }
    assert len(sums) == 1


def test_mean_skips_nulls_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    assert df.agg(measures.mean("x")).first()[0] == 1.5
    assert df.where("x > 9").agg(measures.mean("x"), measures.total("x")).first() == (None, None)


def test_payment_labels(spark):
    df = spark.createDataFrame([(c,) for c in (0, 1, 2, 3, 4, 5, 6, 9, None)], "x int")
    assert column(df, labels.payment_label(F.col("x"))) == [
        "Other",
        "Credit Card",
        "Cash",
        "No Charge",
        "Dispute",
        "Unknown",
        "Voided Trip",
        "Other",
        "Other",
    ]


def test_card_texts(spark):
    rows = [
        ("Unemployment Rate", 4.25, 0.1),
        ("CPI (Index)", 1234567.5, -1.25),
        ("Federal Funds Rate", None, None),
        ("GDP (Billions USD)", 0.5, 0.0),
    ]
    df = spark.createDataFrame(rows, "name string, v double, c double")
    name = F.col("name")
    assert column(df, labels.value_text(name, F.col("v"))) == ["4.25%", "1,234,567.50", "N/A", "0.50"]
    assert column(df, labels.change_text(name, F.col("c"))) == ["+0.10 pp", "-1.25%", "N/A", "+0.00%"]
    assert column(df, labels.change_polarity(name)) == ["inverse", "inverse", "off", "normal"]


def test_hour_label(spark):
    df = spark.createDataFrame([(7,), (23,)], "h int")
    assert column(df, labels.hour_label(F.col("h"))) == ["07:00", "23:00"]
