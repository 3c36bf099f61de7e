import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martwright.operators import ranges, windows

LAYOUT = "observation_date date, indicator_name string, series_id string, value double"


def series(spark, *rows):
    return spark.createDataFrame(
        [(date.fromisoformat(day), name, name, value) for day, name, value in rows], LAYOUT
    )


def changes(df, rates=("RATE",)):
    rows = windows.with_change(df, rates).orderBy("indicator_name", "observation_date").collect()
    return [(r.prev_value, r.mom_change) for r in rows]


def test_percent_change_and_null_rules(spark):
    df = series(
        spark,
        ("2024-12-01", "A", 100.0),
        ("2025-01-01", "A", 110.0),
        ("2025-02-01", "A", None),
        ("2025-03-01", "A", 5.0),
        ("2025-05-01", "A", 0.0),
        ("2025-06-01", "A", 3.0),
        ("2025-01-01", "B", 7.0),
    )
    assert changes(df) == [
        (None, None),
        (100.0, 10.0),
        (110.0, None),
        (None, None),
        (5.0, -100.0),
        (0.0, None),
        (None, None),
    ]


def test_rates_change_by_difference_even_from_zero(spark):
    df = series(spark, ("2025-01-01", "RATE", 0.0), ("2025-02-01", "RATE", 0.25))
    assert changes(df) == [(None, None), (0.0, 0.25)]


def hot_series(spark, seed, rows=3000):
    """One series holds most rows; keys, values and gaps include NULL and ties."""
    random.seed(seed)
    days = [None, *(date(2020, 1, 1) + timedelta(days=d) for d in (0, 3, 40, 41, 400, 800, 801))]
    drawn = [
        (
            number,
            random.choice(["hot"] * 6 + ["b", "c", None]),
            random.choice([days[2]] * 9 + days),
            random.choice([None, random.random()]),
        )
        for number in range(rows)
    ]
    return spark.createDataFrame(drawn, "id int, k string, day date, v double").repartition(8)


@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_give_the_plain_lag(spark, seed):
    df = hot_series(spark, seed)
    plain = df.withColumn("expected", F.lag("v").over(Window.partitionBy("k").orderBy("day", "id")))
    for ranges in (None, 1, 7, 2000):
        got = windows.previous_value(df, "k", ["day", "id"], "v", "got", ranges).select("id", "got")
        both = plain.join(got, "id")
        assert both.count() == 3000
        assert both.where(~F.col("expected").eqNullSafe(F.col("got"))).count() == 0


def test_a_hot_series_is_cut_where_its_rows_are(spark):
    """Nine tenths of the hot series fall on one day; its ranges hold a like share anyway."""
    df = hot_series(spark, 3, 20_000)
    sizes = ranges.with_range(df, ["k", "day", "id"], "range", 50).groupBy("range").count()
    counts = [row["count"] for row in sizes.collect()]
    assert len(counts) >= 45
    assert max(counts) <= 3 * 20_000 / 50


def test_ranges_follow_the_order(spark):
    df = hot_series(spark, 4)
    for number in (1, 2, 5, 64, 5000):
        rows = ranges.with_range(df, ["k", "day", "id"], "range", number).orderBy("k", "day", "id")
        places = [row["range"] for row in rows.collect()]
        assert places == sorted(places)
        assert len(set(places)) <= number + 1
    empty = ranges.with_range(df.limit(0), ["k", "day", "id"], "range")
    assert empty.collect() == [] and empty.schema["range"].dataType.simpleString() == "int"


def test_no_window_holds_a_whole_series(spark):
    df = spark.range(1000).select(
        (F.col("id") % 2).alias("k"),
        F.date_add(F.lit(date(2020, 1, 1)), F.col("id").cast("int")).alias("day"),
        F.rand(1).alias("v"),
    )
    lagged = windows.previous_value(df, "k", "day", "v")
    plan = lagged._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"lag\(v#\d+, -1, null\) windowspecdefinition\(_stretch#\d+", plan)
    # The window over a whole series sees what an aggregation left: one row per range.
    whole = plan[plan.index("lag(_last#") :]
    assert re.match(r".*?\n[^\n]*\n?[^\n]*Aggregate \[_stretch#\d+\]", whole, re.S)
