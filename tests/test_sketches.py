"""Sketches kept per delivery and merged."""

import pytest
from pyspark.sql import functions as F

from martwright.operators import sketches

LAYOUT = "k string, part int, v double, name string"
QUANTILES = {"low": ("v", 0.1), "mid": ("v", 0.5), "high": ("v", 0.99)}


def report(parts):
    return {r.k: r for r in sketches.sketch_report(parts, ["k"], QUANTILES, {"names": "name"}).collect()}


@pytest.mark.parametrize("parts", [1, 40])
def test_merged_parts_stay_within_their_errors(spark, parts):
    n = 200_000
    df = spark.range(n).select(
        F.lit("a").alias("k"), (F.col("id") % parts).cast("int").alias("part"),
        (F.xxhash64("id") / 1e12).alias("v"), (F.col("id") % 5000).cast("string").alias("name"),
    )
    row = report(sketches.sketch_parts(df, ["part", "k"], ["v"], ["name"]))["a"]
    assert row.n_rows == n
    assert abs(row.names - 5000) <= sketches.DISTINCT_ERROR * 5000
    for name, (_, p) in QUANTILES.items():
        rank = df.where(F.col("v") <= row[name]).count() / n
        assert abs(rank - p) <= sketches.RANK_ERROR


def test_small_groups_nulls_and_nan(spark):
    rows = [("a", 1, 1.0, "x"), ("a", 2, None, None), ("a", 2, float("nan"), "x"), ("b", 1, None, None), (None, 1, 7.0, "y")]
    parts = sketches.sketch_parts(spark.createDataFrame(rows, LAYOUT), ["part", "k"], ["v"], ["name"])
    told = report(parts)
    assert (told["a"].n_rows, told["a"].mid, told["a"].names) == (3, 1.0, 1)
    assert (told["b"].n_rows, told["b"].mid, told["b"].names) == (1, None, 0)
    assert (told[None].high, told[None].names) == (7.0, 1)
    assert report(parts.limit(0)) == {}


def test_the_shuffle_moves_sketches_not_rows(spark):
    df = spark.range(1000).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("v"))
    plan = sketches.sketch_parts(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_kll_sketch_agg_double" in plan
