import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martwright.operators import profiling, quantiles
from martwright.operators.joins import hold

PROBABILITIES = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "low": 0.0, "high": 1.0}


def check(spark, groups, **limits):
    rows = [(key, float(v)) for key, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {
        row.k: row
        for row in quantiles.exact_quantiles(df, ["k"], "v", PROBABILITIES, **limits).collect()
    }
    assert set(found) == set(groups)
    for key, values in groups.items():
        for name, probability in PROBABILITIES.items():
            assert found[key][name] == pytest.approx(np.quantile(values, probability), rel=1e-12)


def test_hot_skewed_and_tiny_groups(spark):
    random.seed(3)
    groups = {
        "hot": [random.lognormvariate(0, 3) for _ in range(4000)],
        "ties": [1.0] * 500 + [2.0] * 3,
        "one": [7.5],
        "two": [1.0, 2.0],
        "signs": [random.choice([-1e9, -1.0, 0.0, 1.0, 1e9]) for _ in range(200)],
        None: [3.0, 1.0, 2.0],
    }
    check(spark, groups)
    check(spark, groups, grid=3, small=20)


@settings(max_examples=8, deadline=None)
@given(values=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60), grid=st.integers(2, 8))
def test_any_values(spark, values, grid):
    check(spark, {"a": values}, grid=grid, small=2)


def test_each_round_keeps_a_small_part_of_the_rows(spark, monkeypatch):
    """Held tables of rows shrink by the grid; the first holds no copy of the input."""
    sizes = []

    def counting(df):
        held = hold(df)
        if held.columns == ["group", "path", "value"]:
            sizes.append(held.count())
        return held

    monkeypatch.setattr(quantiles, "hold", counting)
    df = spark.range(200_000).select(F.lit(1).alias("k"), F.xxhash64("id").cast("double").alias("v"))
    found = quantiles.exact_quantiles(df, ["k"], "v", {"median": 0.5}, grid=16, small=50)
    values = sorted(row.v for row in df.select("v").collect())
    assert found.first()["median"] == (values[99_999] + values[100_000]) / 2
    assert len(sizes) >= 3 and sizes[-1] <= 4 * 50
    for before, after in zip([200_000, *sizes], sizes):
        assert after <= before / 4


def test_a_value_that_fills_most_rows_ends_the_search(spark, monkeypatch):
    held = []
    monkeypatch.setattr(quantiles, "hold", lambda df: held.append(hold(df)) or held[-1])
    df = spark.range(20_000).select(
        F.lit(1).alias("k"), F.when(F.col("id") % 100 == 0, F.rand(1)).otherwise(0.25).alias("v")
    )
    found = quantiles.exact_quantiles(df, ["k"], "v", {"q": 0.5}, small=10)
    assert found.first()["q"] == 0.25
    assert not [table for table in held if table.columns == ["group", "path", "value"]]


def test_null_and_nan_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    df = df.withColumn("k", F.lit(1))
    row = quantiles.exact_quantiles(df, ["k"], "v", {"median": 0.5}).first()
    assert row.median == 2.0


def test_describe(spark):
    random.seed(5)
    amounts = [round(random.uniform(-50, 500), 2) for _ in range(999)]
    df = spark.createDataFrame([(a, 1.0) for a in amounts], "amount double, one double")
    rows = {r.measure: r for r in profiling.describe(df, ["amount", "one"]).collect()}
    got = rows["amount"]
    assert (got.n_rows, got.min, got.max) == (999, min(amounts), max(amounts))
    assert got["mean"] == pytest.approx(np.mean(amounts), abs=1e-4)
    assert got["std"] == pytest.approx(np.std(amounts, ddof=1), abs=1e-4)
    assert got["q25"] == pytest.approx(np.quantile(amounts, 0.25), abs=1e-4)
    assert (rows["one"]["std"], rows["one"]["q50"]) == (0.0, 1.0)
