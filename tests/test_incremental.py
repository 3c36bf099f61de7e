from datetime import date

import pytest
from pyspark.sql import functions as F

from martwright.operators import incremental as inc
from martwright.operators import joins
from martwright.sources import sinks

MART = "day date, place string, total int"


def mart(spark, *rows):
    return spark.createDataFrame([(date.fromisoformat(d), p, t) for d, p, t in rows], MART)


def trips(spark, *rows):
    layout = "day date, place string, fare int, source_month string"
    return spark.createDataFrame([(date.fromisoformat(d), p, f, m) for d, p, f, m in rows], layout)


def totals(df):
    return df.groupBy("day", "place").agg(F.sum("fare").cast("int").alias("total"))


def rows_of(df):
    return sorted((str(r.day), r.place, r.total) for r in df.collect())


def test_newer_months_is_strict_and_takes_all_when_empty(spark):
    target = mart(spark, ("2025-01-31", "A", 1))
    batch = mart(spark, ("2025-01-31", "A", 2), ("2025-02-01", "A", 3))
    assert rows_of(inc.newer_months(batch, "day", target, "day")) == [("2025-02-01", "A", 3)]
    empty = target.where("total > 99")
    assert inc.newer_months(batch, "day", empty, "day").count() == 2


def test_stray_row_loses_a_month_under_the_watermark_but_not_under_recompute(spark):
    first = trips(
        spark, ("2025-01-05", "A", 1, "2025-01"), ("2025-02-01", "A", 5, "2025-01")
    )
    second = trips(
        spark, ("2025-02-02", "A", 7, "2025-02"), ("2025-02-01", "A", 2, "2025-02"),
        ("2025-01-05", "A", 4, "2025-02"),
    )
    built, everything = totals(first), first.unionByName(second)
    assert inc.newer_months(second, "day", built, "day").count() == 0

    touched = joins.hold(second.select("day", "place").distinct())
    fresh = inc.recompute_touched(touched, everything, ["day", "place"], totals)
    merged = inc.upsert(built, fresh, ["day", "place"])
    assert rows_of(merged) == rows_of(totals(everything))


def test_unloaded_months(spark):
    batch = trips(spark, ("2025-01-01", "A", 1, "2025-01"), ("2025-02-01", "A", 1, "2025-02"))
    target = batch.where("source_month = '2025-01'")
    assert [r.source_month for r in inc.unloaded_months(batch, target).collect()] == ["2025-02"]


def test_watermarks_per_key(spark):
    layout = "k string, at int"
    target = spark.createDataFrame([("a", 5), ("a", 3)], layout)
    batch = spark.createDataFrame([("a", 4), ("a", 5), ("a", 6), ("b", 1), ("b", 2)], layout)

    def kept(inclusive):
        df = inc.after_watermark(batch, target, ["k"], "at", F.lit(1), inclusive=inclusive)
        return sorted(tuple(r) for r in df.collect())

    assert kept(True) == [("a", 5), ("a", 6), ("b", 1), ("b", 2)]
    assert kept(False) == [("a", 6), ("b", 2)]


def test_upsert_changes_adds_and_keeps(spark):
    target = mart(spark, ("2025-01-01", "A", 1), ("2025-01-01", "B", 2))
    changes = mart(spark, ("2025-01-01", "B", 9), ("2025-01-02", "A", 3))
    expected = [("2025-01-01", "A", 1), ("2025-01-01", "B", 9), ("2025-01-02", "A", 3)]
    assert rows_of(inc.upsert(target, changes, ["day", "place"])) == expected


def with_month(df):
    return df.withColumn("month", F.trunc("day", "MM"))


def merge(df, folder):
    inc.merge_into(
        with_month(df), f"{folder}/mart", ["day", "place"], "month", f"{folder}/staging"
    )


def stored(spark, folder):
    return rows_of(spark.read.parquet(f"{folder}/mart"))


def test_merge_into_is_idempotent_and_touches_only_its_months(spark, tmp_path):
    folder = str(tmp_path)
    merge(mart(spark, ("2025-01-01", "A", 1), ("2025-02-01", "A", 2)), folder)
    january = sorted((tmp_path / "mart" / "month=2025-01-01").glob("*.parquet"))
    for _ in range(2):
        merge(mart(spark, ("2025-02-01", "A", 5), ("2025-02-02", "B", 6)), folder)
        expected = [("2025-01-01", "A", 1), ("2025-02-01", "A", 5), ("2025-02-02", "B", 6)]
        assert stored(spark, folder) == expected
    assert sorted((tmp_path / "mart" / "month=2025-01-01").glob("*.parquet")) == january


def test_merge_into_refuses_repeated_keys(spark, tmp_path):
    with pytest.raises(ValueError, match="more than once"):
        merge(mart(spark, ("2025-01-01", "A", 1), ("2025-01-01", "A", 2)), str(tmp_path))


def test_merge_that_died_while_moving_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    merge(mart(spark, ("2025-01-01", "A", 1), ("2025-01-02", "A", 2)), folder)

    def dies(df, path, by, **options):
        emptied = spark.read.parquet(path).where("day = date '2025-01-01'").persist()
        emptied.count()
        sinks.replace_partitions(emptied, path, by)
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(inc, "replace_partitions", dies)
        with pytest.raises(RuntimeError, match="killed"):
            merge(mart(spark, ("2025-01-03", "A", 3)), folder)
    assert stored(spark, folder) == [("2025-01-01", "A", 1)]

    merge(mart(spark, ("2025-01-04", "A", 4)), folder)
    assert [row[0] for row in stored(spark, folder)] == [f"2025-01-0{n}" for n in (1, 2, 3, 4)]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_lookup_join_gives_the_same_rows_either_way(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    facts = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    lookup = spark.range(5).select(F.col("id").alias("k"))
    for how, expected in (("left_semi", 500), ("left_anti", 500), ("left", 1000), ("inner", 500)):
        assert joins.lookup_join(facts, lookup, "k", how).count() == expected
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
