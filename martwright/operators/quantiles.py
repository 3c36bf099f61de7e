"""Exact interpolated quantiles of groups of any size, by narrowing down ranks.

The built-in exact percentile keeps every distinct value of a group in one task. Here
each round counts the rows of every group below a grid of approximate quantiles, keeps
only the stretches between two of them that hold a wanted rank, and looks for the rank
in there. A stretch holds about one in ``GRID`` of the rows, so a few rounds are enough
for any number, and the first one alone reads all rows. Grid values are approximate but
rows are counted exactly, so a poor grid costs time and never a wrong answer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.joins import hold, lookup_join
from martwright.operators.ranges import place_among

GRID = 64
#: Rows of a stretch that one task may put in order; a larger one is cut again.
SMALL = 50_000


def _grid(grid: int) -> Column:
    """Aggregate: ascending values that cut a stretch into parts of like size."""
    fractions = F.array(*[F.lit(step / grid) for step in range(1, grid)])
    return F.array_distinct(F.percentile_approx("value", fractions, F.lit(8 * grid)))


def _counted(rows: DataFrame, seeking: DataFrame, grid: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the part of their stretch that they lie in, and the ranks by part.

    Grid values have parts of their own, between those of the values around them, so
    what occurs very often ends a search instead of filling a part.
    """
    stretch = ["group", "path"]
    grids = hold(rows.groupBy(*stretch).agg(_grid(grid).alias("grid")))
    placed = place_among(lookup_join(rows, grids, stretch, "inner", held=True), "grid", F.col("value"), grid, "below")
    on_grid = F.get(F.col("grid"), F.col("below") - 1) == F.col("value")
    part = 2 * F.col("below") - F.coalesce(on_grid, F.lit(False)).cast("int")
    parted = placed.select(*stretch, "value", part.alias("part"))
    counts = parted.groupBy(*stretch, "part").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    # At most 2 * grid rows a stretch.
    along = Window.partitionBy(*stretch).orderBy("part")
    cumulated = counts.withColumn("before", F.sum("n").over(along) - F.col("n"))
    hits = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    found = lookup_join(cumulated, seeking, stretch, "inner", held=True).where(hits)
    return parted, hold(found)


def values_at(
    rows: DataFrame, wanted: DataFrame, *, grid: int = GRID, small: int = SMALL
) -> DataFrame:
    """``group``, ``wanted`` and ``value``: the value at each wanted rank of a group.

    ``rows`` has ``group`` and a ``value`` without NULL or NaN, ``wanted`` the ranks of
    each group, from 0.
    """
    rows = rows.select("group", F.lit(0).cast("long").alias("path"), "value")
    seeking = hold(wanted.select("group", F.lit(0).cast("long").alias("path"), "wanted", F.col("wanted").alias("rank")))
    stretch = ["group", "path"]
    answers = []
    while True:
        parted, found = _counted(rows, seeking, grid)
        single = F.col("low") == F.col("high")
        answers.append(found.where(single).select("group", "wanted", F.col("low").alias("value")))
        open_ranks = found.where(~single)
        largest = open_ranks.agg(F.max("n")).first()[0]
        if largest is None:
            break
        # Paths number the stretches of all rounds; they stay distinct within a group.
        deeper = (F.col("path") * (2 * grid) + F.col("part") + 1).alias("path")
        chosen = hold(open_ranks.select(*stretch, "part").distinct())
        inside = lookup_join(parted, chosen, [*stretch, "part"], "left_semi", held=True)
        rows = hold(inside.select("group", deeper, "value"))
        seeking = hold(open_ranks.select("group", deeper, "wanted", (F.col("rank") - F.col("before")).alias("rank")))
        if largest <= small:
            place = F.row_number().over(Window.partitionBy(*stretch).orderBy("value")) - 1
            ranked = rows.withColumn("rank", place.cast("long"))
            answers.append(lookup_join(ranked, seeking, [*stretch, "rank"], "inner", held=True).select("group", "wanted", "value"))
            break
    return reduce(DataFrame.unionByName, answers)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    *,
    grid: int = GRID,
    small: int = SMALL,
) -> DataFrame:
    """Quantiles of ``value`` per group, e.g. ``{"median": 0.5}``.

    NULL and NaN stay out, and a group without other values has no row. The group is
    packed in a struct so that a NULL key joins to itself. ``df`` is read four times, by
    the columns named: ``hold`` it when it is costly.
    """
    kept = F.col(value).isNotNull() & ~F.isnan(value)
    rows = df.where(kept).select(F.struct(*keys).alias("group"), F.col(value).cast("double").alias("value"))
    sizes = hold(rows.groupBy("group").agg(F.count("*").alias("n_rows")))

    def position(probability: float) -> Column:
        return F.lit(probability) * (F.col("n_rows") - 1)

    ranks = [limit(position(p)).cast("long") for p in probabilities.values() for limit in (F.floor, F.ceil)]
    wanted = sizes.select("group", F.explode(F.array_distinct(F.array(*ranks))).alias("wanted"))
    values = values_at(rows, wanted, grid=grid, small=small)
    # One entry a group and wanted rank: two a probability at most.
    found = sizes.join(
        values.groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct("wanted", "value"))).alias("at")), "group"
    )

    def interpolated(name: str, probability: float) -> Column:
        below, above = F.floor(position(probability)), F.ceil(position(probability))
        low, high = F.col("at")[below.cast("long")], F.col("at")[above.cast("long")]
        return (low + (high - low) * (position(probability) - below)).alias(name)

    return found.select("group.*", *[interpolated(name, p) for name, p in probabilities.items()])
