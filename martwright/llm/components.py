"""Connected components by joins, for graphs whose links stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, of every id in ``links``.

    ``links`` has ``a`` and ``b``, not null. Every round takes the smallest label among
    the neighbours and then the label of the label, so the number of rounds grows with
    the logarithm of the longest way. Minima are combined before each shuffle; a hot id
    is spread by the skew handling of the joins. No links give no rows.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), "links")
    labels = stored(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low"))
        .select("id", F.least("id", "low").alias("component"), F.lit(True).alias("changed")),
        "labels",
    )
    while True:
        known = labels.select("id", "component")
        near = (
            both.join(known.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        lower = known.join(near, "id").select("id", "component", F.least("component", "near").alias("low"))
        jump = known.select(F.col("id").alias("low"), F.col("component").alias("lowest"))
        labels = stored(
            lower.join(jump, "low").select(
                "id", F.col("lowest").alias("component"), (F.col("component") != F.col("lowest")).alias("changed")
            ),
            "labels",
        )
        if not labels.where("changed").limit(1).count():
            return labels.select("id", "component")
