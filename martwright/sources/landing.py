"""Raw layer: everything as text, or typed with a load time."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions.casts import MISSING_TEXTS, null_if_in
from martwright.sources.files import upper_names


#: The month that a delivery is named after: the last ``YYYY-MM`` in its path.
MONTH_IN_NAME = r"^.*(?<![0-9])([0-9]{4}-(?:0[1-9]|1[0-2]))(?![0-9])"
#: Writers put random ids into the names of part files, and some digits of an id look like a month.
RANDOM_ID = r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"


def month_named(path: str) -> str:
    """Month in the name of a delivery. Its rows cannot tell: they hold stray pickups of others."""
    found = re.match(MONTH_IN_NAME, re.sub(RANDOM_ID, "_", path))
    if found is None:
        raise ValueError(f"no month in the name of {path}")
    return found.group(1)


def month_in(path: Column) -> Column:
    """``month_named`` of a column; a path without a month fails the job."""
    found = F.regexp_extract(F.regexp_replace(path, RANDOM_ID, "_"), MONTH_IN_NAME, 1)
    unnamed = F.raise_error(F.concat(F.lit("no month in the name of "), path)).cast("string")
    return F.when(found != "", found).otherwise(unnamed)


def stringify(
    df: DataFrame, source_month: str | Column, month_column: str = "SOURCE_MONTH"
) -> DataFrame:
    """Every column as text in upper-case names, missing-value texts to NULL, plus the month."""
    month = F.lit(source_month) if isinstance(source_month, str) else source_month
    cells = [
        null_if_in(F.col(field.name).cast("string"), MISSING_TEXTS).alias(field.name)
        for field in df.schema
    ]
    return upper_names(df.select(*cells, month.alias(month_column)))


def typed_raw(df: DataFrame, schema: T.StructType, loaded_at: Column | None = None) -> DataFrame:
    """Shape rows to a raw table's layout; ``loaded_at`` defaults to now."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return df.withColumn("loaded_at", stamp).select(
        [F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
    )
