"""Parquet and CSV scans with declared layouts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions.casts import NA_TOKENS, null_if_in
from martwright.schemas import TRIP_FILE, ZONES_CSV


def month_bounds(month: str) -> tuple[date, date]:
    """First day of ``YYYY-MM`` and of the month after it."""
    year, number = (int(part) for part in month.split("-"))
    following = date(year + number // 12, number % 12 + 1, 1)
    return date(year, number, 1), following


def in_month(df: DataFrame, time_column: str, month: str) -> DataFrame:
    """Rows of one month, as a range that parquet row groups can be skipped by."""
    first, following = month_bounds(month)
    kind = df.schema[time_column].dataType
    at = F.col(time_column)
    return df.where((at >= F.lit(first).cast(kind)) & (at < F.lit(following).cast(kind)))


def read_facts(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = TRIP_FILE,
    *,
    time_column: str | None = None,
    month: str | None = None,
) -> DataFrame:
    """Fact files of one layout, optionally one month of them.

    File splits bound the memory of a task; no file is read whole.
    """
    paths = [path] if isinstance(path, str) else list(path)
    facts = spark.read.schema(schema).parquet(*paths)
    return in_month(facts, time_column, month) if month and time_column else facts


def rows_per_file(df: DataFrame) -> DataFrame:
    """Row count per input file; reads no data column."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count("*").alias("n_rows")
    )


#: Types whose bounds every parquet footer can give. NaN leaves a file without those of
#: doubles, texts may be cut off in footers, and Spark does not ask for those of timestamps.
BOUNDED_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


@contextmanager
def footer_aggregates(spark: SparkSession) -> Iterator[None]:
    """Let counts and bounds that a query asks for be read from parquet footers.

    Only Spark's second generation of sources does that, so it is switched on for
    parquet as long as the block lasts; plan and run the query inside.
    """
    sources = [name for name in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if name != "parquet"]
    wanted = {"spark.sql.sources.useV1SourceList": ",".join(sources), "spark.sql.parquet.aggregatePushdown": "true"}
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _bounds(columns: Sequence[str]) -> list[Column]:
    return [F.count("*").alias("n_rows")] + [
        bound(name).alias(f"{label}_{name}") for name in columns for label, bound in (("min", F.min), ("max", F.max))
    ]


def profile_files(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, columns: Sequence[str]
) -> DataFrame:
    """One row: ``n_rows``, and ``min_`` and ``max_`` of each column, reading as little as possible.

    Row count and bounds of whole numbers and dates come from the footers, so the cost
    goes with the number of files and not of rows. Other columns are scanned, by
    themselves; so is everything if a file was written without bounds.
    """
    paths = [path] if isinstance(path, str) else list(path)
    bounded = [name for name in columns if isinstance(schema[name].dataType, BOUNDED_TYPES)]
    scanned = [name for name in columns if name not in bounded]
    with footer_aggregates(spark):
        told = spark.read.schema(schema).parquet(*paths).agg(*_bounds(bounded))
        try:
            rows = told.collect()
        except (PySparkException, Py4JJavaError) as error:
            if "aggregatePushdown" not in str(error):
                raise
            rows = None
    files = spark.read.schema(schema).parquet(*paths)
    if rows is None:
        return files.agg(*_bounds(columns))
    known = rows[0].asDict()
    bounds = files.agg(*_bounds(scanned)) if scanned else spark.range(1)
    kinds = {field.name: field.dataType for field in told.schema}
    cells = [
        F.lit(known[name]).cast(kinds[name]).alias(name) if name in known else F.col(name)
        for name in ["n_rows", *[f"{label}_{name}" for name in columns for label in ("min", "max")]]
    ]
    return bounds.select(*cells)


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def read_zones_csv(spark: SparkSession, path: str, schema: T.StructType = ZONES_CSV) -> DataFrame:
    """Dimension CSV: all text, missing-cell tokens to NULL, upper-case names."""
    cells = spark.read.schema(schema).option("header", True).option("quote", '"').csv(path)
    return upper_names(
        cells.select([null_if_in(F.col(name), NA_TOKENS).alias(name) for name in cells.columns])
    )


def sample_month(
    df: DataFrame, month: str, rows: int, *, month_column: str = "SOURCE_MONTH", seed: int = 0
) -> DataFrame:
    """``rows`` random rows of one month, or all of them if there are fewer.

    Each row draws the MD5 of the seed and its cells, so the sample is the same however
    the rows are laid out, and of equal rows any may be taken. Draws far too large to be
    among the smallest are dropped first, so the final ordering sees little more than
    the sample however long the month is; should too few be left, all take part.
    """
    in_month_rows = df.where(F.col(month_column) == month)
    available = in_month_rows.count()
    if available <= rows:
        return in_month_rows
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in df.columns]
    drawn = in_month_rows.withColumn("_draw", F.md5(F.concat_ws("|", F.lit(str(seed)), *cells)))
    enough = (rows + 10 * rows**0.5 + 100) / available
    if enough < 1:
        near = drawn.where(F.col("_draw") < f"{int(enough * 16**8):08x}")
        drawn = near if near.count() >= rows else drawn
    return drawn.orderBy("_draw").limit(rows).drop("_draw")


def union_tagged(frames: dict[str, DataFrame], tag: str = "indicator_name") -> DataFrame:
    """Stack extracts, each tagged with its name in column ``tag``."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    stacked = tagged[0]
    for df in tagged[1:]:
        stacked = stacked.unionByName(df)
    return stacked


def column_differences(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """Missing and unexpected columns, from the schema alone."""
    return (
        sorted(set(expected) - set(df.columns)),
        sorted(set(df.columns) - set(expected)),
    )
