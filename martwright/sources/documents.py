"""JSON documents as the two statistics APIs deliver them, one folder per series.

A document is one API answer, so reading it whole in one task is bounded by the
API's page size; the folder of documents is what grows.

A document that cannot be read – cut off, empty, no JSON, or without the part that
holds the rows – is never passed over in silence. ``series_documents`` and
``country_documents`` keep it with its file name and the reason, ``rejected`` lists
such documents, and the readers below fail on them unless told to ``skip`` them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.casts import safe_double
from martwright.functions.labels import recode
from martwright.schemas import COUNTRY_ROWS, SERIES_DOCUMENT
from martwright.sources.versions import file_system


class UnreadableDocuments(RuntimeError):
    """A load met documents it cannot read and left its table as it was."""


def _hollow_files(spark: SparkSession, path: str) -> list[str]:
    """Files of no bytes, which Spark's readers pass over. The driver lists names, as for any scan."""
    fs, where = file_system(spark, path)
    found, files = [], fs.listFiles(where, True)
    while files.hasNext():
        status = files.next()
        if status.getLen() == 0 and not status.getPath().getName().startswith(("_", ".")):
            found.append(status.getPath().toString())
    return found


def _texts(spark: SparkSession, path: str, identifier: str) -> DataFrame:
    """One row per file, also of those without bytes."""
    texts = spark.read.schema(f"value string, {identifier} string").text(path, wholetext=True)
    read = texts.select(identifier, F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("body"))
    hollow = _hollow_files(spark, path)
    if not hollow:
        return read
    rows = [(next(iter(re.findall(f"/{identifier}=([^/]*)/", name)), None), name, "") for name in hollow]
    return read.unionByName(spark.createDataFrame(rows, read.schema))


def series_documents(spark: SparkSession, path: str) -> DataFrame:
    """``series_id=<id>/*.json`` with the ``observations`` of each, or the ``reason`` it has none."""
    parsed = F.from_json("body", SERIES_DOCUMENT, {"columnNameOfCorruptRecord": "corrupt"})
    read = _texts(spark, path, "series_id").withColumn("document", parsed)
    reason = (
        F.when(F.trim(F.col("body"), F.lit(" \t\r\n")) == "", "empty")
        .when(F.col("document.corrupt").isNotNull() | F.col("document").isNull(), "not a whole JSON document")
        .when(F.col("document.observations").isNull(), "no observations")
    )
    return read.select(
        "series_id", "file_path", reason.alias("reason"), F.length("body").alias("n_chars"),
        F.when(reason.isNull(), F.col("document.observations")).alias("observations"),
    )


def country_documents(spark: SparkSession, path: str) -> DataFrame:
    """``indicator_id=<id>/*.json`` with the ``rows`` of each, or the ``reason`` it cannot be read.

    An error answer – whole JSON without rows – is no such document: it has NULL rows
    and no reason.
    """
    pair = F.from_json("body", "array<string>")
    single = F.from_json("body", "map<string, string>")
    read = _texts(spark, path, "indicator_id").withColumns({"pair": pair, "single": single})
    second = F.get("pair", F.lit(1))
    rows = F.from_json(second, COUNTRY_ROWS)
    reason = (
        F.when(F.trim(F.col("body"), F.lit(" \t\r\n")) == "", "empty")
        .when(F.col("pair").isNull() & F.col("single").isNull(), "not a whole JSON document")
        .when(second.isNotNull() & rows.isNull(), "rows of another layout")
    )
    return read.select(
        "indicator_id", "file_path", reason.alias("reason"), F.length("body").alias("n_chars"),
        F.when(reason.isNull(), rows).alias("rows"),
    )


def rejected(documents: DataFrame) -> DataFrame:
    """Documents that cannot be read: series or indicator, file, reason and size."""
    return documents.where(F.col("reason").isNotNull()).select(
        F.col(documents.columns[0]).alias("source_id"), "file_path", "reason", "n_chars"
    )


def refuse_rejected(documents: DataFrame, side_table: str | None = None) -> None:
    """Raise ``UnreadableDocuments`` if there is any, naming the first ones.

    All of them are appended to ``side_table``, with the time they were found.
    """
    found = rejected(documents)
    first = found.orderBy("file_path").limit(6).collect()
    if not first:
        return
    if side_table is not None:
        found.withColumn("found_at", F.current_timestamp()).write.mode("append").parquet(side_table)
    told = "; ".join(f"{row.file_path}: {row.reason}" for row in first[:5])
    raise UnreadableDocuments(told + ("; and more" if len(first) > 5 else ""))


def _exploded(documents: DataFrame, array: str, skip: bool) -> DataFrame:
    """One row per element. Without ``skip`` a rejected document fails the job that reads it."""
    if skip:
        kept = documents.where(F.col("reason").isNull())
        return kept.select(kept.columns[0], F.explode(array).alias("row"))
    problem = F.concat_ws(": ", "file_path", "reason")
    failing = F.when(F.col("reason").isNotNull(), F.raise_error(problem)).otherwise(F.col(array))
    return documents.select(documents.columns[0], F.explode(failing.cast(documents.schema[array].dataType)).alias("row"))


def _named(identifier: Column, names: Mapping[str, str]) -> Column:
    return recode(identifier, dict(names))


def _observations(documents: DataFrame, skip: bool) -> DataFrame:
    return _exploded(documents, "observations", skip).select(
        "series_id",
        F.to_date("row.date", "yyyy-MM-dd").alias("date"),
        F.col("row.value").alias("value"),
    )


def series_rows(documents: DataFrame, names: Mapping[str, str], *, skip: bool = False) -> DataFrame:
    """One row per observation; a value that is no number becomes NULL."""
    return _observations(documents, skip).select(
        "date",
        safe_double(F.col("value")).alias("value"),
        _named(F.col("series_id"), names).alias("indicator_name"),
        "series_id",
    )


def strict_series_rows(documents: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """As ``series_rows``, but only ``"."`` is a missing value; other junk fails the job."""
    return _observations(documents, False).select(
        "series_id",
        _named(F.col("series_id"), names).alias("series_name"),
        "date",
        F.nullif("value", F.lit(".")).cast("double").alias("value"),
    )


def country_rows(documents: DataFrame, names: Mapping[str, str], *, skip: bool = False) -> DataFrame:
    """One row per country and year with a value."""
    rows = _exploded(documents, "rows", skip)
    return rows.where(F.col("row.value").isNotNull()).select(
        F.col("row.countryiso3code").alias("country_code"),
        F.col("row.country.value").alias("country_name"),
        "indicator_id",
        _named(F.col("indicator_id"), names).alias("indicator_name"),
        F.col("row.date").cast("int").alias("year"),
        F.col("row.value").alias("value"),
    )


def read_series(spark: SparkSession, path: str, names: Mapping[str, str], *, skip: bool = False) -> DataFrame:
    """``series_id=<id>/*.json`` to one row per observation; unusable values become NULL.

    A document that cannot be read fails the job, with ``skip`` it is left out.
    """
    return series_rows(series_documents(spark, path), names, skip=skip)


def read_series_strict(spark: SparkSession, path: str, names: Mapping[str, str]) -> DataFrame:
    """As ``read_series``, but only ``"."`` is a missing value; other junk fails the job."""
    return strict_series_rows(series_documents(spark, path), names)


def read_country_indicators(
    spark: SparkSession, path: str, names: Mapping[str, str], *, skip: bool = False
) -> DataFrame:
    """``indicator_id=<id>/*.json``, each ``[meta, rows]``, to one row per country and year.

    An error answer gives no rows; neither does a null value. A document that cannot be
    read fails the job, with ``skip`` it is left out.
    """
    return country_rows(country_documents(spark, path), names, skip=skip)
