"""Country snapshot job: two landed sources, loaded past their watermarks, to one mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators import quality
from martwright.operators.incremental import after_watermark, merge_into
from martwright.operators.joins import country_with_us, hold
from martwright.operators.reshape import annual, widen
from martwright.operators.staging import stage_country, stage_series_with_value
from martwright.plans import contracts
from martwright.plans.audit import publish
from martwright.plans.contracts import (
    COUNTRIES,
    COUNTRY_COLUMNS,
    COUNTRY_INDICATORS,
    SNAPSHOT_SERIES,
    US_COLUMNS,
)
from martwright.plans.marts import SNAPSHOT_FIRST_YEAR, country_snapshot, stamped
from martwright.schemas import RAW_COUNTRY, RAW_SERIES_NAMED
from martwright.session import work_scope
from martwright.sources.documents import (
    country_documents,
    country_rows,
    refuse_rejected,
    series_documents,
    strict_series_rows,
)
from martwright.sources.landing import typed_raw
from martwright.sources.sinks import read_if_exists
from martwright.sources.versions import read_refreshed, stage

# Where loading starts for a series or country not seen before.
FIRST_DATE = date(2000, 1, 1)
FIRST_YEAR = 2000


# Stored layout of the series: partitioned by year, so a load rewrites recent years only.
STORED_SERIES = T.StructType([*RAW_SERIES_NAMED, T.StructField("year", T.IntegerType())])


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    stored = read_if_exists(spark, path, schema)
    return spark.createDataFrame([], schema) if stored is None else stored


def load_series(spark: SparkSession, landing: str, path: str, names: Mapping[str, str]) -> None:
    """Add observations from each series' newest date on; that date is read again and replaced.

    A document that cannot be read stops the load: its observations would be passed over
    for good once the series has gone on.
    """
    documents = hold(series_documents(spark, landing))
    refuse_rejected(documents, f"{path}_rejected_documents")
    stored = _stored(spark, path, STORED_SERIES)
    delivered = typed_raw(strict_series_rows(documents, names), RAW_SERIES_NAMED)
    fresh = after_watermark(
        delivered, stored, ["series_id"], "date", F.lit(FIRST_DATE), inclusive=True
    )
    by_year = fresh.withColumn("year", F.year("date"))
    merge_into(by_year, path, ["series_id", "date"], "year", f"{path}_merging")


def load_country(
    spark: SparkSession,
    landing: str,
    path: str,
    names: Mapping[str, str],
    first_year: int = FIRST_YEAR,
) -> None:
    """Add years after the newest loaded one of each indicator and country.

    A document that cannot be read stops the load, an error answer does not.
    """
    documents = hold(country_documents(spark, landing))
    refuse_rejected(documents, f"{path}_rejected_documents")
    stored = _stored(spark, path, RAW_COUNTRY)
    delivered = typed_raw(country_rows(documents, names), RAW_COUNTRY)
    series = ["indicator_id", "country_code"]
    fresh = after_watermark(
        delivered, stored, series, "year", F.lit(first_year), inclusive=False
    )
    merge_into(fresh, path, [*series, "year"], "year", f"{path}_merging")


def country_years(
    country: DataFrame,
    series: DataFrame,
    country_columns: Mapping[str, str] = COUNTRY_COLUMNS,
    us_columns: Mapping[str, str] = US_COLUMNS,
) -> DataFrame:
    """Staged country and US rows to one row per country and year."""
    keys = ["country_code", "country_name", "observation_year"]
    wide = widen(country, keys, "indicator_id", "indicator_value", country_columns)
    return country_with_us(wide, annual(series, us_columns))


def audit(
    series: DataFrame,
    country: DataFrame,
    mart: DataFrame,
    series_ids: Sequence[str] = tuple(SNAPSHOT_SERIES),
    codes: Sequence[str] = tuple(COUNTRIES),
    indicator_ids: Sequence[str] = tuple(COUNTRY_INDICATORS),
) -> DataFrame:
    """One line for each of the 14 contract checks of both staged sources and the mart."""
    return quality.run_contracts(
        {
            "stg_fred_observations": (series, contracts.snapshot_series_contract(series_ids)),
            "stg_worldbank_indicators": (country, contracts.country_contract(codes, indicator_ids)),
            "mart_global_economic_snapshot": (mart, contracts.COUNTRY_SNAPSHOT),
        },
        {},
    )


def refresh(
    spark: SparkSession,
    series_landing: str,
    country_landing: str,
    folder: str,
    *,
    series_names: Mapping[str, str] = SNAPSHOT_SERIES,
    indicator_names: Mapping[str, str] = COUNTRY_INDICATORS,
    country_codes: Sequence[str] = tuple(COUNTRIES),
    country_columns: Mapping[str, str] = COUNTRY_COLUMNS,
    us_columns: Mapping[str, str] = US_COLUMNS,
    load_after_year: int = FIRST_YEAR,
    first_year: int = SNAPSHOT_FIRST_YEAR,
) -> DataFrame:
    """Load both sources past their watermarks and rebuild the mart.

    The new mart becomes readable only if it and both staged sources keep their
    contracts; otherwise ``AuditFailed`` is raised and readers keep what they have.
    """
    with work_scope(spark):
        load_series(spark, series_landing, f"{folder}/raw_series", series_names)
        load_country(spark, country_landing, f"{folder}/raw_country", indicator_names, load_after_year)
        series = stage_series_with_value(_stored(spark, f"{folder}/raw_series", STORED_SERIES))
        country = stage_country(_stored(spark, f"{folder}/raw_country", RAW_COUNTRY))
        joined = country_years(country, series, country_columns, us_columns)
        path = f"{folder}/mart_global_economic_snapshot"
        mart = stage(stamped(country_snapshot(joined, first_year)), path)
        report = audit(series, country, mart.rows, list(series_names), country_codes, list(indicator_names))
        publish([mart], report, f"{folder}/audit_log")
    return read_refreshed(spark, path)
