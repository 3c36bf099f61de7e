"""Indicator job: landed series documents to the change mart and its cards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from martwright.functions.labels import INVERSE_INDICATORS, NEUTRAL_INDICATORS, RATE_INDICATORS
from martwright.operators import quality
from martwright.operators.joins import hold
from martwright.operators.serving import cards, latest
from martwright.operators.staging import stage_series
from martwright.operators.windows import RATE_SERIES
from martwright.plans import contracts
from martwright.plans.audit import publish
from martwright.plans.contracts import SERIES_NAMES
from martwright.plans.marts import indicator_change, stamped
from martwright.schemas import RAW_SERIES
from martwright.session import work_scope
from martwright.sources.documents import refuse_rejected, series_documents, series_rows
from martwright.sources.landing import typed_raw
from martwright.sources.versions import read_refreshed, stage


@dataclass(frozen=True)
class IndicatorLimits:
    """What the singular tests of the mart allow. Defaults are fixed values."""

    bounded_series: str = "UNRATE"
    low: float = contracts.UNEMPLOYMENT_RANGE[0]
    high: float = contracts.UNEMPLOYMENT_RANGE[1]
    change: float = contracts.CHANGE_LIMIT
    warn_days: int = 45
    error_days: int = 60


def audit(
    raw: DataFrame,
    staged: DataFrame,
    mart: DataFrame,
    names: Sequence[str],
    limits: IndicatorLimits,
    as_of: date,
) -> DataFrame:
    """One line per check: both contracts, the two singular tests and the freshness of the load."""
    bounds = (limits.bounded_series, limits.low, limits.high)
    reports = [
        quality.run_contracts(
            {
                "stg_fred_observations": (staged, contracts.staged_series_contract(names)),
                "mart_economic_indicators": (mart, contracts.INDICATOR_CHANGE),
            },
            {},
        ),
        quality.no_rows(
            "mart_economic_indicators", "value_range", "value", quality.out_of_range(mart, *bounds)
        ),
        quality.no_rows(
            "mart_economic_indicators", "change_limit", "mom_change", quality.large_changes(mart, limits.change)
        ),
        quality.fresh(
            "fred_observations", raw, as_of, warn_days=limits.warn_days, error_days=limits.error_days
        ),
    ]
    return reduce(DataFrame.unionByName, reports)


def refresh(
    spark: SparkSession,
    landing: str,
    folder: str,
    names: Mapping[str, str] = SERIES_NAMES,
    rate_series: Sequence[str] = tuple(RATE_SERIES),
    limits: IndicatorLimits | None = None,
    as_of: date | None = None,
) -> DataFrame:
    """Reload every series, since history gets revised, and rebuild the mart.

    A document that cannot be read stops the reload: without it, its history would be
    gone from the new version. Such documents are listed in ``rejected_documents``. The
    new versions of both tables are audited before either becomes readable; if a check
    fails ``AuditFailed`` is raised and readers keep what they have.
    """
    with work_scope(spark):
        documents = hold(series_documents(spark, landing))
        refuse_rejected(documents, f"{folder}/rejected_documents")
        raw = stage(typed_raw(series_rows(documents, names), RAW_SERIES), f"{folder}/raw_series")
        staged = stage_series(raw.rows)
        path = f"{folder}/mart_economic_indicators"
        mart = stage(stamped(indicator_change(staged, rate_series)), path)
        day = date.today() if as_of is None else as_of
        known = list(dict.fromkeys(names.values()))
        report = audit(raw.rows, staged, mart.rows, known, limits or IndicatorLimits(), day)
        publish([raw, mart], report, f"{folder}/audit_log")
    return read_refreshed(spark, path)


def headline(
    mart: DataFrame,
    rates: Sequence[str] = tuple(RATE_INDICATORS),
    inverse: Sequence[str] = tuple(INVERSE_INDICATORS),
    neutral: Sequence[str] = tuple(NEUTRAL_INDICATORS),
) -> DataFrame:
    """One card per indicator from its newest known value and change."""
    shown = mart.select("indicator_name", "observation_date", "value", "mom_change")
    return cards(latest(shown), rates, inverse, neutral)
