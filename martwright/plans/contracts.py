"""What every table promises. All literals in this module are fixed values."""

from __future__ import annotations

from collections.abc import Sequence

from martwright.operators.quality import (
    Check,
    Contract,
    between,
    column_set,
    greater,
    in_set,
    not_null,
    row_count,
)
from martwright.schemas import RAW_TRIP_COLUMNS

LOADED_MONTHS = ["2025-11", "2025-12", "2026-01"]
SAMPLE_ROWS = (200_000, 600_000)
MONTH_ROWS = (2_000_000, 6_000_000)

VENDORS = [1, 2, 6, 7]
RATE_CODES = [1, 2, 3, 4, 5, 6, 99]
RATE_CODE_TEXTS = ["1.0", "2.0", "3.0", "4.0", "5.0", "6.0", "99.0"]
PAYMENT_CODES = [0, 1, 2, 3, 4, 5, 6]
BOROUGHS = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR", "Unknown"]
SERIES_NAMES = {
    "GDP": "GDP (Billions USD)",
    "CPIAUCSL": "CPI (Index)",
    "UNRATE": "Unemployment Rate",
    "FEDFUNDS": "Federal Funds Rate",
    "HOUST": "Housing Starts (000s)",
    "RSXFS": "Retail Sales (Millions USD)",
}
SNAPSHOT_SERIES = {
    "GNPCA": "real_gnp",
    "UNRATE": "unemployment_rate",
    "CPIAUCSL": "cpi",
}
COUNTRY_INDICATORS = {
    "NY.GDP.MKTP.CD": "gdp_current_usd",
    "FP.CPI.TOTL.ZG": "inflation_rate",
    "SL.UEM.TOTL.ZS": "unemployment_rate",
}
COUNTRIES = ["USA", "GBR", "DEU", "JPN", "IND", "BRA", "CHN"]
COUNTRY_COLUMNS = {
    "gdp_usd": "NY.GDP.MKTP.CD",
    "inflation_rate": "FP.CPI.TOTL.ZG",
    "unemployment_rate": "SL.UEM.TOTL.ZS",
}
US_COLUMNS = {
    "us_unemployment_fred": "UNRATE",
    "us_cpi_fred": "CPIAUCSL",
    "us_real_gnp_fred": "GNPCA",
}
UNEMPLOYMENT_RANGE = (0.0, 25.0)
INTEREST_RANGE = (0.0, 30.0)
CHANGE_LIMIT = 50.0

RAW_NOT_NULL = [
    "VENDORID",
    "TPEP_PICKUP_DATETIME",
    "TPEP_DROPOFF_DATETIME",
    "TRIP_DISTANCE",
    "PULOCATIONID",
    "DOLOCATIONID",
    "PAYMENT_TYPE",
    "FARE_AMOUNT",
    "TOTAL_AMOUNT",
    "SOURCE_MONTH",
]


def raw_trip_suite(
    rows: tuple[int, int] = MONTH_ROWS, columns: Sequence[str] = tuple(RAW_TRIP_COLUMNS)
) -> list[Check]:
    """The gate in front of the marts: 16 checks on one month of raw trips.

    Expects times and the checked measures already coerced (``coerce_for_checks``).
    """
    return [
        *[not_null(column) for column in RAW_NOT_NULL],
        greater("TPEP_DROPOFF_DATETIME", "TPEP_PICKUP_DATETIME", mostly=0.97),
        between("FARE_AMOUNT", low=0, mostly=0.88),
        between("TRIP_DISTANCE", low=0, mostly=0.95),
        in_set("RATECODEID", RATE_CODE_TEXTS, mostly=0.97),
        row_count(*rows),
        column_set(columns),
    ]


def staged_trips_contract(months: Sequence[str] = tuple(LOADED_MONTHS)) -> Contract:
    required = [
        "vendor_id",
        "pickup_datetime",
        "dropoff_datetime",
        "trip_distance",
        "pickup_location_id",
        "dropoff_location_id",
        "payment_type",
        "fare_amount",
        "total_amount",
        "source_month",
        "trip_duration_minutes",
        "pickup_date",
    ]
    return Contract(
        checks=(
            *[not_null(column) for column in required],
            in_set("vendor_id", VENDORS),
            in_set("rate_code_id", RATE_CODES),
            in_set("payment_type", PAYMENT_CODES),
            in_set("source_month", months),
        ),
        references={
            "pickup_location_id": ("zones", "location_id"),
            "dropoff_location_id": ("zones", "location_id"),
        },
    )


def zones_contract(boroughs: Sequence[str] = tuple(BOROUGHS)) -> Contract:
    return Contract(
        checks=(not_null("location_id"), in_set("borough", boroughs)), unique=("location_id",)
    )


TRIPS_JOINED = Contract(checks=(not_null("pickup_datetime"),))
DAILY_REVENUE = Contract(
    checks=tuple(
        not_null(c) for c in ("pickup_date", "pickup_borough", "total_trips", "total_revenue")
    )
)
PICKUP_ZONES = Contract(
    checks=(
        *[not_null(c) for c in ("pickup_borough", "pickup_zone", "hour_of_day", "total_trips")],
        in_set("hour_of_day", range(24)),
    )
)
PAYMENT_SUMMARY = Contract(
    checks=tuple(not_null(c) for c in ("payment_type", "payment_label", "total_trips")),
    unique=("payment_type",),
)
TRIP_DURATION = Contract(
    checks=tuple(not_null(c) for c in ("trip_date", "pickup_borough", "total_trips"))
)


def staged_series_contract(names: Sequence[str] = tuple(SERIES_NAMES.values())) -> Contract:
    return Contract(
        checks=(
            not_null("observation_date"),
            not_null("indicator_name"),
            not_null("series_id"),
            in_set("indicator_name", names),
        )
    )


INDICATOR_CHANGE = Contract(checks=(not_null("observation_date"), not_null("indicator_name")))


def snapshot_series_contract(ids: Sequence[str] = tuple(SNAPSHOT_SERIES)) -> Contract:
    return Contract(
        checks=(
            not_null("series_id"),
            in_set("series_id", ids),
            not_null("observation_date"),
            not_null("indicator_value"),
        )
    )


def country_contract(
    codes: Sequence[str] = tuple(COUNTRIES), ids: Sequence[str] = tuple(COUNTRY_INDICATORS)
) -> Contract:
    return Contract(
        checks=(
            not_null("country_code"),
            in_set("country_code", codes),
            not_null("indicator_id"),
            in_set("indicator_id", ids),
            not_null("observation_year"),
            not_null("indicator_value"),
        )
    )


COUNTRY_SNAPSHOT = Contract(
    checks=tuple(
        not_null(c) for c in ("country_code", "country_name", "observation_year", "updated_at")
    )
)
