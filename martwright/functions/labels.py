"""Display texts of the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment codes with a name of their own; every other code is OTHER_PAYMENT.
PAYMENT_LABELS = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}
OTHER_PAYMENT = "Other"

# Which indicators are rates, and how their change is coloured.
RATE_INDICATORS = ["Unemployment Rate", "Federal Funds Rate"]
INVERSE_INDICATORS = ["CPI (Index)", "Unemployment Rate"]
NEUTRAL_INDICATORS = ["Federal Funds Rate"]
NOT_AVAILABLE = "N/A"


def recode(col: Column, labels: dict, default: str | None = None) -> Column:
    """Replace codes by labels; anything else, NULL included, becomes ``default``."""
    (first, label), *rest = labels.items()
    chain = F.when(col == first, label)
    for code, label in rest:
        chain = chain.when(col == code, label)
    return chain.otherwise(default)


def payment_label(code: Column) -> Column:
    return recode(code, PAYMENT_LABELS, OTHER_PAYMENT)


def _number_text(value: Column, pattern: str) -> Column:
    return F.call_function("format_number", value, F.lit(pattern))


def value_text(
    indicator: Column, value: Column, rates: Sequence[str] = tuple(RATE_INDICATORS)
) -> Column:
    """``4.25%`` for rates, ``1,234.56`` for everything else."""
    return (
        F.when(value.isNull() | F.isnan(value), NOT_AVAILABLE)
        .when(indicator.isin(*rates), F.concat(_number_text(value, "0.00"), F.lit("%")))
        .otherwise(_number_text(value, "#,##0.00"))
    )


def change_text(
    indicator: Column, change: Column, rates: Sequence[str] = tuple(RATE_INDICATORS)
) -> Column:
    """Signed ``+0.10 pp`` for rates, ``-1.25%`` for everything else."""
    signed = _number_text(change, "+0.00;-0.00")
    return (
        F.when(change.isNull() | F.isnan(change), NOT_AVAILABLE)
        .when(indicator.isin(*rates), F.concat(signed, F.lit(" pp")))
        .otherwise(F.concat(signed, F.lit("%")))
    )


def change_polarity(
    indicator: Column,
    inverse: Sequence[str] = tuple(INVERSE_INDICATORS),
    neutral: Sequence[str] = tuple(NEUTRAL_INDICATORS),
) -> Column:
    """How a rise is shown: ``inverse`` (bad), ``off`` (no colour) or ``normal``."""
    return (
        F.when(indicator.isin(*inverse), "inverse")
        .when(indicator.isin(*neutral), "off")
        .otherwise("normal")
    )


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour.cast("int"))
