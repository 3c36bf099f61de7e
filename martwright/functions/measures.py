"""Totals and means that come out the same whatever order the rows arrive in.

A sum of doubles depends on task order, so a retried or re-planned job could print
another cent. A measure is summed in three BIGINT parts instead: whole numbers,
ten-thousandths, and what a value has beyond those. They stay in generated code, where a
DECIMAL sum took ten times as long on 80 million rows. Nothing is rounded away before it is
added, and a total past the range of a BIGINT falls back to the sum of doubles, under ANSI
or not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS_PER_ONE = 10_000
#: Steps of the part beyond ten-thousandths: 2^-44, some 6e-14.
FINE_PER_ONE = float(1 << 44)
#: A value as large as this is only in the sum of doubles.
LARGEST_WHOLE = float(1 << 62)
#: From here on a double has no digits behind the point.
ALL_WHOLE = float(1 << 53)


def exact_sum(col: Column) -> Column:
    """Aggregate: the sum of a measure as a struct that ``merged`` can add up further.

    NULL and NaN stay out. A value printed with four decimals or fewer is exactly its
    ten-thousandths; of any other, the rest is added in steps of 2^-44.
    """
    value = F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    inside = F.when(F.abs(value) < LARGEST_WHOLE, value)
    whole = F.floor(inside)
    units = F.floor((inside - whole) * UNITS_PER_ONE + 0.5)
    printed = (whole * float(UNITS_PER_ONE) + units) / float(UNITS_PER_ONE)
    beyond = F.when(printed == inside, F.lit(0.0)).otherwise(
        inside - whole - units / float(UNITS_PER_ONE)
    )
    return F.struct(
        F.try_sum(whole.cast("bigint")).alias("whole"),
        F.sum(units.cast("bigint")).alias("units"),
        F.sum(F.floor(beyond * FINE_PER_ONE + 0.5).cast("bigint")).alias("fine"),
        F.sum(value).alias("plain"),
        F.max(F.abs(value)).alias("largest"),
    )


def merged(name: str) -> Column:
    """Aggregate: sums of ``exact_sum`` added up."""
    part = F.col(name)
    return F.struct(
        F.when(F.bool_and(part["whole"].isNotNull() | part["plain"].isNull()), F.try_sum(part["whole"])).alias("whole"),
        F.sum(part["units"]).alias("units"),
        F.sum(part["fine"]).alias("fine"),
        F.sum(part["plain"]).alias("plain"),
        F.max(part["largest"]).alias("largest"),
    )


def value_of(added: Column) -> Column:
    """The sum as a double, NULL without values."""
    units = added["whole"].cast("decimal(38,0)") * UNITS_PER_ONE + added["units"]
    exact = units.cast("double") / float(UNITS_PER_ONE) + added["fine"] / FINE_PER_ONE
    return F.when((added["largest"] < LARGEST_WHOLE) & added["whole"].isNotNull(), exact).otherwise(
        added["plain"]
    )


def round_half_up(col: Column, digits: int) -> Column:
    """Round a double, ties away from zero, never giving a negative zero.

    A value too large to have the digits that would go is returned as it is.
    """
    scale = float(10**digits)
    rounded = F.signum(col) * F.floor(F.abs(col) * scale + 0.5) / scale + F.lit(0.0)
    return F.when(F.abs(col) * scale < ALL_WHOLE, rounded).otherwise(col)


def ratio_of(total: Column, rows: Column) -> Column:
    """``total / rows`` as a double, NULL when there are no rows."""
    return F.try_divide(total.cast("double"), rows)


def total(name: str, digits: int = 2) -> Column:
    """Aggregate: exact sum, rounded."""
    return round_half_up(value_of(exact_sum(F.col(name))), digits)


def mean(name: str, digits: int = 2) -> Column:
    """Aggregate: mean of the non-null values from the exact sum, rounded."""
    return round_half_up(plain_mean(name), digits)


def plain_mean(name: str) -> Column:
    """Aggregate: mean of the non-null values from the exact sum."""
    values = F.count(F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")))
    return ratio_of(value_of(exact_sum(F.col(name))), values)
