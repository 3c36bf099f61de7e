"""Casts that turn unusable text into NULL instead of failing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts a pandas-style CSV reader takes for a missing cell.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Texts a missing cell of a typed column becomes when stringified.
MISSING_TEXTS = ["nan", "NaN", "NaT", "None"]


def null_if_in(col: Column, tokens: Iterable[str]) -> Column:
    """NULL where the text is one of ``tokens``."""
    return F.when(~col.isin(*tokens), col)


def parse_number(text: Column) -> Column:
    """Double from text or NULL; may be NaN or infinite.

    The JVM parser also takes a trailing type letter (``1.5d``); that is junk here.
    """
    typed_literal = F.substring(F.rtrim(text), -1, 1).isin("D", "d", "F", "f")
    return F.when(~typed_literal, text).try_cast("double")


def finite(number: Column) -> Column:
    """NULL for NaN and the infinities, which count as missing."""
    return F.when(F.abs(number) < float("inf"), number)


def whole(number: Column) -> Column:
    """Integer with halves away from zero, NULL outside the integer range."""
    return (F.signum(number) * F.floor(F.abs(number) + 0.5)).try_cast("int")


def safe_double(col: Column) -> Column:
    """Finite number or NULL, of one text column; for many see ``parse_columns``."""
    return finite(parse_number(col.cast("string")))


def safe_int(col: Column) -> Column:
    """Integer or NULL from text such as ``'1'`` or ``'1.0'``."""
    return whole(parse_number(col.cast("string")))


def safe_time(col: Column) -> Column:
    """Zone-less timestamp or NULL."""
    return col.try_cast("timestamp_ntz")


def parse_columns(
    df: DataFrame,
    *,
    measures: Mapping[str, str] | None = None,
    integers: Mapping[str, str] | None = None,
    times: Mapping[str, str] | None = None,
    keep: Mapping[str, str] | None = None,
) -> DataFrame:
    """Type many text columns, ``{output: input}``, parsing each cell once.

    Parsing and rounding are two projections: Spark does not merge them, since
    that would parse again wherever a number is used, and the generated code
    stays small enough for the JVM to compile.
    """
    measures, integers, times, keep = (part or {} for part in (measures, integers, times, keep))
    numbers = {**measures, **integers}
    parsed = df.select(
        *[parse_number(F.col(source)).alias(name) for name, source in numbers.items()],
        *[safe_time(F.col(source)).alias(name) for name, source in times.items()],
        *[F.col(source).alias(name) for name, source in keep.items()],
    )
    return parsed.select(
        *[finite(F.col(name)).alias(name) for name in measures],
        *[whole(F.col(name)).alias(name) for name in integers],
        *times,
        *keep,
    )
