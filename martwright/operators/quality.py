"""Data-quality checks as data, evaluated in one pass over the table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.operators.joins import hold
from martwright.sources.files import column_differences


#: Starts the names of the columns that tell whether a reference has its parent.
KNOWN = "_known_"


@dataclass(frozen=True)
class Check:
    """One expectation. ``mostly`` is the share of evaluated rows that must pass."""

    kind: str
    column: str = ""
    other: str = ""
    low: float | None = None
    high: float | None = None
    values: tuple = field(default=())
    mostly: float = 1.0


def not_null(column: str) -> Check:
    return Check("not_null", column)


def greater(column: str, other: str, mostly: float = 1.0) -> Check:
    """``column > other``; rows with both NULL are left out, one NULL fails."""
    return Check("greater", column, other=other, mostly=mostly)


def between(
    column: str, low: float | None = None, high: float | None = None, mostly: float = 1.0
) -> Check:
    """Inclusive range over the non-null values."""
    return Check("between", column, low=low, high=high, mostly=mostly)


def in_set(column: str, values: Sequence, mostly: float = 1.0) -> Check:
    """Membership over the non-null values."""
    return Check("in_set", column, values=tuple(values), mostly=mostly)


def row_count(low: int, high: int) -> Check:
    return Check("row_count", low=low, high=high)


def column_set(columns: Sequence[str]) -> Check:
    return Check("column_set", values=tuple(columns))


def _within(col: Column, low: float | None, high: float | None) -> Column:
    held = F.lit(True)
    if low is not None:
        held = held & (col >= low)
    if high is not None:
        held = held & (col <= high)
    return held


def _evaluated_and_held(check: Check) -> tuple[Column, Column]:
    """Whether a row takes part in the check, and whether it passes."""
    column = F.col(check.column)
    if check.kind == "not_null":
        return F.lit(True), column.isNotNull()
    if check.kind == "greater":
        other = F.col(check.other)
        return column.isNotNull() | other.isNotNull(), F.coalesce(column > other, F.lit(False))
    if check.kind == "between":
        return column.isNotNull(), _within(column, check.low, check.high)
    if check.kind == "relationship":
        return column.isNotNull(), F.col(check.other).isNotNull()
    if check.kind == "in_set":
        return column.isNotNull(), column.isin(*check.values)
    raise ValueError(f"unknown check {check.kind}")


def run_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One report row per check: rows evaluated, rows failing, share passing, verdict.

    All row checks share one aggregation, so the table is read once however long
    the suite is.
    """
    counts: list[Column] = [F.count("*").alias("all_rows")]
    lines: list[Column] = []
    for number, check in enumerate(checks):
        if check.kind == "row_count":
            evaluated = F.col("all_rows")
            failing = F.lit(0).cast("bigint")
            passed = _within(evaluated, check.low, check.high)
        elif check.kind == "column_set":
            own = df.select([name for name in df.columns if not name.startswith(KNOWN)])
            wrong = sum(len(names) for names in column_differences(own, check.values))
            evaluated = F.lit(len(own.columns)).cast("bigint")
            failing = F.lit(wrong).cast("bigint")
            passed = F.lit(wrong == 0)
        else:
            takes_part, holds = _evaluated_and_held(check)
            counts.append(F.count_if(takes_part).alias(f"seen_{number}"))
            counts.append(F.count_if(takes_part & ~holds).alias(f"bad_{number}"))
            evaluated, failing = F.col(f"seen_{number}"), F.col(f"bad_{number}")
            share = F.coalesce(F.try_divide(evaluated - failing, evaluated), F.lit(1.0))
            passed = share >= check.mostly
        if check.kind in ("row_count", "column_set"):
            share = F.when(passed, F.lit(1.0)).otherwise(F.lit(0.0))
        lines.append(
            F.struct(
                F.lit(number + 1).alias("check_no"),
                F.lit(check.kind).alias("check_kind"),
                F.lit(check.column).alias("column_name"),
                evaluated.alias("n_evaluated"),
                failing.alias("n_failing"),
                share.alias("passing_share"),
                F.lit(check.mostly).alias("threshold"),
                passed.alias("passed"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def suite_verdict(report: DataFrame) -> DataFrame:
    """Totals of a report and whether every check passed."""
    return report.agg(
        F.count("*").alias("n_checks"),
        F.count_if("passed").alias("n_passed"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        F.bool_and("passed").alias("success"),
    )


def suite_passed(report: DataFrame) -> bool:
    return bool(suite_verdict(report).first()["success"])


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def unaccepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Non-null values outside the accepted ones, with their number of rows."""
    return (
        df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n_rows"))
    )


@dataclass(frozen=True)
class Contract:
    """Checks a model must pass: row checks, unique columns and references.

    ``references`` maps a column to ``(parent table name, parent column)``.
    """

    checks: tuple[Check, ...]
    unique: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    def size(self) -> int:
        return len(self.checks) + len(self.unique) + len(self.references)


def with_known_parents(
    df: DataFrame, contract: Contract, parents: dict[str, DataFrame]
) -> tuple[DataFrame, list[Check]]:
    """The table with a mark per reference, set where the parent exists, and checks of the marks."""
    held: dict[tuple[str, str], DataFrame] = {}
    checks = []
    for number, (column, source) in enumerate(contract.references.items()):
        table, parent_column = source
        if source not in held:
            held[source] = hold(parents[table].select(parent_column).distinct())
        mark = f"{KNOWN}{number}"
        known = held[source].select(F.col(parent_column).alias(column), F.lit(True).alias(mark))
        df = df.join(known, column, "left")
        checks.append(Check("relationship", column, other=mark))
    return df, checks


def run_contract(df: DataFrame, contract: Contract, parents: dict[str, DataFrame]) -> DataFrame:
    """``(check_kind, column_name, n_failing, passed)`` for every check of a contract.

    Row checks and references share one pass over the table; every unique column needs
    one of its own.
    """
    marked, references = with_known_parents(df, contract, parents)
    report = run_suite(marked, [*contract.checks, *references])
    report = report.select("check_kind", "column_name", "n_failing", "passed")
    for column in contract.unique:
        line = repeated_values(df, column).agg(F.count("*").alias("n_failing")).select(
            F.lit("unique").alias("check_kind"),
            F.lit(column).alias("column_name"),
            "n_failing",
            (F.col("n_failing") == 0).alias("passed"),
        )
        report = report.unionByName(line)
    return report


def run_contracts(
    models: dict[str, tuple[DataFrame, Contract]], parents: dict[str, DataFrame]
) -> DataFrame:
    """The contract reports of several models, with the model's name."""
    reports = [
        run_contract(df, contract, parents).select(F.lit(name).alias("model"), "*")
        for name, (df, contract) in models.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def no_rows(model: str, kind: str, column: str, failing: DataFrame) -> DataFrame:
    """A report line for a test that passes if ``failing`` has no rows."""
    return failing.agg(F.count("*").alias("n_failing")).select(
        F.lit(model).alias("model"),
        F.lit(kind).alias("check_kind"),
        F.lit(column).alias("column_name"),
        "n_failing",
        (F.col("n_failing") == 0).alias("passed"),
    )


def fresh(model: str, df: DataFrame, as_of: date, *, at: str = "loaded_at", **limits: int) -> DataFrame:
    """A report line on the age of the newest load: an ``error`` fails, a ``warn`` does not."""
    stale = freshness(df, as_of, at=at, **limits).where(F.col("status") == "error")
    return no_rows(model, "freshness", at, stale)


def out_of_order(trips: DataFrame) -> DataFrame:
    """Trips that do not end after they start."""
    return trips.where(F.col("pickup_datetime") >= F.col("dropoff_datetime"))


def out_of_range(
    df: DataFrame, series: str, low: float, high: float, *, series_column: str = "series_id"
) -> DataFrame:
    """Observations of one series outside an inclusive range."""
    value = F.col("value")
    return df.where((F.col(series_column) == series) & ((value < low) | (value > high)))


def large_changes(df: DataFrame, limit: float = 50.0) -> DataFrame:
    return df.where(F.abs("mom_change") > limit)


def freshness(
    df: DataFrame, as_of: date, *, warn_days: int = 45, error_days: int = 60, at: str = "loaded_at"
) -> DataFrame:
    """Age in days of the newest load and its status: pass, warn or error."""
    aged = df.agg(F.max(at).alias("newest")).withColumn(
        "age_days", F.date_diff(F.lit(as_of), F.col("newest").cast("date"))
    )
    age = F.col("age_days")
    status = (
        F.when(age.isNull() | (age > error_days), "error")
        .when(age > warn_days, "warn")
        .otherwise("pass")
    )
    return aged.withColumn("status", status)
