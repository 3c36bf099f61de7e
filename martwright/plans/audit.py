"""Audit before publish: a version is checked where it was written, then committed or dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from martwright.schemas import AUDIT_LOG
from martwright.sources.versions import Candidate, commit, discard


class AuditFailed(RuntimeError):
    """A version broke its checks and was not published; ``report`` has all lines."""

    def __init__(self, report: Sequence[Row]) -> None:
        self.report = list(report)
        broken = [f"{r.model} {r.check_kind} {r.column_name}: {r.n_failing} failing" for r in report if not r.passed]
        super().__init__("; ".join(broken))


def audited(report: DataFrame, log: str) -> list[Row]:
    """The lines of a report, which a log keeps whatever they say.

    A report has one line a check, so it is small however large the tables are.
    """
    lines = report.select(*AUDIT_LOG.names[:-1]).collect()
    kept = report.sparkSession.createDataFrame(lines, AUDIT_LOG[:-1]) if lines else report.limit(0)
    kept.withColumn("audited_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(log)
    return lines


def publish(candidates: Sequence[Candidate], report: DataFrame, log: str) -> list[Row]:
    """Commit all candidates if every line of ``report`` passes, else drop them and raise."""
    lines = audited(report, log)
    if not all(line.passed for line in lines):
        for candidate in candidates:
            discard(candidate)
        raise AuditFailed(lines)
    for candidate in candidates:
        commit(candidate)
    return lines
