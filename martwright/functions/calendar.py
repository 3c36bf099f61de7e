"""Calendar arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTES_PER_DAY = 1440


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two zone-less timestamps; negative when reversed.

    Built from date, hour and minute fields: truncating to the minute would go
    through a zoned timestamp and be wrong around a clock change.
    """

    def minute_of_day(at: Column) -> Column:
        return F.hour(at) * 60 + F.minute(at)

    days = F.date_diff(end.cast("date"), start.cast("date")).cast("bigint")
    return days * MINUTES_PER_DAY + (minute_of_day(end) - minute_of_day(start))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_label(at: Column) -> Column:
    """``YYYY-MM`` of a date or zone-less timestamp."""
    return F.substring(at.cast("date").cast("string"), 1, 7)


def years_before(as_of: Column, years: int) -> Column:
    return F.add_months(as_of, -12 * years)
