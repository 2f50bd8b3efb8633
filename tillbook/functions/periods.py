"""Report periods and period keys.

Periods are half-open ``[start, end)`` and become literals in the plan, so a range
filter on a raw timestamp column reaches the Parquet footer statistics.  Keys are
column expressions meant for partition columns.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """Whole days from ``start`` up to, not including, ``end``."""

    start: datetime
    end: datetime

    @property
    def report_date(self) -> str:
        """Last day of the period as ``yyyy-MM-dd``."""
        return (self.end - timedelta(days=1)).strftime("%Y-%m-%d")

    def months(self, prefix: str = "daily_transactions") -> list[str]:
        """Keys of the months the period touches."""
        return months_between(self.start, self.end - timedelta(microseconds=1), prefix)

    def contains(self, ts: Column) -> Column:
        return (ts >= timestamp(self.start)) & (ts < timestamp(self.end))


def timestamp(value: datetime) -> Column:
    """A wall-clock literal; without a zone, so the *column* is never cast."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def midnight(value: date) -> datetime:
    return datetime(value.year, value.month, value.day)


def single_day(day: date) -> Period:
    start = midnight(day)
    return Period(start, start + timedelta(days=1))


def lagged_day(as_of: date, lag: int = 3) -> Period:
    """The day ``lag`` days before ``as_of``."""
    return single_day(midnight(as_of) - timedelta(days=lag))


def previous_week(as_of: date) -> Period:
    """Monday to Sunday, ending at the most recent completed Sunday."""
    monday = midnight(as_of) - timedelta(days=as_of.weekday())
    return Period(monday - timedelta(days=7), monday)


def previous_month(as_of: date) -> Period:
    end = midnight(as_of).replace(day=1)
    return Period((end - timedelta(days=1)).replace(day=1), end)


def month_of(day: date) -> Period:
    start = midnight(day).replace(day=1)
    return Period(start, (start + timedelta(days=32)).replace(day=1))


def end_of_previous_month(as_of: date) -> datetime:
    """Last millisecond of the month before ``as_of``."""
    return midnight(as_of).replace(day=1) - timedelta(milliseconds=1)


def trailing_days(ts: Column, as_of: datetime, days: int = 120) -> Column:
    """Rows of the last ``days`` days, both ends included."""
    return ts.between(timestamp(as_of - timedelta(days=days)), timestamp(as_of))


def quarters_between(start: date, end: date, prefix: str = "journals") -> list[str]:
    """Quarter keys overlapping ``[start, end]``: the partitions a window has to read."""
    first, last = start.year * 4 + (start.month - 1) // 3, end.year * 4 + (end.month - 1) // 3
    names = []
    for quarter in range(first, last + 1):
        year, q = divmod(quarter, 4)
        names.append(f"{prefix}_{year % 100:02d}_{3 * q + 1:02d}_{3 * q + 3:02d}")
    return names


def months_between(start: date, end: date, prefix: str = "daily_transactions") -> list[str]:
    """Month keys overlapping ``[start, end]``, as ``month_key`` writes them."""
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [f"{prefix}_{m // 12}_{m % 12 + 1:02d}" for m in range(first, last + 1)]


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def quarter_span_key(ts: Column, prefix: str = "journals") -> Column:
    """``journals_YY_SS_EE``: year, first and last month of the quarter."""
    q = F.quarter(ts)
    return F.concat(
        F.lit(f"{prefix}_"), _two_digits(F.year(ts) % 100),
        F.lit("_"), _two_digits(q * 3 - 2),
        F.lit("_"), _two_digits(q * 3),
    )


def quarter_start_key(ts: Column, prefix: str = "purchases") -> Column:
    """``purchases_YY_MM``: year and first month of the quarter."""
    return F.concat(
        F.lit(f"{prefix}_"), _two_digits(F.year(ts) % 100),
        F.lit("_"), _two_digits(F.quarter(ts) * 3 - 2),
    )


def month_key(ts: Column, prefix: str = "daily_transactions") -> Column:
    """``daily_transactions_YYYY_MM``."""
    return F.concat(
        F.lit(f"{prefix}_"), F.year(ts).cast("string"), F.lit("_"), _two_digits(F.month(ts))
    )


def day_of(ts: Column) -> Column:
    """Calendar day of a timestamp or of timestamp text; malformed text becomes null."""
    return ts.try_cast("date")


def week_of(ts: Column) -> Column:
    """Monday of the week."""
    day = day_of(ts)
    return F.date_sub(day, F.weekday(day))


def month_start(ts: Column) -> Column:
    return F.trunc(day_of(ts), "month")


def ordinal_suffix(day: Column) -> Column:
    """``ST``, ``ND``, ``RD`` or ``TH`` for a day number."""
    last = day % 10
    return (
        F.when((day % 100).between(10, 20), "TH")
        .when(last == 1, "ST")
        .when(last == 2, "ND")
        .when(last == 3, "RD")
        .otherwise("TH")
    )
