"""Fiscal calendar: column expressions for grouping, driver-side bounds for filtering."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")
_GRAIN_MONTHS = {"month": 1, "quarter": 3, "year": 12}

RELATIVE_RANGES = (
    "today", "yesterday", "last_7_days", "last_30_days", "last_90_days", "month_to_date",
    "quarter_to_date", "year_to_date", "last_month", "last_quarter", "last_year",
)
COMPARISONS = ("none", "prior_period", "prior_year", "period_to_date")


def _month_shift(first_of_month: date, months: int) -> date:
    year, month = divmod(first_of_month.year * 12 + first_of_month.month - 1 + months, 12)
    return date(year, month + 1, 1)


@dataclass(frozen=True)
class FiscalCalendar:
    """A fiscal year starting in ``start_month``, labelled by the calendar year it ends in.

    ``week_start`` counts from Monday = 0.
    """

    start_month: int = 1
    week_start: int = 0

    def __post_init__(self) -> None:
        if not 1 <= self.start_month <= 12:
            raise ValueError("start_month must be 1..12")
        if not 0 <= self.week_start <= 6:
            raise ValueError("week_start must be 0 (Monday)..6")

    # column expressions

    def fiscal_year(self, day: Column) -> Column:
        if self.start_month == 1:
            return F.year(day)
        return F.year(F.add_months(day.cast("date"), 13 - self.start_month))

    def year_start(self, day: Column) -> Column:
        shift = self.start_month - 1
        return F.add_months(F.trunc(F.add_months(day.cast("date"), -shift), "YEAR"), shift)

    def period(self, day: Column) -> Column:
        return F.pmod(F.month(day) - self.start_month, F.lit(12)) + 1

    def quarter(self, day: Column) -> Column:
        return F.floor((self.period(day) - 1) / 3).cast("int") + 1

    def truncated(self, day: Column, grain: str) -> Column:
        """First day of the period a date falls in."""
        day = day.cast("date")
        if grain == "day":
            return day
        if grain == "week":
            return F.date_sub(day, F.pmod(F.weekday(day) - self.week_start, F.lit(7)))
        if grain == "month":
            return F.trunc(day, "MONTH")
        if grain == "quarter":
            shift = (self.start_month - 1) % 3
            return F.add_months(F.trunc(F.add_months(day, -shift), "QUARTER"), shift)
        if grain == "year":
            return self.year_start(day)
        raise ValueError(f"unknown grain {grain!r}")

    # bounds: first day included, last day excluded

    def start_of(self, day: date, grain: str) -> date:
        if grain == "day":
            return day
        if grain == "week":
            return day - timedelta(days=(day.weekday() - self.week_start) % 7)
        months = _GRAIN_MONTHS[grain]
        into = (day.month - self.start_month) % months
        return _month_shift(day.replace(day=1), -into)

    def _step(self, start: date, grain: str, count: int) -> date:
        if grain == "day":
            return start + timedelta(days=count)
        if grain == "week":
            return start + timedelta(days=7 * count)
        return _month_shift(start, _GRAIN_MONTHS[grain] * count)

    def bounds(self, day: date, grain: str) -> tuple[date, date]:
        start = self.start_of(day, grain)
        return start, self._step(start, grain, 1)

    def comparison(self, day: date, grain: str, kind: str) -> tuple[date, date]:
        start, end = self.bounds(day, grain)
        if kind == "none":
            return start, end
        if kind == "period_to_date":
            return start, day + timedelta(days=1)
        if kind == "prior_period":
            return self._step(start, grain, -1), start
        if kind == "prior_year":
            leap_day = (day.month, day.day) == (2, 29)
            earlier = day.replace(year=day.year - 1, day=28 if leap_day else day.day)
            return self.bounds(earlier, grain)
        raise ValueError(f"unknown comparison {kind!r}")

    def relative(self, name: str, today: date) -> tuple[date, date]:
        tomorrow = today + timedelta(days=1)
        if name == "today":
            return today, tomorrow
        if name == "yesterday":
            return today - timedelta(days=1), today
        if name in ("last_7_days", "last_30_days", "last_90_days"):
            days = int(name.split("_")[1])
            return tomorrow - timedelta(days=days), tomorrow
        grain = name.split("_")[0] if name.endswith("_to_date") else name.removeprefix("last_")
        if name.endswith("_to_date"):
            return self.start_of(today, grain), tomorrow
        if grain in _GRAIN_MONTHS:
            return self.comparison(today, grain, "prior_period")
        raise ValueError(f"unknown relative range {name!r}")


def inclusive(start: date, end: date) -> tuple[date, date]:
    """Half-open bounds of a range whose last day is included."""
    if end < start:
        raise ValueError("range ends before it starts")
    return start, end + timedelta(days=1)
