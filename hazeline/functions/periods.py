"""Report periods: 'YYYY-MM' or 'YYYY-Hn' to dates, on the driver or per row."""

from __future__ import annotations

import calendar
import datetime as dt
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_PATTERN = r"^(\d{4})-(\d{2}|H[12])$"


@dataclass(frozen=True)
class Period:
    text: str
    start: dt.date
    end: dt.date
    mode: str

    @property
    def year(self) -> int:
        return self.start.year

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    @property
    def previous_month(self) -> dt.date:
        """First day of the month before the period: the registry to compare with."""
        return (self.start - dt.timedelta(days=1)).replace(day=1)

    @property
    def title(self) -> str:
        end = f"{calendar.month_name[self.end.month]} {self.end.year}"
        return end if self.mode == "month" else f"{calendar.month_name[self.start.month]} to {end}"

    def day_threshold(self, share: float) -> float:
        return share * self.days

    def in_year(self, year: int) -> tuple[dt.date, dt.date]:
        """The same calendar window in another year, run to that month's last day."""
        last = calendar.monthrange(year, self.end.month)[1]
        return dt.date(year, self.start.month, 1), dt.date(year, self.end.month, last)


def period_bounds(text: str | None = None, today: dt.date | None = None) -> Period:
    """Parse a period; without one, the month before today's."""
    if text is None:
        this_month = (today or dt.date.today()).replace(day=1)
        text = f"{this_month - dt.timedelta(days=1):%Y-%m}"
    found = re.match(PERIOD_PATTERN, text)
    if found is None:
        raise ValueError(f"period must be YYYY-MM or YYYY-Hn, not {text!r}")
    year, part = int(found[1]), found[2]
    if part.startswith("H"):
        first, last, mode = (1, 6, "half_year") if part == "H1" else (7, 12, "half_year")
    else:
        first = last = int(part)
        mode = "month"
    return Period(
        text,
        dt.date(year, first, 1),
        dt.date(year, last, calendar.monthrange(year, last)[1]),
        mode,
    )


def within(date: Column, period: Period) -> Column:
    return date.between(F.lit(period.start), F.lit(period.end))


def within_years(date: Column, period: Period, years: list[int]) -> Column:
    """The period's calendar window in any of the years.

    Plain date ranges, not year()/month() calls, so that scans can push them down.
    """
    ranges = (period.in_year(y) for y in years)
    return reduce(
        lambda a, b: a | b,
        (date.between(F.lit(start), F.lit(end)) for start, end in ranges),
    )


def period_struct(text: Column) -> Column:
    """Bounds of a period text per row; NULL where the text is no period."""
    year = F.regexp_extract(text, PERIOD_PATTERN, 1)
    part = F.regexp_extract(text, PERIOD_PATTERN, 2)
    half = part.startswith("H")
    first = F.when(part == "H1", "01").when(part == "H2", "07").otherwise(part)
    start = F.when(
        text.rlike(PERIOD_PATTERN), F.try_to_date(F.concat_ws("-", year, first, F.lit("01")))
    )
    end = F.last_day(F.add_months(start, F.when(half, 5).otherwise(0)))
    return F.when(
        start.isNotNull(),
        F.struct(
            start.alias("start"),
            end.alias("end"),
            F.when(half, "half_year").otherwise("month").alias("mode"),
            F.year(start).alias("year"),
            (F.datediff(end, start) + 1).alias("days"),
            F.add_months(F.trunc(start, "MM"), -1).alias("previous_month"),
        ),
    )
