"""The run's clock and date differences."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AsOf:
    """What "today" and "now" mean in a run.

    Left empty they are the clock at query start; give both for a result that
    can be computed again.
    """

    date: dt.date | None = None
    timestamp: dt.datetime | None = None

    @property
    def today(self) -> Column:
        return F.current_date() if self.date is None else F.lit(self.date)

    @property
    def now(self) -> Column:
        if self.timestamp is not None:
            return F.lit(self.timestamp)
        return F.current_timestamp() if self.date is None else self.today.cast("timestamp")


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``, negative if ``end`` is earlier."""
    return F.date_diff(end, start)


def years_between(start: Column, end: Column) -> Column:
    """Years of 365 days, as a fraction."""
    return days_between(start, end) / 365
