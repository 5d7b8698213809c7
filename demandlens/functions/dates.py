"""Date windows: a named range ending before ``as_of``, its midpoint and predecessor."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.rules import ALL_RANGE, ALL_RANGE_DAYS, RANGE_DAYS

DATE_RANGES = (*RANGE_DAYS, ALL_RANGE)


@dataclass(frozen=True)
class DateWindow:
    """Half-open ranges ``[start, end)`` and ``[prior_start, prior_end)``."""

    start: date
    end: date
    midpoint: date
    prior_start: date | None = None
    prior_end: date | None = None

    @property
    def first_day(self) -> date:
        """First day that current or prior figures need."""
        return self.prior_start or self.start

    def current(self, day: Column) -> Column:
        return (day >= F.lit(self.start)) & (day < F.lit(self.end))

    def prior(self, day: Column) -> Column:
        if self.prior_start is None:
            return F.lit(False)
        return (day >= F.lit(self.prior_start)) & (day < F.lit(self.prior_end))


def resolve_window(date_range: str, as_of: date | None = None) -> DateWindow:
    """Window of ``date_range`` up to, and without, ``as_of`` (default: today)."""
    if date_range not in DATE_RANGES:
        raise ValueError(f"date_range must be one of {DATE_RANGES}, not {date_range!r}")
    end = as_of or date.today()
    days = RANGE_DAYS.get(date_range, ALL_RANGE_DAYS)
    start = end - timedelta(days=days)
    midpoint = start + timedelta(days=days // 2)
    if date_range == ALL_RANGE:
        return DateWindow(start, end, midpoint)
    return DateWindow(start, end, midpoint, start - timedelta(days=days), start)


def window_coverage(rows: DataFrame, day: str, as_of: date | None = None) -> DataFrame:
    """Dates of every named window with the number of rows in each part of it.

    One pass over ``rows``: all counts are conditional aggregates of one global
    aggregation, unfolded into one line per range afterwards.
    """
    d = F.col(day)
    windows = {name: resolve_window(name, as_of) for name in DATE_RANGES}
    lines = [
        F.struct(
            F.lit(name).alias("date_range"),
            F.lit(w.start).alias("window_start"),
            F.lit(w.end).alias("window_end"),
            F.lit(w.midpoint).alias("window_midpoint"),
            F.lit(w.prior_start).cast("date").alias("prior_window_start"),
            F.lit(w.prior_end).cast("date").alias("prior_window_end"),
            F.count_if(w.current(d)).alias("rows_in_window"),
            F.count_if(w.current(d) & (d < F.lit(w.midpoint))).alias("rows_in_first_half"),
            F.count_if(w.prior(d)).alias("rows_in_prior_window"),
        )
        for name, w in windows.items()
    ]
    first = min(w.first_day for w in windows.values())
    last = max(w.end for w in windows.values())
    return (
        rows.where((d >= F.lit(first)) & (d < F.lit(last)))
        .agg(F.array(*lines).alias("lines"))
        .select(F.inline("lines"))
    )
