"""Reporting periods: one explicit ``as_of`` date instead of the clock.

A :class:`Period` gives the *current* period (the last complete one before
``as_of``) and the *previous* one, as half-open ``[start, end)`` date bounds.
Bounds become literals in the plan, so Catalyst folds them and range filters
on the raw date column reach the Parquet scan (``PushedFilters``), which a
``trunc(col) IN (...)`` predicate never does.

Column helpers compute the same bounds per row, for plans where the as-of date
comes from data (one report per month, say).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNITS = ("month", "week", "day")

CURRENT = "current"
PREVIOUS = "previous"


def _add_months(d: dt.date, n: int) -> dt.date:
    """First-of-month date ``n`` months from ``d`` (``d`` must be a month start)."""
    idx = d.year * 12 + (d.month - 1) + n
    return dt.date(idx // 12, idx % 12 + 1, 1)


@dataclass(frozen=True)
class Period:
    """Current and previous period for an ``as_of`` date.

    ``unit='month'``: current = the calendar month before ``as_of``'s month.
    ``unit='week'``: weeks start on Monday; current = the week before ``as_of``'s.
    ``unit='day'``: current = the day before ``as_of``.
    """

    as_of: dt.date
    unit: str = "month"

    def __post_init__(self) -> None:
        if isinstance(self.as_of, str):
            object.__setattr__(self, "as_of", dt.date.fromisoformat(self.as_of))
        elif isinstance(self.as_of, dt.datetime):
            object.__setattr__(self, "as_of", self.as_of.date())
        if self.unit not in UNITS:
            raise ValueError(f"unit must be one of {UNITS}, got {self.unit!r}")

    # -- driver-side bounds (become literals) ---------------------------------
    @property
    def anchor(self) -> dt.date:
        """Start of the period that contains ``as_of`` (excluded from reports)."""
        d = self.as_of
        if self.unit == "month":
            return d.replace(day=1)
        if self.unit == "week":
            return d - dt.timedelta(days=d.weekday())
        return d

    def _shift(self, start: dt.date, n: int) -> dt.date:
        if self.unit == "month":
            return _add_months(start, n)
        step = 7 if self.unit == "week" else 1
        return start + dt.timedelta(days=step * n)

    @property
    def current_start(self) -> dt.date:
        return self._shift(self.anchor, -1)

    @property
    def current_end(self) -> dt.date:
        """Exclusive end of the current period."""
        return self.anchor

    @property
    def previous_start(self) -> dt.date:
        return self._shift(self.anchor, -2)

    @property
    def previous_end(self) -> dt.date:
        return self.current_start

    @property
    def current_last_day(self) -> dt.date:
        """Inclusive last day of the current period (for ISO range text)."""
        return self.current_end - dt.timedelta(days=1)

    @property
    def previous_last_day(self) -> dt.date:
        return self.previous_end - dt.timedelta(days=1)

    # -- Spark expressions ----------------------------------------------------
    def filter(self, df: DataFrame, column: str, which: str = "both") -> DataFrame:
        """Half-open range filter on a raw date/timestamp column.

        ``which`` is ``'both'`` (previous start to current end), ``'current'``
        or ``'previous'``. Literals take the column's own type, so the
        comparison stays a plain ``>=``/``<`` that Parquet can evaluate.
        """
        lo, hi = {
            "both": (self.previous_start, self.current_end),
            CURRENT: (self.current_start, self.current_end),
            PREVIOUS: (self.previous_start, self.previous_end),
        }[which]
        dtype = df.schema[column].dataType
        col = F.col(column)
        return df.filter((col >= typed_lit(lo, dtype)) & (col < typed_lit(hi, dtype)))

    def is_current(self, column: str, dtype: T.DataType) -> Column:
        """True for rows of the current period (rows already range-filtered)."""
        return F.col(column) >= typed_lit(self.current_start, dtype)

    def tag(self, column: str, dtype: T.DataType) -> Column:
        """``'current'`` / ``'previous'`` for rows already range-filtered."""
        return F.when(self.is_current(column, dtype), F.lit(CURRENT)).otherwise(F.lit(PREVIOUS))

    def label(self) -> Column:
        """Month label of the current period start, e.g. ``November 2025``."""
        return month_label(F.lit(self.current_start))


def typed_lit(value: dt.date, dtype: T.DataType) -> Column:
    """A date literal in the type of the column it is compared with."""
    if isinstance(dtype, T.DateType):
        return F.lit(value)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.lit(value).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.lit(value.isoformat())
    raise TypeError(f"cannot compare a date with {dtype.simpleString()}")


def period_start(col: Column, unit: str = "month") -> Column:
    """Start date of the period that contains ``col`` (date or timestamp)."""
    d = F.to_date(col)
    if unit == "month":
        return F.trunc(d, "MM")
    if unit == "week":
        # dayofweek: Sunday=1 .. Saturday=7, so Monday gives 0 days back.
        return F.date_sub(d, (F.dayofweek(d) + 5) % 7)
    if unit == "day":
        return d
    raise ValueError(f"unit must be one of {UNITS}, got {unit!r}")


def shift_period(start: Column, n: int, unit: str = "month") -> Column:
    """Start of the period ``n`` periods after the one starting at ``start``."""
    if unit == "month":
        return F.add_months(start, n)
    return F.date_add(start, n * (7 if unit == "week" else 1))


def bounds_columns(as_of: Column, unit: str = "month") -> dict[str, Column]:
    """Per-row period bounds for a data-driven ``as_of`` date column."""
    anchor = period_start(as_of, unit)
    cur = shift_period(anchor, -1, unit)
    prev = shift_period(anchor, -2, unit)
    return {
        "previous_start": prev,
        "previous_last_day": F.date_sub(cur, 1),
        "current_start": cur,
        "current_last_day": F.date_sub(anchor, 1),
        "current_end": anchor,
    }


def month_label(col: Column) -> Column:
    """``strftime('%B %Y')`` equivalent: ``November 2025``."""
    from kpiframe.labels import MONTH_LABEL_PATTERN

    return F.date_format(col, MONTH_LABEL_PATTERN)


def iso_date(col: Column) -> Column:
    """ISO date text ``yyyy-MM-dd``."""
    from kpiframe.labels import ISO_DATE_PATTERN

    return F.date_format(col, ISO_DATE_PATTERN)
