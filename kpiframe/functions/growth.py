"""Growth arithmetic and the previous-value lookups it needs.

``growth_pct`` is ``(cur - prev) / prev * 100`` with ``try_divide``: a zero or
missing previous value gives NULL instead of an ANSI divide-by-zero error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def growth_pct(cur: Column, prev: Column) -> Column:
    """Unrounded growth in percent; NULL when ``prev`` is 0 or NULL."""
    return F.try_divide(cur - prev, prev) * F.lit(100)


def growth_pct_rounded(cur: Column, prev: Column, scale: int = 2) -> Column:
    """Growth rounded half away from zero to ``scale`` places."""
    return F.round(growth_pct(cur, prev), scale)


def share_pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; NULL when ``whole`` is 0 (SAFE_DIVIDE)."""
    return F.try_divide(part, whole) * F.lit(100)


#: Fractions are summed as whole numbers of this part of one.
FRACTION_UNIT = 2.0 ** 52


def exact_mean(value: Column, where: Column | None = None) -> Column:
    """Mean of fractions (below 2048 in size) as an aggregate that does not
    depend on the order of rows or tasks: each value is cut to a whole number of
    2**-52 and these are summed exactly as decimals, where a sum of doubles
    would round differently with every order. NULLs are left out; NULL if none
    is left. It combines map-side like any sum."""
    kept = value if where is None else F.when(where, value)
    units = F.floor(kept * F.lit(FRACTION_UNIT)).cast("decimal(20,0)")
    return F.try_divide(F.sum(units).cast("double"), F.count(kept) * F.lit(FRACTION_UNIT))


def with_previous(
    df: DataFrame,
    value_cols: Sequence[str],
    order_col: str,
    partition_cols: Sequence[str] = (),
    prefix: str = "prev_",
    calendar_unit: str | None = None,
) -> DataFrame:
    """Add ``prev_<col>`` = LAG(col) by row within ``partition_cols``.

    By row is the original semantics: with a gap, the previous *row* is an
    older period. ``calendar_unit`` (``month``, ``week`` or ``day``) keeps the
    previous value only when the previous row is exactly one period earlier.

    Meant for already-aggregated rows (a few per key). With no partition
    columns the window runs in one task, so never apply it to raw rows.
    """
    from kpiframe.functions.period import shift_period

    w = Window.partitionBy(*partition_cols).orderBy(order_col)
    if calendar_unit is None:
        return df.withColumns({prefix + c: F.lag(c).over(w) for c in value_cols})
    adjacent = F.lag(order_col).over(w) == shift_period(F.col(order_col), -1, calendar_unit)
    return df.withColumns({prefix + c: F.when(adjacent, F.lag(c).over(w)) for c in value_cols})
