"""Report-ready text as built-in column expressions (no Python UDF).

Number text uses ``format_number``, which rounds like Python's ``.2f`` and
``,.0f``; ``format_string('%.2f')`` rounds half up and prints ``null`` for
NULL, so it is avoided.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiframe import labels as L

GROWTH_STYLES = ("cast", "fixed2", "float", "traffic")


def thousands(col: Column) -> Column:
    """``1234567`` -> ``1.234.567`` (dot as thousands separator, no decimals)."""
    return F.replace(F.format_number(col, 0), F.lit(","), F.lit("."))


def fixed2(col: Column) -> Column:
    """``%.2f`` text: two decimals, no grouping."""
    return F.replace(F.format_number(col, 2), F.lit(","), F.lit(""))


def percent2(col: Column) -> Column:
    """``%.2f%%`` text: ``12.50%``; NULL stays NULL."""
    return F.concat(fixed2(col), F.lit("%"))


def cast_number(col: Column) -> Column:
    """Shortest text of a value rounded to 2 places: ``60``, ``18.6``, ``10.53``."""
    return F.regexp_replace(fixed2(col), r"[.]?0+$", "")


def float_number(col: Column) -> Column:
    """Python float text of a value rounded to 2 places: ``12.0``, ``1.5``, ``1.52``."""
    return F.regexp_replace(fixed2(col), r"0$", "")


def growth_phrase(pct: Column, style: str = "cast", prev: Column | None = None, cur: Column | None = None) -> Column:
    """Growth sentence fragment in one of four styles.

    ``cast``, ``fixed2``, ``float`` take a growth already rounded to 2 places;
    zero and NULL give the flat text and a fall shows the absolute value.
    ``traffic`` takes the *unrounded* growth plus ``prev`` (and ``cur``): a
    zero previous value gives ``N/A``, a missing one NULL, zero growth its own
    flat text, and a fall keeps its minus sign.
    """
    if style not in GROWTH_STYLES:
        raise ValueError(f"style must be one of {GROWTH_STYLES}, got {style!r}")
    if style == "traffic":
        if prev is None:
            raise ValueError("traffic style needs the previous value")
        number = fixed2(pct)
        missing = prev.isNull() if cur is None else (prev.isNull() | cur.isNull())
        return (
            F.when(missing, F.lit(None).cast("string"))
            .when(prev == 0, F.lit(L.TRAFFIC_NA_TEXT))
            .when(pct > 0, F.concat(F.lit(L.UP_PREFIX), number, F.lit("%")))
            .when(pct < 0, F.concat(F.lit(L.DOWN_PREFIX), number, F.lit("%")))
            .otherwise(F.lit(L.TRAFFIC_FLAT_TEXT))
        )
    fmt = {"cast": cast_number, "fixed2": fixed2, "float": float_number}[style]
    return (
        F.when(pct > 0, F.concat(F.lit(L.UP_PREFIX), fmt(pct), F.lit("%")))
        .when(pct < 0, F.concat(F.lit(L.DOWN_PREFIX), fmt(F.abs(pct)), F.lit("%")))
        .otherwise(F.lit(L.FLAT_TEXT))
    )


def join_list(items: Column, sep: str = L.LIST_SEPARATOR, last_sep: str = L.LIST_LAST_SEPARATOR) -> Column:
    """``[a, b, c]`` -> ``a, b dan c``; one item as is; empty array -> NULL."""
    n = F.size(items)
    head = F.concat_ws(sep, F.slice(items, F.lit(1), n - 1))
    return (
        F.when(n == 1, F.element_at(items, 1))
        .when(n > 1, F.concat(head, F.lit(last_sep), F.element_at(items, -1)))
    )


def flagged_list(flags: Sequence[tuple[Column, str]]) -> Column:
    """Array of the names whose condition is true, in the given order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in flags]))


def summary_sentence(items: Column) -> Column:
    """Improvement sentence from a list of improved metric names."""
    return F.when(F.size(items) > 0, F.concat(join_list(items), F.lit(L.SUMMARY_SUFFIX))).otherwise(
        F.lit(L.SUMMARY_NONE)
    )


def label_lookup(label: Column, mapping: dict[str, str]) -> Column:
    """Value of ``mapping`` for ``label``; NULL for an unknown label.

    A literal map inside the projection: no join, no broadcast exchange.
    """
    pairs = [F.lit(x) for kv in sorted(mapping.items()) for x in kv]
    return F.try_element_at(F.create_map(*pairs), label)


def slot_name(name: Column | str, suffix: Column | str) -> Column:
    """``name_suffix`` slot key."""
    n = F.lit(name) if isinstance(name, str) else name
    s = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat_ws("_", n, s)
