"""K5: device totals from daily cumulative counters, with growth.

Each device arm is a sum of per-month maxima of running counters
(``MAX(a) + MAX(b) + MAX(c)``, or ``MAX(d)``). All arms come from **one**
scan and one aggregate (conditional maxima for both months); the arms are
then turned into rows with ``inline``, instead of a ``UNION ALL`` of two scans.
A NULL maximum makes its arm NULL, as ``+`` propagates NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiframe.functions.growth import growth_pct_rounded
from kpiframe.functions.period import Period
from kpiframe.functions.text import growth_phrase, thousands
from kpiframe.labels import DEFAULT_LABELS, Labels


def device_growth(
    daily: DataFrame, period: Period, labels: Labels = DEFAULT_LABELS, by: Sequence[str] = ()
) -> DataFrame:
    """K5: ``*by, product_type, month, total_devices, prev_total_devices,
    growth_pct, total_devices_text, growth_phrase`` for the current month."""
    dtype = daily.schema["date"].dataType
    base = period.filter(daily, "date").filter(F.col("customer_type") == F.lit(labels.customer_type))
    cur = period.is_current("date", dtype)
    cols = sorted({c for _, cs in labels.device_arms for c in cs})
    agg = base.groupBy(*by).agg(
        *[F.max(F.when(cur, F.col(c))).alias(f"_cur_{c}") for c in cols],
        *[F.max(F.when(~cur, F.col(c))).alias(f"_prev_{c}") for c in cols],
        F.count_if(cur).alias("_cur_rows"),
    )
    arms = F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("product_type"),
            reduce(add, [F.col(f"_cur_{c}") for c in cs]).alias("total_devices"),
            reduce(add, [F.col(f"_prev_{c}") for c in cs]).alias("prev_total_devices"),
        )
        for name, cs in labels.device_arms
    ]))
    growth = growth_pct_rounded(F.col("total_devices"), F.col("prev_total_devices"))
    return (
        agg.filter(F.col("_cur_rows") > 0)
        .select(*by, arms)
        .select(
            *by, "product_type", F.lit(period.current_start).alias("month"),
            "total_devices", "prev_total_devices", growth.alias("growth_pct"),
        )
        .withColumns({
            "total_devices_text": thousands(F.col("total_devices")),
            "growth_phrase": growth_phrase(F.col("growth_pct"), "float"),
        })
    )
