"""K1, K2: customer and active-user totals per product with growth.

Both read monthly usage rows (S1), keep the listed products and the two
month starts (an exact ``IN`` on the raw ``month`` column, as the source
does: rows dated mid-month are not kept), and compare current with previous.

The comparison is one conditional aggregation per product, not an
aggregate-then-LAG: a single partial/final ``HashAggregate`` with one small
exchange. Because only the two months are kept, the previous *row* and the
previous *month* coincide, so it equals the LAG form (tested).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiframe.functions.growth import exact_mean, growth_pct_rounded
from kpiframe.functions.period import Period
from kpiframe.functions.text import growth_phrase, percent2, thousands
from kpiframe.labels import DEFAULT_LABELS, Labels


def usage_months(usage: DataFrame, period: Period, products: Sequence[str]) -> DataFrame:
    """P3 + P4: listed products, rows dated exactly on the two month starts."""
    return usage.filter(
        F.col("product").isin(list(products))
        & F.col("month").isin(period.previous_start, period.current_start)
    )


def usage_growth(
    usage: DataFrame, period: Period, labels: Labels = DEFAULT_LABELS, by: Sequence[str] = ()
) -> DataFrame:
    """K1 and K2 fused: both read the same rows with the same grouping, so one
    aggregate serves both (one scan, one exchange).

    Columns: ``*by, product, month, total_customer, prev_total_customer,
    growth_pct, total_customer_text, growth_phrase, total_mau, prev_total_mau,
    mau_percentage, mau_growth_pct, total_mau_text, mau_percentage_text,
    mau_growth_phrase``. A product with no current-month row gives no row.
    """
    cur = F.col("month") == F.lit(period.current_start)
    prev = F.col("month") == F.lit(period.previous_start)
    agg = usage_months(usage, period, labels.products).groupBy(*by, "product").agg(
        F.sum(F.when(cur, F.col("total_customer"))).alias("total_customer"),
        F.sum(F.when(prev, F.col("total_customer"))).alias("prev_total_customer"),
        F.sum(F.when(cur, F.col("mau"))).alias("total_mau"),
        F.sum(F.when(prev, F.col("mau"))).alias("prev_total_mau"),
        exact_mean(F.col("ratio"), cur).alias("mau_percentage"),
        F.count_if(cur).alias("_cur_rows"),
    )
    return (
        agg.filter(F.col("_cur_rows") > 0)
        .select(
            *by, "product", F.lit(period.current_start).alias("month"),
            "total_customer", "prev_total_customer",
            growth_pct_rounded(F.col("total_customer"), F.col("prev_total_customer")).alias("growth_pct"),
            "total_mau", "prev_total_mau", "mau_percentage",
            growth_pct_rounded(F.col("total_mau"), F.col("prev_total_mau")).alias("mau_growth_pct"),
        )
        .withColumns({
            "total_customer_text": thousands(F.col("total_customer")),
            "growth_phrase": growth_phrase(F.col("growth_pct"), "cast"),
            "total_mau_text": thousands(F.col("total_mau")),
            "mau_percentage_text": percent2(F.col("mau_percentage") * 100),
            "mau_growth_phrase": growth_phrase(F.col("mau_growth_pct"), "cast"),
        })
    )


def ranked(rows: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """O1 as data: ``rows`` with their place ``pos`` (from 1) in the report's
    order, so that it survives a write, a shuffle or a join. Meant for result
    rows: all rows of one ``by`` group are sorted in one task."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("pos", F.row_number().over(w))


def customer_growth(
    usage: DataFrame, period: Period, labels: Labels = DEFAULT_LABELS, by: Sequence[str] = (), sort: bool = True
) -> DataFrame:
    """K1: total customers per product for the current month, growth and text.

    Columns: ``*by, product, month, total_customer, prev_total_customer,
    growth_pct, total_customer_text, growth_phrase``; sorted by product
    unless ``sort=False`` (a consumer that re-shapes the rows needs no order).
    """
    out = usage_growth(usage, period, labels, by).select(
        *by, "product", "month", "total_customer", "prev_total_customer", "growth_pct",
        "total_customer_text", "growth_phrase",
    )
    return out.orderBy(*by, "product") if sort else out


def mau_growth(
    usage: DataFrame, period: Period, labels: Labels = DEFAULT_LABELS, by: Sequence[str] = ()
) -> DataFrame:
    """K2: active users per product, unweighted mean ratio, growth and text.

    Columns: ``*by, product, month, total_mau, prev_total_mau, mau_percentage,
    growth_pct, total_mau_text, mau_percentage_text, growth_phrase``.
    ``mau_percentage`` is the plain mean of ``ratio`` (a fraction), summed
    exactly; its text is ``ratio * 100`` with two decimals and ``%``.
    """
    return usage_growth(usage, period, labels, by).select(
        *by, "product", "month", "total_mau", "prev_total_mau", "mau_percentage",
        F.col("mau_growth_pct").alias("growth_pct"), "total_mau_text", "mau_percentage_text",
        F.col("mau_growth_phrase").alias("growth_phrase"),
    )
