"""K3, K4: order progress and the order breakdown for the current month.

Both start from one *order cube*: the two months pre-aggregated to
``(period, status, product, region) -> counts``. K3 is one conditional
aggregation over it; K4 tags its three arms from it with ``inline`` in a
single branch. Conditions are conditional aggregates, never filters, so
Catalyst pushes nothing below the cube: each arm does not get a scan of its
own, and in the whole report K3 and K4 share one scan, one customer join and
one exchange (``ReusedExchange``).

Trade-off: K3's excluded statuses are no longer a pushed scan filter; they
stay in the cube (K4 needs every status) and drop out in K3's conditional
aggregates. With a handful of status values spread over every row group,
Parquet min/max statistics could not skip row groups for that predicate, so
the shared scan and join are the larger saving.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiframe.functions.growth import growth_pct, growth_pct_rounded, share_pct
from kpiframe.functions.period import CURRENT, Period
from kpiframe.functions.text import fixed2, growth_phrase, percent2, thousands
from kpiframe.labels import DEFAULT_LABELS, Labels

STATUS = "status"
PRODUCT = "product"
REGIONAL = "regional"


def order_cube(orders: DataFrame, period: Period, by: Sequence[str] = ()) -> DataFrame:
    """Both months of orders pre-aggregated to ``(*by, period, status, product,
    regional, has_id) -> n``.

    K3 and K4 both read this cube and express their conditions as
    conditional aggregates, never as filters, so Catalyst pushes nothing
    below it. Whether the order id is present is a grouping flag rather than
    a second count, because an aggregate one consumer does not use would be
    pruned from its copy. So the cube's subtree (scan, join, partial
    aggregate, exchange) is identical in both, and Spark reuses its exchange
    when both are in one plan.

    ``orders`` are single orders, or partial counts ``n`` with ``has_id`` and
    the ``period`` tag (``sources.mapped.order_counts``). Without product and
    region, which K3 does not need, the cube has neither.
    """
    groups = [*by, "period", "fulfillment_status", *[c for c in ("product", "regional") if c in orders.columns], "has_id"]
    if "n" not in orders.columns:
        dtype = orders.schema["order_created_date"].dataType
        orders = period.filter(orders, "order_created_date").withColumns({
            "period": period.tag("order_created_date", dtype), "has_id": F.col("order_id").isNotNull(), "n": F.lit(1)})
    return orders.groupBy(*groups).agg(F.sum("n").alias("n"))


def order_progress(
    orders: DataFrame, period: Period, labels: Labels = DEFAULT_LABELS, by: Sequence[str] = ()
) -> DataFrame:
    """K3: totals, completed and open orders of the current month, with growth.

    Orders whose status is excluded (or NULL) are dropped first.
    ``total_orders`` counts non-NULL ids; the completed and open counts count
    rows, so they may add up to more than the total. Growth compares
    ``total_orders`` with the previous month (NULL if it had no rows or 0).
    """
    st = F.col("fulfillment_status")
    kept = ~st.isin(list(labels.excluded_statuses))          # NULL status: not kept
    cur = F.col("period") == F.lit(CURRENT)
    prev = ~cur

    def total(cond):
        return F.sum(F.when(cond & kept, F.col("n")))

    has_id = F.col("has_id")
    agg = order_cube(orders, period, by).groupBy(*by).agg(
        F.coalesce(total(cur & has_id), F.lit(0)).alias("total_orders"),
        F.coalesce(total(cur & (st == F.lit(labels.closed_status))), F.lit(0)).alias("total_completed"),
        F.coalesce(total(cur & ~st.isin(list(labels.open_excluded))), F.lit(0)).alias("total_on_progress"),
        F.coalesce(total(prev & has_id), F.lit(0)).alias("_prev_orders"),
        total(cur).alias("_cur_rows"),
        total(prev).alias("_prev_rows"),
    )
    prev_total = F.when(F.col("_prev_rows") > 0, F.col("_prev_orders"))
    return (
        agg.filter(F.col("_cur_rows") > 0)
        .select(
            *by,
            F.lit(period.current_start).alias("order_month"),
            "total_orders", "total_completed", "total_on_progress",
            prev_total.alias("prev_total_orders"),
        )
        .withColumns({
            "growth_pct": growth_pct_rounded(F.col("total_orders"), F.col("prev_total_orders")),
            "completed_pct": F.round(share_pct(F.col("total_completed"), F.col("total_orders")), 2),
            "on_progress_pct": F.round(share_pct(F.col("total_on_progress"), F.col("total_orders")), 2),
        })
        .withColumns({
            "total_orders_text": thousands(F.col("total_orders")),
            "total_completed_text": thousands(F.col("total_completed")),
            "total_on_progress_text": thousands(F.col("total_on_progress")),
            "growth_phrase": growth_phrase(F.col("growth_pct"), "fixed2"),
            "growth_pct_text": percent2(F.col("growth_pct")),
            "completed_pct_text": percent2(F.col("completed_pct")),
            "on_progress_pct_text": percent2(F.col("on_progress_pct")),
        })
    )


def order_category(
    orders: DataFrame, period: Period, labels: Labels = DEFAULT_LABELS, by: Sequence[str] = (),
    fill_zero: bool = False,
) -> DataFrame:
    """K4: long-form breakdown of the current month's orders.

    Rows ``(*by, category, label, total_orders, percentage)``:

    * ``status``: orders with the document status (one row, if any);
    * ``product``: open orders of each share product, with its share of those
      products' open orders as ``%.2f`` text;
    * ``regional``: the one region with most open orders (ties: label
      ascending, NULL last; a NULL region can win).

    ``total_orders`` is text; ``percentage`` is NULL outside ``product``.
    An arm with no qualifying orders gives no row, unless ``fill_zero``: then
    the document status and every share product get a row with ``0`` (a label
    spine added inside the same projection, per group that has any order in
    the month -- no join). The top region still needs at least one open order.
    The arms are tagged from the shared order cube with ``inline`` in one
    branch, so the month is read once for all three.
    """
    st = F.col("fulfillment_status")
    cur = F.col("period") == F.lit(CURRENT)
    is_open = ~st.isin(list(labels.open_excluded))
    entries = [
        F.struct(F.lit(STATUS).alias("category"), st.alias("label"),
                 F.when(cur & (st == F.lit(labels.document_status)), F.col("n")).alias("n")),
        F.struct(F.lit(PRODUCT).alias("category"), F.col("product").alias("label"),
                 F.when(cur & F.col("product").isin(list(labels.share_products)) & is_open, F.col("n")).alias("n")),
        F.struct(F.lit(REGIONAL).alias("category"), F.col("regional").alias("label"),
                 F.when(cur & is_open, F.col("n")).alias("n")),
    ]
    if fill_zero:
        spine = [(STATUS, labels.document_status)] + [(PRODUCT, p) for p in labels.share_products]
        entries += [F.struct(F.lit(c).alias("category"), F.lit(lab).alias("label"),
                             F.when(cur, F.lit(0).cast("bigint")).alias("n"))
                    for c, lab in spine]
    counts = (
        order_cube(orders, period, by).select(*by, F.inline(F.array(*entries)))
        .filter(F.col("n").isNotNull())
        .groupBy(*by, "category", "label")
        .agg(F.sum("n").alias("n"))
    )
    per_cat = Window.partitionBy(*by, "category")
    ranked = Window.partitionBy(*by, "category").orderBy(F.desc("n"), F.asc_nulls_last("label"))
    share = share_pct(F.col("n"), F.sum("n").over(per_cat))
    return (
        counts.select(
            *by, "category", "label", "n",
            F.when(F.col("category") == PRODUCT, fixed2(share)).alias("percentage"),
            F.row_number().over(ranked).alias("_rank"),
        )
        .filter((F.col("category") != REGIONAL) | (F.col("_rank") == 1))
        .select(*by, "category", "label", F.col("n").cast("string").alias("total_orders"), "percentage")
    )


def top_label(counts: DataFrame, label_col: str, count_col: str = "n", by: Sequence[str] = ()) -> DataFrame:
    """Top-1 label by count (ties: label ascending, NULL last).

    Without ``by`` this is ``orderBy(...).limit(1)``, planned as
    ``TakeOrderedAndProject`` (per-partition top-1, then one merge); with
    ``by`` a ``row_number`` window picks one row per group.
    """
    order = [F.desc(count_col), F.asc_nulls_last(label_col)]
    if not by:
        return counts.orderBy(*order).limit(1)
    w = Window.partitionBy(*by).orderBy(*order)
    return counts.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


__all__ = ["order_progress", "order_category", "top_label", "growth_pct"]
