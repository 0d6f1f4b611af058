"""Report sources (S1-S4) derived from the driver's TPC-H-like tables.

The report reads four sources: monthly usage, orders, daily cumulative
counters and raw traffic events. The driver ships none of them, so each is
derived here from its tables; every derivation is a Spark plan over the whole
input (a join, an aggregation, a window over daily rows), so its cost grows
with the data.

When a ``Period`` (or an ``upto`` date) is passed, the range filter is put on
the raw date column before any join or aggregation, where it reaches the
Parquet scan. That is exact: every derived row of the requested periods
depends only on raw rows inside the same range (or, for running sums, before
its end).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiframe.functions.period import Period, period_start, typed_lit

# Property names assigned to events by ``user_id % 3``.
PROPERTIES = ("website", "mobile", "partner")


def monthly_usage(orders: DataFrame, customer: DataFrame, period: Period | None = None,
                  by: Sequence[str] = (), located: DataFrame | None = None) -> DataFrame:
    """S1: per (segment, month, priority) distinct customers and those with a filled order.

    ``product`` = ``c_mktsegment``, ``tier`` = ``o_orderpriority``,
    ``total_customer`` = distinct ordering customers, ``mau`` = distinct
    customers with an ``F`` order, ``ratio`` = mau / total_customer. With ``by``
    also per column of ``located`` (:func:`located_customers`), such as nation.

    Plan: orders are first reduced to one row per (customer, month, tier) by a
    hash aggregate that combines map-side, so a customer holding a third of
    all orders is collapsed before any shuffle. Only those rows are joined
    with customer, and only the final small count is exchanged again.
    """
    o = orders if period is None else period.filter(orders, "o_orderdate")
    seen = o.groupBy(
        F.col("o_custkey").alias("custkey"), period_start(F.col("o_orderdate"), "month").alias("month"),
        F.col("o_orderpriority").alias("tier"),
    ).agg(F.bool_or(F.col("o_orderstatus") == F.lit("F")).alias("any_filled"))
    c = customer.select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("product"))
    if by:
        c = located.select("custkey", "product", *by)
    return (
        seen.join(c, "custkey").groupBy(*by, "product", "month", "tier")
        .agg(F.count(F.lit(1)).alias("total_customer"), F.count_if(F.col("any_filled")).alias("mau"))
        .withColumn("ratio", F.try_divide(F.col("mau"), F.col("total_customer")))
    )


def places(nation: DataFrame, region: DataFrame) -> DataFrame:
    """n_nationkey, n_regionkey, nation and regional: one row per nation."""
    return nation.select("n_nationkey", "n_regionkey", F.col("n_name").alias("nation")).join(
        region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("regional")),
        "n_regionkey",
    )


def located_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """custkey, product (segment), nation and region of every customer. The
    nation and region dimensions are tiny; the planner broadcasts them from
    their file-size statistics."""
    return customer.select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("n_nationkey"),
        F.col("c_mktsegment").alias("product"),
    ).join(places(nation, region), "n_nationkey")


def _plain(orders: DataFrame, *more: Column) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("order_created_date"),
        F.col("o_orderpriority").alias("fulfillment_status"),
        *more,
    )


def orders_plain(orders: DataFrame, period: Period | None = None) -> DataFrame:
    """S2 without product and geography: one row per order with date and
    status, for what needs no customer. Nothing is joined or shuffled."""
    return _plain(orders if period is None else period.filter(orders, "o_orderdate"))


def order_counts(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame,
                 period: Period | None = None, which: str = "both") -> DataFrame:
    """S2 counted: partial counts ``n`` by status, product, region, nation and
    whether the order id is present (``has_id``); with a ``period`` also by
    its tag ``period``.

    Orders are reduced per customer by a hash aggregate that combines map-side
    before the customer join, so a customer holding a third of all orders
    brings a handful of rows to the join.
    """
    o = orders if period is None else period.filter(orders, "o_orderdate", which)
    tag = [] if period is None else [period.tag("o_orderdate", orders.schema["o_orderdate"].dataType).alias("period")]
    per_customer = o.groupBy(
        F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("fulfillment_status"),
        F.col("o_orderkey").isNotNull().alias("has_id"), *tag,
    ).agg(F.count(F.lit(1)).alias("n"))
    return per_customer.join(located_customers(customer, nation, region), "custkey").drop("custkey", "n_nationkey", "n_regionkey")


def orders_flat(
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    period: Period | None = None,
    which: str = "both",
) -> DataFrame:
    """S2: one row per order with status, product (segment), region and nation.

    ``fulfillment_status`` = ``o_orderpriority``. Customer is joined by key
    and grows with the data, so no hint is given and AQE picks the strategy
    from runtime sizes. What only counts orders takes :func:`order_counts`.
    """
    o = orders if period is None else period.filter(orders, "o_orderdate", which)
    return _plain(o, F.col("o_custkey").alias("custkey")).join(located_customers(customer, nation, region), "custkey").select(
        "order_id", "order_created_date", "fulfillment_status", "product", "regional", "nation"
    )


def daily_metrics(
    lineitem: DataFrame, upto: dt.date | None = None, customer_type: str | None = None
) -> DataFrame:
    """S3: daily running counters per ``l_linestatus`` (customer type).

    ``cumulative_a/b/c`` count return flags ``A``, ``R``, ``N`` and
    ``cumulative_d`` first lines, summed from the first day on. The daily
    aggregate is partial/final (map-side combine), so the window only ever
    sees one row per day and type, however large ``lineitem`` is.
    ``upto`` (exclusive) prunes later ship dates at the scan; earlier running
    sums are unaffected.
    """
    return running(daily_counts(lineitem, upto=upto, customer_type=customer_type))


COUNTERS = ("a", "b", "c", "d")


def daily_counts(lineitem: DataFrame, since: dt.date | None = None, upto: dt.date | None = None,
                 customer_type: str | None = None) -> DataFrame:
    """``date, customer_type, a, b, c, d``: each day's own counts. ``since``
    (inclusive) and ``upto`` (exclusive) are pushed to the scan."""
    li, kind = lineitem, lineitem.schema["l_shipdate"].dataType
    if since is not None:
        li = li.filter(F.col("l_shipdate") >= typed_lit(since, kind))
    if upto is not None:
        li = li.filter(F.col("l_shipdate") < typed_lit(upto, kind))
    if customer_type is not None:
        li = li.filter(F.col("l_linestatus") == F.lit(customer_type))
    flag = F.col("l_returnflag")
    return li.groupBy(
        F.to_date("l_shipdate").alias("date"), F.col("l_linestatus").alias("customer_type")
    ).agg(
        F.count_if(flag == "A").alias("a"),
        F.count_if(flag == "R").alias("b"),
        F.count_if(flag == "N").alias("c"),
        F.count_if(F.col("l_linenumber") == 1).alias("d"),
    )


def running(daily: DataFrame) -> DataFrame:
    """``date, customer_type, cumulative_a .. cumulative_d`` of daily counts."""
    w = Window.partitionBy("customer_type").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "date", "customer_type",
        *[F.sum(x).over(w).cast("bigint").alias(f"cumulative_{x}") for x in COUNTERS],
    )


def property_of(user_id: Column, properties: Sequence[str] = PROPERTIES) -> Column:
    """Property name by ``user_id % len(properties)``."""
    idx = F.pmod(user_id, F.lit(len(properties)))
    branches = [(idx == i, F.lit(p)) for i, p in enumerate(properties)]
    first, *rest = branches
    return reduce(lambda acc, b: acc.when(*b), rest, F.when(*first))


def traffic_events(events: DataFrame, properties: Sequence[str] = PROPERTIES) -> DataFrame:
    """S4: raw events with a ``property`` column."""
    return events.select(
        "event_id", "ts", "user_id", "event_type", property_of(F.col("user_id"), properties).alias("property")
    )
