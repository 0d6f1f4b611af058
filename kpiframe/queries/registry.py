"""Named queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Parameters (fixed for the driver's data):

* KPI period: as of 2001-08-15, monthly (current 2001-07, previous 2001-06);
* traffic period: as of 2024-01-24, weekly (current 2024-01-15..21).

Pipelines build the report layers K1-K12; primitives exercise one operator
each over whole tables (every month, every product, every day).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiframe.functions.growth import exact_mean, growth_pct, growth_pct_rounded, share_pct, with_previous
from kpiframe.functions.period import Period, bounds_columns, iso_date, month_label, period_start
from kpiframe.functions.text import (
    fixed2, flagged_list, growth_phrase, join_list, percent2, thousands,
)
from kpiframe.labels import DEFAULT_LABELS, Labels
from kpiframe.operators import devices, orders, report, sketches, traffic, usage
from kpiframe.sources import mapped, sinks
from kpiframe.sources.counters import DailyCounters
from kpiframe.sources.layout import Bucketed
from kpiframe.sources.scratch import scratch_path, written
from kpiframe.sources.tables import DriverTables

KPI_PERIOD = Period(dt.date(2001, 8, 15), "month")
TRAFFIC_PERIOD = Period(dt.date(2024, 1, 24), "week")
LABELS = DEFAULT_LABELS
# Status order for the month-over-month list primitive.
STATUS_ORDER = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


class Ctx:
    """View builders and report layers over one table directory.

    The registered queries use the fixed periods above; ``kpi``,
    ``traffic_period`` and ``labels`` let a report run for any date. With
    ``counters`` K5 reads stored counters, extended by the days they lack, and
    with ``stored`` K1-K4 read orders by month and customers by bucket.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, kpi: Period | None = None,
                 traffic_period: Period | None = None, labels: Labels | None = None,
                 counters: DailyCounters | None = None, stored: Bucketed | None = None):
        self.t = DriverTables(spark, sf_dir)
        self.spark = spark
        self.kpi = kpi or KPI_PERIOD
        self.traffic_period = traffic_period or TRAFFIC_PERIOD
        self.labels = labels or LABELS
        self.counters, self.stored = counters, stored

    # -- sources, whole tables ------------------------------------------------
    @cached_property
    def usage(self) -> DataFrame:
        return mapped.monthly_usage(self.t.orders, self.t.customer)

    @cached_property
    def orders(self) -> DataFrame:
        return mapped.orders_flat(self.t.orders, self.t.customer, self.t.nation, self.t.region)

    @cached_property
    def orders_plain(self) -> DataFrame:
        return mapped.orders_plain(self.t.orders)

    @cached_property
    def order_counts(self) -> DataFrame:
        return mapped.order_counts(self.t.orders, self.t.customer, self.t.nation, self.t.region)

    @cached_property
    def daily(self) -> DataFrame:
        return mapped.daily_metrics(self.t.lineitem)

    @cached_property
    def events(self) -> DataFrame:
        return mapped.traffic_events(self.t.events)

    # -- sources pruned to the KPI period at the scan ---------------------------
    def _tables(self) -> tuple[DataFrame, DataFrame]:
        if self.stored:
            return self.stored.orders(self.kpi), self.stored.customer()
        return self.t.orders, self.t.customer

    def usage_p(self, by: Sequence[str] = ()) -> DataFrame:
        orders, customer = self._tables()
        located = mapped.located_customers(customer, self.t.nation, self.t.region) if by else None
        return mapped.monthly_usage(orders, customer, self.kpi, by, located)

    def orders_p(self, which: str = "both") -> DataFrame:
        return mapped.order_counts(*self._tables(), self.t.nation, self.t.region, self.kpi, which)

    def daily_p(self) -> DataFrame:
        if self.counters:
            self.counters.extend(self.t.lineitem, self.kpi.current_end)
            return self.counters.rows(self.kpi)
        return mapped.daily_metrics(self.t.lineitem, upto=self.kpi.current_end, customer_type=self.labels.customer_type)

    # -- report layers --------------------------------------------------------
    def k12(self, by: Sequence[str] = ()) -> DataFrame:
        return usage.usage_growth(self.usage_p(by), self.kpi, self.labels, by)

    def k2(self) -> DataFrame:
        return usage.mau_growth(self.usage_p(), self.kpi, self.labels)

    def k3(self, by: Sequence[str] = ()) -> DataFrame:
        return orders.order_progress(self.orders_p(), self.kpi, self.labels, by=by)

    def k4(self, by: Sequence[str] = ()) -> DataFrame:
        return orders.order_category(self.orders_p(), self.kpi, self.labels, by=by)

    def k5(self) -> DataFrame:
        return devices.device_growth(self.daily_p(), self.kpi, self.labels)

    def k6(self) -> DataFrame:
        return traffic.traffic_metrics(self.events, self.traffic_period, self.labels)

    def k8(self) -> DataFrame:
        return traffic.traffic_summary(traffic.traffic_growth(self.k6(), self.traffic_period))

    def slots(self, by: Sequence[str] = ()) -> DataFrame:
        """K10 of the whole deck; with ``by`` (``nation`` or ``regional``) one
        deck for each of them, with or without customers. Devices and traffic
        are not known by place, so every deck shares their slots."""
        placed = [
            report.usage_slots(self.k12(by), self.labels, by),
            report.progress_slots(self.k3(by), by),
            report.category_slots(self.k4(by), self.labels, by),
        ]
        whole = [
            report.device_slots(self.k5(), self.labels),
            traffic.traffic_all(self.k8(), self.labels),
        ]
        if not by:
            return report.report_slots(placed + whole, self.kpi)
        places = mapped.places(self.t.nation, self.t.region).select(*by).distinct()
        return report.report_slots(placed, self.kpi, by=by, shared=whole, reports=places)


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Callable[[Ctx], DataFrame]] = {}


def _q(fn: Callable[[Ctx], DataFrame]) -> Callable[[Ctx], DataFrame]:
    _REGISTRY[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------------------
# Pipelines (K1-K12)
# ---------------------------------------------------------------------------
@_q
def customer_growth(c: Ctx) -> DataFrame:
    return usage.customer_growth(c.usage_p(), KPI_PERIOD, LABELS)


@_q
def customer_growth_ranked(c: Ctx) -> DataFrame:
    """O1: K1's rows with their places in the report's order."""
    return usage.ranked(usage.customer_growth(c.usage_p(), KPI_PERIOD, LABELS, sort=False), ["product"])


@_q
def mau_growth(c: Ctx) -> DataFrame:
    return c.k2()


@_q
def order_progress(c: Ctx) -> DataFrame:
    # alone, K3 needs no customer; in the report it shares K4's cube
    return orders.order_progress(mapped.orders_plain(c.t.orders, KPI_PERIOD), KPI_PERIOD, LABELS)


@_q
def order_category(c: Ctx) -> DataFrame:
    return c.k4()


@_q
def device_growth(c: Ctx) -> DataFrame:
    return c.k5()


@_q
def device_growth_incremental(c: Ctx) -> DataFrame:
    """K5 from stored counters (S3) that were extended month by month: lineitem
    is read once up to the previous month, then only the new days."""
    stored = DailyCounters(c.spark, scratch_path(c.spark, "counters"))
    for upto in (KPI_PERIOD.previous_start, KPI_PERIOD.previous_end, KPI_PERIOD.current_end):
        stored.extend(c.t.lineitem, upto)
    return devices.device_growth(stored.rows(KPI_PERIOD), KPI_PERIOD, LABELS)


@_q
def usage_bucketed(c: Ctx) -> DataFrame:
    """S1 of the two months from month-partitioned, bucketed tables."""
    stored = Bucketed.store(c.t.orders, c.t.customer)
    try:
        return written(mapped.monthly_usage(stored.orders(KPI_PERIOD), stored.customer(), KPI_PERIOD)).select(
            "product", "month", "tier", "total_customer", "mau")
    finally:
        stored.drop()


@_q
def traffic_metrics(c: Ctx) -> DataFrame:
    return c.k6()


@_q
def approx_users(c: Ctx) -> DataFrame:
    """A9 from stored daily sketches: the exact users of each week, and whether
    the estimate is within its bound of them."""
    path = scratch_path(c.spark, "sketches")
    sketches.store(sketches.daily_users(c.events), path)
    about = sketches.users(sketches.read(c.spark, path), TRAFFIC_PERIOD).withColumnRenamed("users", "about")
    exact = c.k6().select("property", "period", "total_users")
    off = F.abs(F.col("about") - F.col("total_users"))
    return exact.join(about, ["property", "period"], "left").select(
        "property", "period", "total_users", (off <= F.lit(sketches.bound()) * F.col("total_users")).alias("within_bound"))


def text_export(c: Ctx) -> DataFrame:
    """Hourly traffic per property as a text export has it: every value is
    text, a rate without a denominator is ``(not set)``, no views are ``--``,
    and one metric is not K6's."""
    hour = F.date_trunc("HOUR", "ts")
    views, signups = F.count_if(F.col("event_type") == "view"), F.count_if(F.col("event_type") == "signup")
    rate = F.try_divide(F.count_if(F.col("event_type") == "purchase"), signups)
    hourly = c.events.groupBy("property", hour.alias("hour")).agg(
        F.count_distinct("user_id").cast("string").alias("total_users"),
        F.when(views == 0, "--").otherwise(views.cast("string")).alias("page_views"),
        F.coalesce(rate.cast("string"), F.lit("(not set)")).alias("engagement_rate"),
        F.count_if(F.col("event_type") == "error").cast("string").alias("errors"))
    names = ["total_users", "page_views", "engagement_rate", "errors"]
    return hourly.select(
        "property", F.date_format("hour", "yyyy-MM-dd HH").alias("period"), F.to_date("hour").alias("period_start"),
        F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])))


@_q
def traffic_from_text(c: Ctx) -> DataFrame:
    """K6-shaped metrics from text, with the values that were no numbers."""
    return traffic.checked_metrics_from_text(text_export(c)).select(
        "property", "period", "period_start", "total_users", "page_views", "engagement_rate", "n_values", "n_rejected")


@_q
def traffic_rejects(c: Ctx) -> DataFrame:
    """the rejected texts, counted."""
    return traffic.rejected_text(text_export(c))


@_q
def traffic_growth(c: Ctx) -> DataFrame:
    g = traffic.traffic_growth(c.k6(), TRAFFIC_PERIOD)
    return g.select("property", *[col for _, col in traffic.TRAFFIC_SLOTS if col != "summary"])


@_q
def traffic_summary(c: Ctx) -> DataFrame:
    return c.k8().select("property", F.size("improved").alias("n_improved"), "summary")


@_q
def traffic_all(c: Ctx) -> DataFrame:
    return traffic.traffic_all(c.k8(), LABELS)


@_q
def report_slots(c: Ctx) -> DataFrame:
    return c.slots().drop("report_month")


@_q
def slot_binding(c: Ctx) -> DataFrame:
    return report.slot_binding(c.slots(), report.placeholder_table(c.spark)).drop("report_month")


def surplus_placeholders() -> list[tuple[int, str, str]]:
    """The deck's placeholders and one for a product whose open orders the
    report does not share out, so that no slot fills it."""
    rows = report.default_placeholders()
    return [*rows, (len(rows) + 1, "{remaining_order_household}", "remaining_order_household")]


@_q
def slot_missing(c: Ctx) -> DataFrame:
    return report.slot_missing(c.slots(), report.placeholder_table(c.spark, surplus_placeholders())).drop("report_month")


@_q
def slot_merge(c: Ctx) -> DataFrame:
    """U3: two parts that write one slot, and rows of one part that do. The
    first part counts each product's orders by status, ``ord`` following the
    status; the second all orders of the listed products."""
    counts = c.order_counts
    by_status = counts.groupBy("product", "fulfillment_status").agg(F.sum("n").alias("n"))
    first = by_status.select(F.concat(F.lit("orders_"), F.lower("product")).alias("slot"),
                             F.concat_ws(" ", "fulfillment_status", F.col("n").cast("string")).alias("value"),
                             F.left("fulfillment_status", F.lit(1)).cast("bigint").alias("ord"))
    second = (counts.where(F.col("product").isin(list(LABELS.share_products))).groupBy("product").agg(F.sum("n").alias("n"))
              .select(F.concat(F.lit("orders_"), F.lower("product")).alias("slot"), F.col("n").cast("string").alias("value")))
    return report.report_slots([first, second], KPI_PERIOD)


# The order part of the monthly deck: its placeholders, in deck order.
ORDER_SLOTS = ("report_month", "total_orders", "growth_orders", "total_completed_orders",
               "completed_orders_percentage", "total_on_progress_orders", "on_progress_orders_percentage",
               "remaining_order_building", "remaining_order_machinery", "remaining_order_regional",
               "total_remaining_order_regional", "contract_document")


NATION_TEMPLATES = [("monthly", "orders", "{report_month}: {remaining_order_building} building, "
                     "{remaining_order_machinery} machinery, most in {remaining_order_regional}")]


def order_placeholders() -> list[tuple[int, str, str]]:
    return [row for row in report.default_placeholders() if row[2] in ORDER_SLOTS]


def nation_slots(c: Ctx) -> DataFrame:
    """One order report per nation (K3 + K4 with ``by``), in one job."""
    by = ["nation"]
    k3 = orders.order_progress(c.orders_p(), KPI_PERIOD, LABELS, by=by)
    k4 = orders.order_category(c.orders_p(), KPI_PERIOD, LABELS, by=by)
    return report.report_slots(
        [report.progress_slots(k3, by), report.category_slots(k4, LABELS, by)], KPI_PERIOD, by=by
    )


@_q
def slot_missing_by_nation(c: Ctx) -> DataFrame:
    """K11 over many reports: the placeholders each nation's report cannot fill."""
    return report.slot_missing(nation_slots(c), report.placeholder_table(c.spark, order_placeholders())).drop("report_month")


@_q
def report_render_by_nation(c: Ctx) -> DataFrame:
    """K12 over many reports: every nation's order report, filled."""
    slots = nation_slots(c)
    bindings = report.slot_binding(slots, report.placeholder_table(c.spark, order_placeholders()))
    return report.render_reports(bindings, report.template_table(c.spark, NATION_TEMPLATES),
                                 reports=slots.select("report_id", "report_month")).drop("report_month")


@_q
def report_render_deck_by_nation(c: Ctx) -> DataFrame:
    """K12 over many reports: the whole deck of every nation in one job, with
    the shared device and traffic slots in each."""
    slots = written(c.slots(["nation"]))
    bindings = report.slot_binding(slots, report.placeholder_table(c.spark))
    return report.render_reports(bindings, report.template_table(c.spark), reports=slots.select("report_id", "report_month"))


SINK_TEMPLATES = [("monthly", "orders", "{report_month}: {total_orders} orders")]


@_q
def report_sink(c: Ctx) -> DataFrame:
    """S7: the order reports of two months under one custom id, the second of
    them written twice, read back from the sink."""
    path = scratch_path(c.spark, "reports")
    previous = Period(KPI_PERIOD.current_start, "month")
    for period in (previous, KPI_PERIOD, KPI_PERIOD):
        k3 = orders.order_progress(mapped.orders_plain(c.t.orders, period), period, LABELS)
        slots = report.report_slots([report.progress_slots(k3)], period, report_id="orders")
        bindings = report.slot_binding(slots, report.placeholder_table(c.spark, order_placeholders()))
        sinks.write_reports(report.render_reports(bindings, report.template_table(c.spark, SINK_TEMPLATES)), path)
    return sinks.read_reports(c.spark, path)


@_q
def report_render(c: Ctx) -> DataFrame:
    bindings = report.slot_binding(c.slots(), report.placeholder_table(c.spark))
    return report.render_reports(bindings, report.template_table(c.spark)).drop("report_month")


# ---------------------------------------------------------------------------
# Primitives
# ---------------------------------------------------------------------------
def _order_month(c: Ctx) -> DataFrame:
    return c.orders_plain.withColumn("order_month", period_start(F.col("order_created_date")))


@_q
def pred_in(c: Ctx) -> DataFrame:
    return c.orders.filter(F.col("product").isin(list(LABELS.products))).select("order_id", "product")


@_q
def pred_month_exact(c: Ctx) -> DataFrame:
    return usage.usage_months(c.usage_p(), KPI_PERIOD, LABELS.products).select(
        "product", "month", "tier", "total_customer", "mau"
    )


@_q
def pred_month_range(c: Ctx) -> DataFrame:
    return KPI_PERIOD.filter(c.t.orders, "o_orderdate").select(
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("order_created_date"),
        F.col("o_orderpriority").alias("fulfillment_status"),
    )


@_q
def pred_not_in_null(c: Ctx) -> DataFrame:
    return c.orders_plain.filter(~F.col("fulfillment_status").isin(list(LABELS.excluded_statuses))).select(
        "order_id", "fulfillment_status"
    )


@_q
def period_bounds(c: Ctx) -> DataFrame:
    months = c.t.orders.select(period_start(F.col("o_orderdate")).alias("m")).distinct()
    as_of = F.date_add(F.col("m"), 14)
    b = bounds_columns(as_of, "month")
    return months.select(
        as_of.alias("as_of"),
        *[col.alias(name) for name, col in b.items()],
        iso_date(b["current_start"]).alias("current_start_text"),
        iso_date(b["current_last_day"]).alias("current_last_day_text"),
    )


@_q
def lookup_suffix(c: Ctx) -> DataFrame:
    counts = c.order_counts.groupBy("product").agg(F.sum("n").alias("n_orders"))
    sfx = traffic.suffix_table(c.spark, LABELS.product_suffix).withColumnRenamed("label", "product")
    return counts.join(sfx, "product").select("product", "suffix", "n_orders")


@_q
def agg_sum_avg(c: Ctx) -> DataFrame:
    return c.usage.groupBy("product", "month").agg(
        F.sum("total_customer").alias("total_customer"),
        F.sum("mau").alias("total_mau"),
        exact_mean(F.col("ratio")).alias("avg_ratio"),
    )


@_q
def agg_counts(c: Ctx) -> DataFrame:
    return _order_month(c).groupBy("order_month").agg(
        F.count("order_id").alias("n_ids"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("fulfillment_status") == LABELS.closed_status).alias("n_closed"),
    )


@_q
def agg_max_sum(c: Ctx) -> DataFrame:
    return c.daily.groupBy("customer_type", period_start(F.col("date")).alias("month")).agg(
        (F.max("cumulative_a") + F.max("cumulative_b") + F.max("cumulative_c")).alias("total_abc"),
        F.max("cumulative_d").alias("total_d"),
    )


def _product_months(c: Ctx) -> DataFrame:
    monthly = c.usage.groupBy("product", "month").agg(F.sum("total_customer").alias("total_customer"))
    return with_previous(monthly, ["total_customer"], "month", ["product"])


@_q
def win_lag_partitioned(c: Ctx) -> DataFrame:
    return _product_months(c)


def _order_months(c: Ctx) -> DataFrame:
    monthly = _order_month(c).groupBy("order_month").agg(F.count("order_id").alias("total_orders"))
    return with_previous(monthly, ["total_orders"], "order_month")


@_q
def win_lag_global(c: Ctx) -> DataFrame:
    return _order_months(c)


@_q
def win_share_of_total(c: Ctx) -> DataFrame:
    counts = c.order_counts.groupBy("product").agg(F.sum("n").alias("n"))
    return counts.select("product", "n", share_pct(F.col("n"), F.sum("n").over(Window.partitionBy())).alias("share"))


@_q
def topk_region(c: Ctx) -> DataFrame:
    open_ = c.order_counts.filter(~F.col("fulfillment_status").isin(list(LABELS.open_excluded)))
    counts = open_.groupBy("regional").agg(F.sum("n").alias("n"))
    return orders.top_label(counts, "regional")


@_q
def union_typed_null(c: Ctx) -> DataFrame:
    """Two typed arms (status counts with a NULL percentage, product counts with
    their share) from one scan: pre-aggregate, then tag the arms with ``inline``."""
    pre = c.order_counts.groupBy("fulfillment_status", "product").agg(F.sum("n").alias("n"))
    arms = F.inline(F.array(
        F.struct(F.lit("status").alias("category"), F.col("fulfillment_status").alias("label"), "n"),
        F.struct(F.lit("product").alias("category"), F.col("product").alias("label"), "n"),
    ))
    counts = pre.select(arms).groupBy("category", "label").agg(F.sum("n").alias("n"))
    share = share_pct(F.col("n"), F.sum("n").over(Window.partitionBy("category")))
    return counts.select(
        "category", "label", F.col("n").cast("string").alias("total_orders"),
        F.when(F.col("category") == "product", fixed2(share)).alias("percentage"),
    )


@_q
def fn_month_trunc(c: Ctx) -> DataFrame:
    return c.t.orders.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _closed_share(c: Ctx) -> DataFrame:
    return _order_month(c).groupBy("order_month").agg(
        F.count_if(F.col("fulfillment_status") == LABELS.closed_status).alias("n_closed"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@_q
def fn_round2(c: Ctx) -> DataFrame:
    return _closed_share(c).select(
        "order_month", F.round(share_pct(F.col("n_closed"), F.col("n_rows")), 2).alias("completed_pct")
    )


@_q
def fn_growth_pct(c: Ctx) -> DataFrame:
    return _product_months(c).select(
        "product", "month", growth_pct(F.col("total_customer"), F.col("prev_total_customer")).alias("growth_pct")
    )


@_q
def fn_safe_divide(c: Ctx) -> DataFrame:
    st = F.col("fulfillment_status")
    return c.orders_plain.groupBy("order_created_date").agg(
        F.try_divide(F.count_if(st == LABELS.closed_status), F.count_if(st == "1-URGENT")).alias("closed_per_urgent")
    )


@_q
def fn_month_label(c: Ctx) -> DataFrame:
    months = c.t.orders.select(period_start(F.col("o_orderdate")).alias("month")).distinct()
    return months.select("month", month_label(F.col("month")).alias("label"))


@_q
def fn_list_join(c: Ctx) -> DataFrame:
    st = F.col("fulfillment_status")
    names = [f"s{i}" for i in range(len(STATUS_ORDER))]
    monthly = _order_month(c).groupBy("order_month").agg(
        *[F.count_if(st == s).alias(n) for s, n in zip(STATUS_ORDER, names, strict=True)]
    )
    lagged = with_previous(monthly, names, "order_month")
    grown = flagged_list([(F.col(n) > F.col(f"prev_{n}"), s) for s, n in zip(STATUS_ORDER, names, strict=True)])
    return lagged.select("order_month", F.size(grown).alias("n_grown"), join_list(grown).alias("grown_text"))


def _key_sums(c: Ctx) -> DataFrame:
    return c.t.orders.groupBy(period_start(F.col("o_orderdate")).alias("order_month")).agg(
        F.sum("o_orderkey").alias("key_sum")
    )


@_q
def fmt_thousands(c: Ctx) -> DataFrame:
    return _key_sums(c).select("order_month", "key_sum", thousands(F.col("key_sum")).alias("key_sum_text"))


@_q
def fmt_fixed2(c: Ctx) -> DataFrame:
    return _closed_share(c).select(
        "order_month", fixed2(F.try_divide(F.col("n_closed"), F.col("n_rows"))).alias("completed_fraction_text")
    )


@_q
def fmt_percent2(c: Ctx) -> DataFrame:
    return _closed_share(c).select(
        "order_month", percent2(share_pct(F.col("n_closed"), F.col("n_rows"))).alias("completed_pct_text")
    )


@_q
def phrase_cast(c: Ctx) -> DataFrame:
    g = growth_pct_rounded(F.col("total_customer"), F.col("prev_total_customer"))
    return _product_months(c).select("product", "month", growth_phrase(g, "cast").alias("growth_phrase"))


@_q
def phrase_fixed2(c: Ctx) -> DataFrame:
    g = growth_pct_rounded(F.col("total_orders"), F.col("prev_total_orders"))
    return _order_months(c).select("order_month", growth_phrase(g, "fixed2").alias("growth_phrase"))


@_q
def phrase_float(c: Ctx) -> DataFrame:
    monthly = c.daily.groupBy("customer_type", period_start(F.col("date")).alias("month")).agg(
        (F.max("cumulative_a") + F.max("cumulative_b") + F.max("cumulative_c")).alias("total_devices")
    )
    lagged = with_previous(monthly, ["total_devices"], "month", ["customer_type"])
    g = growth_pct_rounded(F.col("total_devices"), F.col("prev_total_devices"))
    return lagged.select("customer_type", "month", growth_phrase(g, "float").alias("growth_phrase"))


@_q
def phrase_traffic(c: Ctx) -> DataFrame:
    daily = c.events.groupBy("property", F.to_date("ts").alias("day")).agg(
        F.count_if(F.col("event_type") == LABELS.page_view_event).alias("views")
    )
    lagged = with_previous(daily, ["views"], "day", ["property"])
    cur, prev = F.col("views"), F.col("prev_views")
    return lagged.select(
        "property", "day", growth_phrase(growth_pct(cur, prev), "traffic", prev=prev, cur=cur).alias("growth_phrase")
    )


def queries() -> dict[str, Query]:
    """Registered queries as ``(spark, sf_dir) -> DataFrame`` callables."""
    return {name: (lambda fn: (lambda spark, sf_dir: fn(Ctx(spark, sf_dir))))(fn) for name, fn in _REGISTRY.items()}


def names() -> list[str]:
    return list(_REGISTRY)
