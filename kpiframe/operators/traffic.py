"""K6-K9: traffic metrics from raw events, growth text and summary.

Sessions
--------
A session is a run of one user's events (per property and period) with no
gap longer than ``gap`` (30 minutes; events exactly ``gap`` apart stay in one
session). Events are range-filtered to the two periods first.

``session_window`` or a ``lag`` over raw events sorts every event of a user
in one task, so one very active user (a bot with a third of all events)
becomes one huge task. Instead, events are first aggregated into
``gap``-wide time slots per user -- an ordinary combinable aggregate
(first/last timestamp, counts) with map-side partial aggregation, so a hot
user is spread over many tasks and combined early. Two events in one slot
are less than ``gap`` apart, so a session never splits inside a slot, and
the event before a slot's first event is the previous non-empty slot's last
event. The gap test and the session numbering therefore run on slot rows
only, whose number per user is bounded by the period length / ``gap``
(672 for two weeks), not by the user's event count.

Metrics per property and period: distinct users, page views, sessions,
engaged sessions (duration > 10 s, or >= 2 page views, or >= 1 key event),
engagement rate = engaged / sessions, bounce rate = 1 - engagement rate, and
mean session duration in seconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiframe.functions.growth import growth_pct
from kpiframe.functions.period import CURRENT, Period, typed_lit
from kpiframe.functions.text import (
    fixed2, flagged_list, growth_phrase, label_lookup, slot_name, summary_sentence, thousands,
)
from kpiframe.labels import DEFAULT_LABELS, METRIC_NAMES, Labels
from kpiframe.plans.broadcast import small_table
from kpiframe.sources import schemas

MICROS = 1_000_000

# Metric key -> (K6 column, text formatter) in summary order.
_METRICS = (
    ("users", "total_users", thousands),
    ("views", "page_views", thousands),
    ("eng", "engagement_rate", fixed2),
    ("dur", "avg_session_duration", fixed2),
    ("bounce", "bounce_rate", fixed2),
)
# Slot names of one property's traffic report, in report order:
# (slot name, column of the K7/K8 output).
TRAFFIC_SLOTS = (
    ("month", "month_label"),
    ("total_visitors", "total_visitors"),
    ("growth_total_visitors", "growth_total_visitors"),
    ("page_views", "page_views"),
    ("growth_page_views", "growth_page_views"),
    ("engagement_rate", "engagement_rate"),
    ("growth_engagement_rate", "growth_engagement_rate"),
    ("bounce_rate", "bounce_rate"),
    ("growth_bounce_rate", "growth_bounce_rate"),
    ("avg_engagement_time", "avg_engagement_time"),
    ("growth_avg_engagement_time", "growth_avg_engagement_time"),
    ("summary", "summary"),
)


def session_slots(
    events: DataFrame, period: Period, labels: Labels = DEFAULT_LABELS,
    gap_minutes: int = 30, by: Sequence[str] = (),
) -> DataFrame:
    """Per (``*by``, property, period, user, slot): first/last offset and counts."""
    ts_type = events.schema["ts"].dataType
    gap_us = gap_minutes * 60 * MICROS
    t_us = F.timestamp_diff("MICROSECOND", typed_lit(period.previous_start, ts_type), F.col("ts"))
    return (
        period.filter(events, "ts")
        .select(
            *by, "property", "user_id",
            period.tag("ts", ts_type).alias("period"),
            t_us.alias("t_us"),
            (F.col("event_type") == F.lit(labels.page_view_event)).alias("is_view"),
            F.col("event_type").isin(list(labels.key_events)).alias("is_key"),
        )
        .groupBy(*by, "property", "period", "user_id", F.floor(F.col("t_us") / F.lit(gap_us)).alias("slot"))
        .agg(
            F.min("t_us").alias("first_us"),
            F.max("t_us").alias("last_us"),
            F.count_if("is_view").alias("views"),
            F.count_if("is_key").alias("key_events"),
            F.count(F.lit(1)).alias("events"),
        )
    )


def sessions_from_slots(slots: DataFrame, gap_minutes: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Sessions from slot rows ``(*by, property, period, user_id, slot, first_us, last_us, views, key_events, events)``.

    A slot starts a session when the previous non-empty slot of the user
    ended more than ``gap`` before its first event. Both windows share one
    partitioning, bounded per user by the number of slots in the period.
    """
    gap_us = gap_minutes * 60 * MICROS
    keys = [*by, "property", "period", "user_id"]
    w = Window.partitionBy(*keys).orderBy("slot")
    starts = F.coalesce((F.col("first_us") - F.lag("last_us").over(w)) > F.lit(gap_us), F.lit(True))
    return (
        slots.withColumn("_start", starts.cast("int"))
        .withColumn("session", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "session")
        .agg(
            (F.max("last_us") - F.min("first_us")).alias("dur_us"),
            F.sum("views").alias("views"),
            F.sum("key_events").alias("key_events"),
            F.sum("events").alias("events"),
        )
    )


def sessions(
    events: DataFrame, period: Period, labels: Labels = DEFAULT_LABELS,
    gap_minutes: int = 30, by: Sequence[str] = (),
) -> DataFrame:
    """One row per session: ``*by, property, period, user_id, session, dur_us, views, key_events, events``."""
    return sessions_from_slots(session_slots(events, period, labels, gap_minutes, by), gap_minutes, by)


def metrics_from_sessions(
    s: DataFrame, period: Period, engaged_seconds: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """K6 metrics from session rows (per user first, then per property and period)."""
    keys = [*by, "property", "period", "user_id"]
    engaged = (
        (F.col("dur_us") > F.lit(engaged_seconds * MICROS))
        | (F.col("views") >= 2)
        | (F.col("key_events") >= 1)
    )
    per_user = s.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(engaged).alias("engaged_sessions"),
        F.sum("dur_us").alias("dur_us"),
        F.sum("views").alias("page_views"),
    )
    per_prop = per_user.groupBy(*by, "property", "period").agg(
        F.count(F.lit(1)).alias("total_users"),
        F.sum("page_views").alias("page_views"),
        F.sum("sessions").alias("sessions"),
        F.sum("engaged_sessions").alias("engaged_sessions"),
        F.sum("dur_us").alias("dur_us"),
    )
    rate = F.try_divide(F.col("engaged_sessions"), F.col("sessions"))
    start = F.when(F.col("period") == CURRENT, F.lit(period.current_start)).otherwise(F.lit(period.previous_start))
    return per_prop.select(
        *by, "property", "period", start.alias("period_start"),
        "total_users", "page_views", "sessions", "engaged_sessions",
        rate.alias("engagement_rate"),
        (F.lit(1.0) - rate).alias("bounce_rate"),
        (F.try_divide(F.col("dur_us"), F.col("sessions")) / F.lit(float(MICROS))).alias("avg_session_duration"),
    )


def traffic_metrics(
    events: DataFrame, period: Period, labels: Labels = DEFAULT_LABELS,
    gap_minutes: int = 30, engaged_seconds: int = 10, by: Sequence[str] = (),
) -> DataFrame:
    """K6: metrics per (``*by``, property, period); a period without events has no row.

    ``events`` needs ``ts, user_id, event_type, property`` (S4).
    """
    s = sessions(events, period, labels, gap_minutes, by)
    return metrics_from_sessions(s, period, engaged_seconds, by)


def traffic_growth(metrics: DataFrame, period: Period, by: Sequence[str] = ()) -> DataFrame:
    """K7: current vs previous metrics per property, formatted, with growth phrases.

    Growth phrases use the unrounded growth; a property lacking either
    period gives no row. Numeric ``cur_*``/``prev_*`` columns are kept for K8.
    """
    is_cur = F.col("period") == F.lit(CURRENT)
    aggs = []
    for key, col, _ in _METRICS:
        aggs.append(F.max(F.when(is_cur, F.col(col))).alias(f"cur_{key}"))
        aggs.append(F.max(F.when(~is_cur, F.col(col))).alias(f"prev_{key}"))
    wide = (
        metrics.groupBy(*by, "property")
        .agg(*aggs, F.count_if(is_cur).alias("_n_cur"), F.count_if(~is_cur).alias("_n_prev"))
        .filter((F.col("_n_cur") > 0) & (F.col("_n_prev") > 0))
        .drop("_n_cur", "_n_prev")
    )
    text_names = {
        "users": ("total_visitors", "growth_total_visitors"),
        "views": ("page_views", "growth_page_views"),
        "eng": ("engagement_rate", "growth_engagement_rate"),
        "bounce": ("bounce_rate", "growth_bounce_rate"),
        "dur": ("avg_engagement_time", "growth_avg_engagement_time"),
    }
    cols = {"month_label": period.label()}
    for key, _, fmt in _METRICS:
        value_name, growth_name = text_names[key]
        cur, prev = F.col(f"cur_{key}"), F.col(f"prev_{key}")
        cols[value_name] = fmt(cur)
        cols[growth_name] = growth_phrase(growth_pct(cur, prev), "traffic", prev=prev, cur=cur)
    return wide.withColumns(cols)


def improved_metrics(df: DataFrame) -> Column:
    """Names of metrics whose current value is strictly above the previous one.

    Fixed order: visitors, page views, engagement rate, engagement time,
    bounce rate. A higher bounce rate is listed too, as in the original report.
    """
    return flagged_list([(F.col(f"cur_{key}") > F.col(f"prev_{key}"), name)
                         for (key, _, _), name in zip(_METRICS, METRIC_NAMES, strict=True)])


def traffic_summary(growth: DataFrame) -> DataFrame:
    """K8: add ``improved`` (array) and the ``summary`` sentence to K7 rows."""
    improved = improved_metrics(growth)
    return growth.withColumns({"improved": improved, "summary": summary_sentence(improved)})


def suffix_table(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    """Broadcast ``(label, suffix)`` table from a parameter map."""
    return small_table(spark, sorted(mapping.items()), schemas.LABEL_SUFFIX)


def traffic_all(summary: DataFrame, labels: Labels = DEFAULT_LABELS, by: Sequence[str] = ()) -> DataFrame:
    """K9: long ``(*by, slot, value)`` rows for every property with a known suffix.

    Properties are a grouping key of one job rather than a loop of jobs;
    unknown properties (no suffix) are dropped.
    """
    suffix = label_lookup(F.col("property"), labels.property_suffix)
    pairs = F.inline(F.array(*[
        F.struct(slot_name(F.lit(name), F.col("_suffix")).alias("slot"), F.col(col).alias("value"))
        for name, col in TRAFFIC_SLOTS
    ]))
    return summary.select("*", suffix.alias("_suffix")).filter(F.col("_suffix").isNotNull()).select(*by, pairs)


_TEXT_METRICS = ("total_users", "page_views", "sessions", "engaged_sessions", "engagement_rate", "bounce_rate",
                 "avg_session_duration")


def _from_text(rows: DataFrame, number: Column, *more: Column) -> DataFrame:
    """One row per (property, period) of the metrics' numbers."""
    wide = rows.groupBy("property", "period", "period_start").agg(
        *[F.max(F.when(F.col("metric") == n, number)).alias(n) for n in _TEXT_METRICS], *more)
    return wide.select(
        "property", "period", "period_start",
        *[F.col(n).cast("bigint").alias(n) for n in _TEXT_METRICS[:4]],
        *[F.col(n) for n in wide.columns[3 + 4:]],
    )


def metrics_from_text(rows: DataFrame) -> DataFrame:
    """K6-shaped metrics from text-valued report rows (an analytics export).

    ``rows``: ``property, period, period_start, metric, value`` with ``metric``
    one of the K6 metric names and ``value`` a number as text (as analytics
    APIs return them). Text that is no number fails the job; NULL stays NULL. One row per (property, period).
    """
    return _from_text(rows, F.coalesce(_number(), F.when(F.col("value").isNotNull(), F.raise_error(
        F.concat(F.lit("not a number: "), F.col("value"))).cast("double"))))


def _number() -> Column:
    return F.col("value").try_cast("double")


def _rejected() -> Column:
    return F.col("value").isNotNull() & _number().isNull()


def checked_metrics_from_text(rows: DataFrame) -> DataFrame:
    """The same where text that is no number does not fail the job: it leaves
    its metric NULL, and the row says how many of its values there were
    (``n_values``, NULLs left out) and how many were no numbers
    (``n_rejected``). :func:`rejected_text` lists those. Values of metrics that
    are not K6's count as rejected."""
    known = F.col("metric").isin(list(_TEXT_METRICS))
    return _from_text(rows, _number(), F.count("value").alias("n_values"),
                      F.count_if(_rejected() | (F.col("value").isNotNull() & ~known)).alias("n_rejected"))


def rejected_text(rows: DataFrame) -> DataFrame:
    """``property, metric, value, n``: the texts that are no numbers, and those
    of metrics that K6 does not have, with their counts over all periods."""
    known = F.col("metric").isin(list(_TEXT_METRICS))
    return rows.where(_rejected() | (F.col("value").isNotNull() & ~known)).groupBy(
        "property", "metric", "value").agg(F.count(F.lit(1)).alias("n"))
