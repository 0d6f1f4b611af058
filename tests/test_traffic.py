"""K6-K9: slot-based sessions against brute force, metrics and text."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kpiframe import labels as L
from kpiframe.functions.period import Period
from kpiframe.operators import traffic
from kpiframe.sources import mapped, schemas
from kpiframe.sources.tables import DriverTables

from conftest import SF_SMALL

P = Period(dt.date(2024, 1, 24), "week")
T0 = dt.datetime(2024, 1, 15, 9, 0)


def events_df(spark, rows):
    return spark.createDataFrame([(i, ts, u, e, p) for i, (ts, u, e, p) in enumerate(rows)], schemas.TRAFFIC_EVENTS)


def brute_sessions(rows, period, gap=dt.timedelta(minutes=30)):
    """Sessions by sorting each user's events in Python: (prop, period, user) -> [(dur_s, views, keys)]."""
    lo = dt.datetime.combine(period.previous_start, dt.time())
    mid = dt.datetime.combine(period.current_start, dt.time())
    hi = dt.datetime.combine(period.current_end, dt.time())
    by_user = defaultdict(list)
    for ts, u, e, p in rows:
        if lo <= ts < hi:
            by_user[(p, "current" if ts >= mid else "previous", u)].append((ts, e))
    out = {}
    for k, evs in by_user.items():
        evs.sort()
        sessions, cur = [], [evs[0]]
        for ev in evs[1:]:
            if ev[0] - cur[-1][0] > gap:
                sessions.append(cur)
                cur = [ev]
            else:
                cur.append(ev)
        sessions.append(cur)
        out[k] = sorted(((s[-1][0] - s[0][0]).total_seconds(), sum(e == "view" for _, e in s),
                         sum(e in ("purchase", "signup") for _, e in s)) for s in sessions)
    return out


def spark_sessions(df, period):
    got = defaultdict(list)
    for r in traffic.sessions(df, period).collect():
        got[(r.property, r.period, r.user_id)].append((r.dur_us / 1e6, r.views, r.key_events))
    return {k: sorted(v) for k, v in got.items()}


def test_gap_boundary(spark):
    rows = [(T0, 1, "view", "website"), (T0 + dt.timedelta(minutes=30), 1, "view", "website"),
            (T0, 2, "view", "website"), (T0 + dt.timedelta(minutes=30, microseconds=1), 2, "view", "website")]
    s = spark_sessions(events_df(spark, rows), P)
    assert len(s[("website", "current", 1)]) == 1
    assert len(s[("website", "current", 2)]) == 2


def test_sessions_match_brute_force_with_hot_user(spark):
    rnd = random.Random(11)
    rows = []
    start = dt.datetime(2024, 1, 7, 20, 0)
    for _ in range(3000):  # user 0 is hot: a third of all events, dense bursts across slot edges
        rows.append((start + dt.timedelta(seconds=rnd.randint(0, 16 * 86400)), 0, rnd.choice(["view", "click"]),
                     "website"))
    for _ in range(6000):
        u = rnd.randint(1, 40)
        rows.append((start + dt.timedelta(seconds=rnd.randint(0, 16 * 86400), microseconds=rnd.randint(0, 999999)),
                     u, rnd.choice(["view", "click", "signup", "purchase", "error"]), ["website", "mobile"][u % 2]))
    df = events_df(spark, rows)
    assert spark_sessions(df, P) == brute_sessions(rows, P)


def test_sessions_match_session_window_on_driver_events(spark):
    ev = mapped.traffic_events(DriverTables(spark, SF_SMALL).events)
    ours = traffic.sessions(ev, P)
    ref = (P.filter(ev, "ts").withColumn("period", P.tag("ts", ev.schema["ts"].dataType))
           .groupBy("property", "period", "user_id", F.session_window("ts", "30 minutes"))
           .agg(F.count_if(F.col("event_type") == "view").alias("views")))
    assert ours.count() == ref.count()
    assert ours.agg(F.sum("views")).first()[0] == ref.agg(F.sum("views")).first()[0]


def test_metrics_definitions(spark):
    rows = [
        (T0, 1, "view", "website"), (T0 + dt.timedelta(seconds=5), 1, "click", "website"),   # 5 s, 1 view
        (T0 + dt.timedelta(hours=2), 1, "view", "website"),
        (T0 + dt.timedelta(hours=2, seconds=11), 1, "click", "website"),                    # 11 s: engaged
        (T0, 2, "view", "website"), (T0 + dt.timedelta(seconds=1), 2, "view", "website"),    # 2 views: engaged
        (T0, 3, "signup", "website"),                                                       # key event: engaged
        (T0 - dt.timedelta(days=7), 1, "view", "website"),                                  # previous week
    ]
    m = {r.period: r for r in traffic.traffic_metrics(events_df(spark, rows), P).collect()}
    cur = m["current"]
    assert (cur.total_users, cur.page_views, cur.sessions, cur.engaged_sessions) == (3, 4, 4, 3)
    assert cur.engagement_rate == 0.75 and cur.bounce_rate == 0.25
    assert abs(cur.avg_session_duration - (5 + 11 + 1 + 0) / 4) < 1e-12
    assert m["previous"].sessions == 1


def test_growth_needs_both_periods_and_summary(spark):
    rows = [(T0, 1, "view", "website"), (T0 - dt.timedelta(days=7), 1, "click", "website"),
            (T0 - dt.timedelta(days=7, seconds=1), 2, "click", "website"),
            (T0, 5, "view", "mobile")]  # mobile has no previous week -> no row
    g = traffic.traffic_summary(traffic.traffic_growth(traffic.traffic_metrics(events_df(spark, rows), P), P))
    rows = g.collect()
    assert [r.property for r in rows] == ["website"]
    r = rows[0]
    assert r.total_visitors == "1" and r.growth_total_visitors == "menurun sebanyak -50.00%"
    assert r.growth_page_views == L.TRAFFIC_NA_TEXT  # previous page views were 0
    assert r.month_label == "January 2024"
    assert r.improved == ["page view"] and r.summary == "page view" + L.SUMMARY_SUFFIX


def test_traffic_all_slots_per_property(spark):
    ev = mapped.traffic_events(DriverTables(spark, SF_SMALL).events)
    k8 = traffic.traffic_summary(traffic.traffic_growth(traffic.traffic_metrics(ev, P), P))
    slots = {r.slot: r.value for r in traffic.traffic_all(k8).collect()}
    assert len(slots) == 12 * 3
    assert slots["month_website"] == "January 2024"


def test_metrics_from_text_feed_growth(spark):
    rows = []
    for period, start, users, views in (("current", P.current_start, "120", "1500.0"),
                                        ("previous", P.previous_start, "100", None)):
        rows += [("website", period, start, "total_users", users), ("website", period, start, "page_views", views),
                 ("website", period, start, "engagement_rate", "0.5"), ("website", period, start, "bounce_rate", "0.5"),
                 ("website", period, start, "avg_session_duration", "10")]
    df = spark.createDataFrame(rows, "property string, period string, period_start date, metric string, value string")
    m = traffic.metrics_from_text(df)
    g = traffic.traffic_growth(m, P).collect()[0]
    assert g.total_visitors == "120" and g.growth_total_visitors == "meningkat sebanyak 20.00%"
    assert g.page_views == "1.500" and g.growth_page_views is None  # no previous value -> NULL
    bad = df.fillna("oops", "value")
    with pytest.raises(Exception, match="not a number: oops"):
        traffic.metrics_from_text(bad).collect()


def test_session_counts_match_recorded_figures(spark):
    """FIXTURES.md 2.3: sessions over all events per user (946 / 1000 / 52 at sf0.001,
    9549 / 10000 / 435 at sf0.01), with 'busy' = duration > 10 s or >= 2 events."""
    from conftest import SF_ORACLE
    whole_january = Period(dt.date(2024, 2, 15))  # current period = January 2024
    for sf, want in ((SF_SMALL, (946, 1000, 52)), (SF_ORACLE, (9549, 10000, 435))):
        ev = mapped.traffic_events(DriverTables(spark, sf).events)
        s = traffic.sessions(ev, whole_january).filter(F.col("period") == "current")
        got = s.agg(F.count(F.lit(1)), F.sum("events"),
                    F.count_if((F.col("dur_us") > 10_000_000) | (F.col("events") >= 2))).first()
        assert tuple(got) == want


def test_metrics_by_extra_keys_add_up(spark):
    ev = mapped.traffic_events(DriverTables(spark, SF_SMALL).events).withColumn(
        "channel", F.when(F.col("event_id") % 2 == 0, "a").otherwise("b"))
    whole = {r.property + r.period: (r.page_views, r.total_users)
             for r in traffic.traffic_metrics(ev, P).collect()}
    split = traffic.traffic_metrics(ev, P, by=["channel"]).groupBy("property", "period").agg(
        F.sum("page_views").alias("pv"), F.count(F.lit(1)).alias("n"))
    got = {r.property + r.period: r.pv for r in split.collect()}
    assert got == {k: v[0] for k, v in whole.items()}


def test_metrics_same_for_ltz_and_ntz_timestamps(spark):
    ev = mapped.traffic_events(DriverTables(spark, SF_SMALL).events)
    ltz = ev.withColumn("ts", F.col("ts").cast("timestamp"))  # session time zone is UTC in tests
    a = sorted(map(tuple, traffic.traffic_metrics(ev, P).collect()))
    b = sorted(map(tuple, traffic.traffic_metrics(ltz, P).collect()))
    assert a == b
