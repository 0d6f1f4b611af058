"""Many-report decks, merged slots, the sink's months, and the stored sources."""

import datetime as dt
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from kpiframe.functions.growth import exact_mean
from kpiframe.functions.period import Period
from kpiframe.monthly import MonthlyReport
from kpiframe.operators import devices, report, sketches, traffic, usage
from kpiframe.plans.broadcast import small_table
from kpiframe.plans.inspect import explain_text, pushed_filters, scan_count
from kpiframe.queries.registry import KPI_PERIOD, TRAFFIC_PERIOD, Ctx
from kpiframe.sources import mapped, schemas, sinks
from kpiframe.sources.counters import DailyCounters
from kpiframe.sources.layout import Bucketed
from kpiframe.sources.scratch import scratch_path

from conftest import SF_ORACLE, SF_SMALL

JULY = Period("2001-08-15")


def part(spark, rows, by=()):
    columns = [*by, "slot", "value", "ord"]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'bigint' if c == 'ord' else 'string'}" for c in columns))


# -- S7: the sink's month ----------------------------------------------------------------------
def test_custom_ids_of_two_months_both_stay(spark, tmp_path):
    out = str(tmp_path / "reports")
    templates = small_table(spark, [("monthly", "t", "{report_month}: {n}")], schemas.TEMPLATES)
    phs = small_table(spark, [(1, "{report_month}", "report_month"), (2, "{n}", "n")], schemas.PLACEHOLDERS)
    for as_of, n in (("2001-07-15", "1"), ("2001-08-15", "2"), ("2001-08-15", "3")):
        slots = report.report_slots([part(spark, [("n", n, None)])], Period(as_of), report_id="germany-2001")
        sinks.write_reports(report.render_reports(report.slot_binding(slots, phs), templates), out)
    back = {(r.report_id, r.report_month): r.text for r in sinks.read_reports(spark, out).collect()}
    assert back == {("germany-2001", dt.date(2001, 6, 1)): "June 2001: 1", ("germany-2001", dt.date(2001, 7, 1)): "July 2001: 3"}


def test_ids_without_a_month_are_refused(spark, tmp_path):
    rendered = spark.createDataFrame([("germany", "monthly", "t", "x")], sinks.RENDERED_SCHEMA.rsplit(",", 1)[0])
    with pytest.raises(Exception, match="no report_month"):
        sinks.write_reports(rendered, str(tmp_path / "reports"))


def test_one_month_of_slots_is_one_partition(spark, tmp_path):
    out = str(tmp_path / "slots")
    for as_of in ("2001-07-15", "2001-08-15"):
        sinks.write_slots(report.report_slots([part(spark, [("n", as_of, None)])], Period(as_of), report_id="x"), out)
    july = sinks.read_slots(spark, out, "2001-07-01")
    assert {(r.slot, r.value) for r in july.collect()} == {("report_month", "July 2001"), ("n", "2001-08-15")}
    assert "PartitionFilters: [isnotnull(report_month" in explain_text(july)


# -- K10-K12: many reports, merges ---------------------------------------------------------------
def test_shared_slots_reach_every_report_and_bare_ones(spark):
    own = part(spark, [("a", "s", "own a", None), ("b", "u", "own b", None), (None, "s", "null's", None)], ["k"])
    shared = [part(spark, [("s", "shared", None), ("t", "common", None)])]
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,)], "k string")
    rows = report.report_slots([own], JULY, by=["k"], shared=shared, reports=names).collect()
    got = {(r.report_id, r.slot): r.value for r in rows}
    ids = {k: f"2001-07-01/{k}" for k in ("a", "b", "c", "\\N")}
    want = {(i, "report_month"): "July 2001" for i in ids.values()} | {(i, "t"): "common" for i in ids.values()}
    want |= {(ids[k], "s"): v for k, v in (("a", "own a"), ("b", "shared"), ("c", "shared"), ("\\N", "null's"))}
    want[ids["b"], "u"] = "own b"
    assert got == want and len(rows) == len(want)
    assert {r.report_month for r in rows} == {dt.date(2001, 7, 1)}


def test_the_winner_of_a_slot_is_the_same_each_time(spark):
    rows = [("s", f"v{i}", i % 50) for i in range(200)] + [("n", None, 9), ("n", "text", 3), ("e", "b", None), ("e", "a", None)]
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = part(spark, rows).repartition(seed + 1)
        got = {r.slot: r.value for r in report.report_slots([df, part(spark, [("z", "last", None)])], JULY).collect()}
        # the largest ord wins, even with a NULL; of equals the largest value
        assert got == {"report_month": "July 2001", "s": "v99", "n": None, "e": "b", "z": "last"}


def test_whole_decks_by_nation_and_region(spark, tmp_path):
    one = {(r.slot): r.value for r in Ctx(spark, SF_ORACLE).slots().collect()}
    decks = MonthlyReport(spark, SF_ORACLE, KPI_PERIOD, TRAFFIC_PERIOD, by=("regional",))
    rows = decks.slots().collect()
    by_report = {}
    for r in rows:
        by_report.setdefault(r.report_id, {})[r.slot] = r.value
    assert len(by_report) == 5
    for slots in by_report.values():
        shared = {s: v for s, v in one.items() if s.startswith("total_devices") or s.endswith(("_mobile", "_website", "_partner"))}
        assert shared and all(slots[s] == v for s, v in shared.items())
    number = lambda text: int(text.replace(".", ""))
    assert sum(number(s["total_orders"]) for s in by_report.values()) == number(one["total_orders"])
    assert sum(number(s["total_customer_building"]) for s in by_report.values()) == number(one["total_customer_building"])
    out = str(tmp_path / "decks")
    decks.run(out, strict=False)
    written = sinks.read_reports(spark, out)
    assert written.count() == 5 * 6 and written.select("report_month").distinct().collect() == [(dt.date(2001, 7, 1),)]


def test_a_deck_for_every_group_reads_each_source_once_more_only(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = explain_text(Ctx(spark, SF_SMALL).slots(["nation"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert (scan_count(text, "orders"), scan_count(text, "lineitem"), scan_count(text, "events")) == (2, 1, 1)


# -- O1, A2 -------------------------------------------------------------------------------------
def test_ranked_rows_keep_the_order(spark):
    rows = spark.createDataFrame([("x", 3), ("x", 1), ("y", 2), ("x", 2)], "k string, n int")
    assert {(r.k, r.n, r.pos) for r in usage.ranked(rows, ["n"], ["k"]).collect()} == {("x", 1, 1), ("x", 2, 2), ("x", 3, 3), ("y", 2, 1)}


def test_exact_mean_does_not_depend_on_order(spark):
    rnd = random.Random(4)
    xs = [rnd.random() * rnd.choice([1, 1e-9, -1]) for _ in range(4000)] + [None, 1.0, 0.0]
    unit = 2**52
    want = Fraction(sum((Fraction(x) * unit).__floor__() for x in xs if x is not None), unit)
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(xs)
        df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(seed + 2)
        seen.add(df.agg(exact_mean(F.col("x"))).first()[0])
    assert len(seen) == 1 and seen.pop() == pytest.approx(float(want / (len(xs) - 1)), rel=1e-15)
    none = spark.createDataFrame([(None,)], "x double").agg(exact_mean(F.col("x"))).first()[0]
    assert none is None


# -- F20 ----------------------------------------------------------------------------------------
def test_rejected_text_is_counted_beside_the_metrics(spark):
    rows = [("p", "d1", dt.date(2024, 1, 1), m, v) for m, v in (
        ("total_users", "12"), ("page_views", "--"), ("engagement_rate", " 0.5 "), ("bounce_rate", None), ("strange", "1"))]
    rows += [("p", "d2", dt.date(2024, 1, 2), "page_views", "--"), ("q", "d1", dt.date(2024, 1, 1), "sessions", "1e2")]
    df = spark.createDataFrame(rows, "property string, period string, period_start date, metric string, value string")
    got = {(r.property, r.period): r.asDict() for r in traffic.checked_metrics_from_text(df).collect()}
    first = got["p", "d1"]
    assert (first["total_users"], first["page_views"], first["engagement_rate"], first["bounce_rate"]) == (12, None, 0.5, None)
    assert (first["n_values"], first["n_rejected"]) == (4, 2)
    assert got["q", "d1"]["sessions"] == 100 and got["q", "d1"]["n_rejected"] == 0
    assert {tuple(r) for r in traffic.rejected_text(df).collect()} == {("p", "page_views", "--", 2), ("p", "strange", "1", 1)}
    with pytest.raises(Exception, match="not a number"):
        traffic.metrics_from_text(df).collect()


# -- A9 -----------------------------------------------------------------------------------------
def test_sketched_users_stay_within_the_bound(spark, tmp_path):
    events = spark.range(300_000).select(
        F.expr("timestamp_ntz'2024-01-08 00:00:00' + make_dt_interval(0, 0, 0, id * 4)").alias("ts"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(90_000))).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "website").otherwise("mobile").alias("property"))
    path = str(tmp_path / "sketches")
    daily = sketches.daily_users(events)
    sketches.store(daily, path)
    sketches.store(daily.where("date >= date'2024-01-15'"), path)  # counted again: nothing twice
    about = {(r.property, r.period): r.users for r in sketches.users(sketches.read(spark, path), TRAFFIC_PERIOD).collect()}
    exact = {(r.property, r.period): r.n for r in TRAFFIC_PERIOD.filter(events, "ts").groupBy(
        "property", TRAFFIC_PERIOD.tag("ts", events.schema["ts"].dataType).alias("period"))
        .agg(F.count_distinct("user_id").alias("n")).collect()}
    assert about.keys() == exact.keys() and len(exact) == 4
    for key, n in exact.items():
        assert n > 30_000 and abs(about[key] - n) <= sketches.bound() * n


# -- S3 -----------------------------------------------------------------------------------------
def test_extended_counters_equal_the_full_rebuild(spark):
    c = Ctx(spark, SF_ORACLE)
    stored = DailyCounters(spark, scratch_path(spark, "counters"))
    assert stored.last_day() is None
    for upto in (dt.date(1993, 3, 10), dt.date(1993, 3, 11), dt.date(1993, 3, 11), dt.date(1996, 12, 31), KPI_PERIOD.current_end):
        stored.extend(c.t.lineitem, upto)
    columns = ["date", "customer_type", *[f"cumulative_{x}" for x in mapped.COUNTERS]]
    full = {tuple(r) for r in mapped.daily_metrics(c.t.lineitem, KPI_PERIOD.current_end).select(columns).collect()}
    assert {tuple(r) for r in stored.table().select(columns).collect()} == full and stored.table().count() == len(full)
    stored.restate(c.t.lineitem, dt.date(1995, 5, 17))
    assert {tuple(r) for r in stored.table().select(columns).collect()} == full and stored.table().count() == len(full)
    assert devices.device_growth(stored.rows(KPI_PERIOD), KPI_PERIOD).collect() == c.k5().collect()


def test_new_days_alone_are_scanned(spark):
    since, upto = dt.date(2001, 7, 1), dt.date(2001, 8, 1)
    pushed = " ".join(pushed_filters(explain_text(mapped.daily_counts(Ctx(spark, SF_SMALL).t.lineitem, since, upto))))
    assert "GreaterThanOrEqual(l_shipdate,2001-07-01" in pushed and "LessThan(l_shipdate,2001-08-01" in pushed
    stored = DailyCounters(spark, scratch_path(spark, "counters"))
    stored.extend(Ctx(spark, SF_SMALL).t.lineitem, KPI_PERIOD.current_end)
    text = explain_text(stored.rows(KPI_PERIOD))
    assert "PartitionFilters: [isnotnull(month" in text


def test_late_rows_are_restated(spark):
    schema = "l_shipdate date, l_linestatus string, l_returnflag string, l_linenumber int"
    days = [dt.date(2001, 6, 28) + dt.timedelta(days=i) for i in range(8)]
    rows = [(d, k, "A", 1) for d in days for k in "OF"]
    late = [(days[4], "O", "R", 2), (days[4], "G", "N", 1)]
    stored = DailyCounters(spark, scratch_path(spark, "counters"))
    stored.extend(spark.createDataFrame(rows, schema), days[-1] + dt.timedelta(days=1))
    both = spark.createDataFrame(rows + late, schema)
    stored.extend(both, days[-1] + dt.timedelta(days=1))
    assert stored.table().where("cumulative_b > 0 OR cumulative_c > 0").count() == 0
    stored.restate(both, days[4])
    columns = ["date", "customer_type", *[f"cumulative_{x}" for x in mapped.COUNTERS]]
    assert ({tuple(r) for r in stored.table().select(columns).collect()}
            == {tuple(r) for r in mapped.daily_metrics(both).select(columns).collect()})


# -- S1, S2 -------------------------------------------------------------------------------------
def test_bucketed_sources_join_without_an_exchange(spark):
    c = Ctx(spark, SF_SMALL)
    stored = Bucketed.store(c.t.orders, c.t.customer, buckets=4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        usage_p = mapped.monthly_usage(stored.orders(KPI_PERIOD), stored.customer(), KPI_PERIOD)
        text = explain_text(usage_p)
        plain = explain_text(c.usage_p())
        # the counts' own exchange is the only one; from plain files there are four
        assert text.count("Exchange (") == 1, text
        assert plain.count("Exchange (") == 4
        assert "PartitionFilters: [isnotnull(o_month" in text and "GreaterThanOrEqual(o_orderdate" in text
        assert sorted(map(tuple, usage_p.collect())) == sorted(map(tuple, c.usage_p().collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        stored.drop()


def test_the_report_over_stored_sources_is_the_same(spark):
    """... and reads neither lineitem nor whole orders."""
    plain = {(r.slot, r.value) for r in Ctx(spark, SF_SMALL).slots().collect()}
    stored = Bucketed.store(Ctx(spark, SF_SMALL).t.orders, Ctx(spark, SF_SMALL).t.customer, buckets=4)
    try:
        rep = MonthlyReport(spark, SF_SMALL, KPI_PERIOD, TRAFFIC_PERIOD, counters=scratch_path(spark, "counters"),
                            bucketed=stored.prefix)
        slots = rep.slots()
        text = explain_text(slots)
        assert scan_count(text, "lineitem") == 0 and "PartitionFilters: [isnotnull(o_month" in text
        assert {(r.slot, r.value) for r in slots.collect()} == plain
    finally:
        stored.drop()
