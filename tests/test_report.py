"""K10-K12: slots, binding, strict check, ordered rendering."""

import pytest
from pyspark.sql import functions as F

from kpiframe.operators import report
from kpiframe.plans.broadcast import small_table
from kpiframe.sources import schemas


def slots_df(spark, rows):
    return small_table(spark, rows, schemas.SLOTS)


def ph_df(spark, rows):
    return small_table(spark, rows, schemas.PLACEHOLDERS)


def test_default_placeholders_shape():
    rows = report.default_placeholders()
    assert len(rows) == 46 and len({r[1] for r in rows}) == 46
    assert rows[0] == (1, "{report_month}", "report_month")


def test_binding_and_missing(spark):
    slots = slots_df(spark, [("r1", "a", "A"), ("r1", "b", "B"), ("r2", "a", "A2"), ("r1", "zz", "unused"),
                             ("r3", "zz", "only unrelated slots")])
    phs = ph_df(spark, [(1, "{a}", "a"), (2, "{b}", "b")])
    binding = {(r.report_id, r.placeholder): r.value for r in report.slot_binding(slots, phs).collect()}
    assert binding == {("r1", "{a}"): "A", ("r1", "{b}"): "B", ("r2", "{a}"): "A2", ("r2", "{b}"): None,
                       ("r3", "{a}"): None, ("r3", "{b}"): None}
    missing = sorted((r.report_id, r.placeholder) for r in report.slot_missing(slots, phs).collect())
    assert missing == [("r2", "{b}"), ("r3", "{a}"), ("r3", "{b}")]
    with pytest.raises(report.MissingSlotsError):
        report.assert_complete(slots, phs)
    report.assert_complete(slots.filter(F.col("report_id") == "r1"), phs)
    with pytest.raises(report.MissingSlotsError):
        report.assert_complete(slots.filter(F.col("report_id") == "r3"), phs)


def test_render_is_ordered_case_sensitive_and_literal(spark):
    binding = spark.createDataFrame([("r1", 1, "{a}", "X{b}"), ("r1", 2, "{b}", "Y"), ("r1", 3, "{c}", None),
                                     ("r1", 4, "[.]", "dot")],
                                    "report_id string, ord int, placeholder string, value string")
    templates = small_table(spark, [("monthly", "t1", "{a} {A} {c} {a} [.] x.y")], schemas.TEMPLATES)
    out = report.render_reports(binding, templates).collect()
    assert [r.text for r in out] == ["XY {A} {c} XY dot x.y"]


def test_render_matches_python_fold(spark):
    import random
    rnd = random.Random(5)
    keys = [f"{{k{i}}}" for i in range(12)]
    rows, expected = [], {}
    tmpl = " ".join(rnd.choice(keys) for _ in range(40))
    for rid in ("r1", "r2", "r3"):
        pairs = [(i + 1, k, rnd.choice(["v", "w", keys[(i + 1) % 12], ""])) for i, k in enumerate(keys)]
        rows += [(rid, o, k, v) for o, k, v in pairs]
        t = tmpl
        for _, k, v in pairs:
            t = t.replace(k, v)
        expected[rid] = t
    schema = "report_id string, ord int, placeholder string, value string"
    binding = spark.createDataFrame(rows, schema)
    templates = small_table(spark, [("monthly", "t", tmpl)], schemas.TEMPLATES)
    got = {r.report_id: r.text for r in report.render_reports(binding, templates).collect()}
    assert got == expected


def test_report_slots_last_part_wins(spark):
    import datetime as dt

    from kpiframe.functions.period import Period
    a = slots_df(spark, [("x", "s1", "first"), ("x", "s2", "only")]).select("slot", "value")
    b = slots_df(spark, [("x", "s1", "second")]).select("slot", "value")
    got = {r.slot: r.value for r in report.report_slots([a, b], Period(dt.date(2001, 8, 15))).collect()}
    assert got == {"report_month": "July 2001", "s1": "second", "s2": "only"}


def test_write_reports_partitioned(spark, tmp_path):
    from kpiframe.sources.sinks import read_reports, write_reports
    rendered = spark.createDataFrame([("2001-07-01", "monthly", "t1", "a"), ("2001-06-01", "monthly", "t1", "b")],
                                     "report_id string, deck_id string, template_id string, text string")
    out = str(tmp_path / "reports")
    write_reports(rendered, out)
    write_reports(rendered.filter("report_id = '2001-07-01'").withColumn("text", F.lit("new")), out)
    back = {r.report_id: r.text for r in read_reports(spark, out).collect()}
    assert back == {"2001-07-01": "new", "2001-06-01": "b"}


def test_many_reports_by_nation_end_to_end(spark):
    """One job: K3/K4 per nation -> slots per report -> binding, strict check, rendering."""
    import datetime as dt

    from kpiframe.functions.period import Period
    from kpiframe.operators import orders as ops
    from kpiframe.queries.registry import KPI_PERIOD, Ctx

    from conftest import SF_ORACLE
    c = Ctx(spark, SF_ORACLE)
    by = ["nation"]
    k3 = ops.order_progress(c.orders_p(), KPI_PERIOD, by=by)
    k4 = ops.order_category(c.orders_p("current"), KPI_PERIOD, by=by)
    slots = report.report_slots([report.progress_slots(k3, by), report.category_slots(k4, by=by)], KPI_PERIOD, by=by)
    names = ["total_orders", "growth_orders", "remaining_order_building", "remaining_order_machinery",
             "remaining_order_regional", "contract_document"]
    phs = ph_df(spark, [(i + 1, "{" + n + "}", n) for i, n in enumerate(names)])
    bound = report.slot_binding(slots, phs)
    missing = report.slot_missing(slots, phs).collect()
    # Every (report, placeholder) appears exactly once, bound or missing.
    per_report = {}
    for r in bound.collect():
        per_report.setdefault(r.report_id, set()).add(r.placeholder)
    assert len(per_report) == 25 and all(len(v) == len(names) for v in per_report.values())
    # Per-nation reports are small, so some nation lacks an open order of a share product.
    assert any(m.slot.startswith("remaining_order_") for m in missing)
    templates = small_table(spark, [("monthly", "t", "{total_orders} {remaining_order_building}")], schemas.TEMPLATES)
    rendered = report.render_reports(bound, templates).collect()
    assert len(rendered) == 25
    # Missing values leave the placeholder text in place.
    missing_building = {m.report_id for m in missing if m.slot == "remaining_order_building"}
    for r in rendered:
        assert ("{remaining_order_building}" in r.text) == (r.report_id in missing_building)
    assert dt.date(2001, 7, 1) == Period(dt.date(2001, 8, 15)).current_start


def test_small_table_round_trips_awkward_text(spark):
    import datetime as dt

    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("n", T.IntegerType()),
                           T.StructField("d", T.DateType())])
    rows = [("it's {a}", 1, dt.date(2001, 7, 1)), ("back\\\\slash \\\\' quote", None, None), ("", -5, None)]
    got = [tuple(r) for r in small_table(spark, rows, schema).collect()]
    assert got == rows


def test_render_each_report_with_its_own_deck(spark):
    binding = spark.createDataFrame([("r1", "short", 1, "{a}", "A1"), ("r2", "long", 1, "{a}", "A2")],
                                    "report_id string, deck string, ord int, placeholder string, value string")
    templates = small_table(spark, [("short", "s1", "S {a}"), ("long", "l1", "L1 {a}"), ("long", "l2", "L2 {a}")],
                            schemas.TEMPLATES)
    got = sorted((r.report_id, r.deck_id, r.template_id, r.text)
                 for r in report.render_reports(binding, templates, deck_id=F.col("deck")).collect())
    assert got == [("r1", "short", "s1", "S A1"), ("r2", "long", "l1", "L1 A2"), ("r2", "long", "l2", "L2 A2")]


def test_report_ids_are_injective_and_hold_the_period(spark):
    from kpiframe.functions.period import Period
    rows = [("a/b", "c"), ("a", "b/c"), (None, "x"), ("x", None), ("\\N", "x")]
    part = spark.createDataFrame([(*r, "s", "v") for r in rows], "k string, l string, slot string, value string")
    june, july = (report.report_slots([part], Period(f"2001-{m}-15"), by=["k", "l"]) for m in ("07", "08"))
    ids = {r.report_id for r in june.collect()} | {r.report_id for r in july.collect()}
    assert len(ids) == 2 * len(rows)


def test_next_month_leaves_the_last_one(spark, tmp_path):
    from kpiframe.sources.sinks import read_reports, write_reports
    out = str(tmp_path / "reports")
    schema = "report_id string, deck_id string, template_id string, text string"
    for month in ("2001-06-01", "2001-07-01"):
        write_reports(spark.createDataFrame([(f"{month}/GERMANY", "monthly", "t", month)], schema), out)
    assert sorted(r.text for r in read_reports(spark, out).collect()) == ["2001-06-01", "2001-07-01"]


def test_null_slot_values_are_missing(spark):
    slots, phs = slots_df(spark, [("r1", "a", "1"), ("r1", "b", None)]), ph_df(spark, [(1, "{a}", "a"), (2, "{b}", "b")])
    assert [r.slot for r in report.slot_missing(slots, phs).collect()] == ["b"]
    with pytest.raises(report.MissingSlotsError, match="1 placeholders"):
        report.assert_complete(slots, phs)


def test_no_report_is_dropped_by_its_deck_or_an_empty_map(spark):
    reports = spark.createDataFrame([("r1", "monthly"), ("r2", "lost")], "report_id string, deck string")
    none = spark.createDataFrame([], "report_id string, ord int, placeholder string, value string")
    templates = small_table(spark, [("monthly", "t", "as {it} is")], schemas.TEMPLATES)
    got = report.render_reports(none, templates, F.col("deck"), reports=reports)
    assert {r.report_id: r.text for r in got.collect()} == {"r1": "as {it} is", "r2": None}
    with pytest.raises(KeyError, match="r2"):
        report.assert_decks(got)


def test_labels_with_one_suffix_twice_are_rejected():
    from kpiframe.labels import Labels
    with pytest.raises(ValueError):
        Labels(product_suffix={"A": "x", "B": "x"})
