"""Plan checks: Python stays out of the plan, filters reach the scan, shared work is not repeated."""

import re

import pytest

from kpiframe.plans.inspect import explain_text, forbidden_nodes, pushed_filters, read_schemas, scan_count
from kpiframe.queries import registry

from conftest import SF_SMALL


def plan(df) -> str:
    return explain_text(df)


def scans(text: str, table: str) -> int:
    return scan_count(text, table)


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(fn(spark, SF_SMALL)) for name, fn in registry.queries().items()}


def test_no_python_or_cross_products(plans):
    for name, text in plans.items():
        assert forbidden_nodes(text) == [], name


@pytest.mark.parametrize("name, column", [
    ("customer_growth", "o_orderdate"), ("order_progress", "o_orderdate"), ("order_category", "o_orderdate"),
    ("device_growth", "l_shipdate"), ("traffic_metrics", "ts"), ("pred_month_range", "o_orderdate"),
])
def test_period_range_reaches_the_scan(plans, name, column):
    pushed = " ".join(pushed_filters(plans[name]))
    assert f"LessThan({column}," in pushed, pushed
    if name != "device_growth":
        assert f"GreaterThanOrEqual({column}," in pushed, pushed


@pytest.fixture(scope="module")
def static_plans(spark):
    """Plans with AQE off: exchange reuse is then decided at planning time and
    visible in the plan text (with AQE on it happens at runtime)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return {name: plan(fn(spark, SF_SMALL)) for name, fn in registry.queries().items()
                if name in ("device_growth", "order_category", "customer_growth", "report_slots",
                            "slot_missing_by_nation")}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_single_scans(static_plans):
    plans = static_plans
    assert scans(plans["device_growth"], "lineitem") == 1
    assert scans(plans["order_category"], "orders") == 1
    assert scans(plans["customer_growth"], "orders") == 1
    # whole report: usage (K1+K2 fused) and the order cube shared by K3 and K4 read orders;
    # K5 reads lineitem once, K6 events once.
    assert scans(plans["report_slots"], "orders") == 2
    assert scans(plans["report_slots"], "customer") == 2
    assert scans(plans["slot_missing_by_nation"], "orders") == 1
    assert scans(plans["report_slots"], "lineitem") == 1
    assert scans(plans["report_slots"], "events") == 1


def test_column_pruning(plans):
    schemas = read_schemas(plans["device_growth"])
    assert schemas == ["l_linenumber:int,l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz"]


def test_filter_after_lag_stays_above_the_window(spark):
    """P9: keeping the current month after LAG must not push the filter under the
    window (that would drop the previous month the LAG needs)."""
    import datetime as dt

    from pyspark.sql import functions as F

    from kpiframe.functions.growth import with_previous
    df = spark.createDataFrame([("a", dt.date(2001, 6, 1), 1), ("a", dt.date(2001, 7, 1), 2)],
                               "k string, m date, v bigint")
    out = with_previous(df, ["v"], "m", ["k"]).filter(F.col("m") == dt.date(2001, 7, 1))
    assert [tuple(r) for r in out.collect()] == [("a", dt.date(2001, 7, 1), 2, 1)]
    text = explain_text(out)
    physical = text.split("\n\n")[0]
    assert physical.index("Filter") < physical.index("Window")  # Filter is the parent of Window


def test_usage_aggregates_without_sort_and_prunes(plans):
    for name in ("customer_growth", "mau_growth", "pred_month_exact"):
        assert "ObjectHashAggregate" not in plans[name], name
        assert "GreaterThanOrEqual(o_orderdate," in " ".join(pushed_filters(plans[name])), name


@pytest.mark.parametrize("name", [
    "order_progress", "pred_not_in_null", "agg_counts", "win_lag_global", "fn_round2", "fn_safe_divide", "fn_list_join",
    "fmt_fixed2", "fmt_percent2", "phrase_fixed2",
])
def test_no_customer_where_none_is_needed(plans, name):
    assert scans(plans[name], "orders") == 1
    assert scans(plans[name], "customer") == 0


@pytest.mark.parametrize("name", [
    "order_category", "slot_missing_by_nation", "lookup_suffix", "win_share_of_total", "topk_region", "union_typed_null",
])
def test_orders_are_counted_before_the_customer_join(plans, name):
    """From the orders scan upwards an aggregate over the customer key comes before any join."""
    tree = plans[name].split("\n\n")[0].splitlines()
    details = plans[name]
    scan = re.search(r"\((\d+)\) Scan parquet[^\n]*\n[^(]*?Output[^\n]*o_custkey", details).group(1)
    at = next(i for i, line in enumerate(tree) if re.search(rf"Scan parquet .*\({scan}\)", line))
    above = []
    margin = len(re.match(r"[\s:+\-|]*", tree[at]).group(0))
    for line in reversed(tree[:at]):
        here = len(re.match(r"[\s:+\-|]*", line).group(0))
        if here < margin:
            above.append(line.strip(" :+-|*"))
            margin = here
    first = next(x for x in above if "Join" in x or "HashAggregate" in x)
    assert "HashAggregate" in first, above
