"""Edge fixtures for K1-K5 (FIXTURES.md section 3) and equivalence properties."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from kpiframe import labels as L
from kpiframe.functions.growth import growth_pct_rounded, with_previous
from kpiframe.functions.period import Period
from kpiframe.operators import devices, orders, report, usage
from kpiframe.sources import schemas

D = dt.date
P = Period(D(2001, 8, 15))
CUR, PREV = D(2001, 7, 1), D(2001, 6, 1)


def usage_df(spark, rows):
    return spark.createDataFrame(rows, schemas.USAGE)


def test_k1_edges(spark):
    rows = [
        ("BUILDING", CUR, "a", 10, 5, 0.5), ("BUILDING", PREV, "a", 8, 4, 0.5),
        ("BUILDING", D(2001, 7, 2), "a", 1000, 1, 0.1),        # mid-month: dropped
        ("MACHINERY", CUR, "a", 7, 3, 0.4),                    # no previous month
        ("HOUSEHOLD", PREV, "a", 9, 3, 0.3),                   # no current month
        ("AUTOMOBILE", CUR, "a", 99, 1, 0.1),                  # product not listed
    ]
    got = {r.product: r for r in usage.customer_growth(usage_df(spark, rows), P).collect()}
    assert set(got) == {"BUILDING", "MACHINERY"}
    assert got["BUILDING"].total_customer == 10 and got["BUILDING"].growth_pct == 25.0
    assert got["BUILDING"].growth_phrase == "meningkat sebanyak 25%"
    assert got["MACHINERY"].growth_pct is None and got["MACHINERY"].growth_phrase == L.FLAT_TEXT


def test_k1_is_ordered_and_later_slots_win(spark):
    rows = [(p, m, "a", n, 1, 0.1) for p, n in (("MACHINERY", 5), ("BUILDING", 6), ("HOUSEHOLD", 7)) for m in (CUR, PREV)]
    got = [r.product for r in usage.customer_growth(usage_df(spark, rows).repartition(5), P).collect()]
    assert len(got) > 1 and got == sorted(got)
    parts = [spark.createDataFrame([("x", v), (own, v)], "slot string, value string")
             for own, v in (("p", "first"), ("q", None), ("r", "last"))]
    for some, x in ((parts, "last"), (parts[::-1], "first"), (parts[:2], None)):
        got = {r.slot: r.value for r in report.report_slots(some, P).collect()}
        assert got["x"] == x and got["p"] == "first" and got["q"] is None


def test_k1_prev_zero_and_tiny_growth(spark):
    rows = [("BUILDING", CUR, "a", 5, 1, 0.2), ("BUILDING", PREV, "a", 0, 1, 0.2),
            ("MACHINERY", CUR, "a", 25001, 1, 0.2), ("MACHINERY", PREV, "a", 25000, 1, 0.2)]
    got = {r.product: r for r in usage.customer_growth(usage_df(spark, rows), P).collect()}
    assert got["BUILDING"].growth_pct is None and got["BUILDING"].growth_phrase == L.FLAT_TEXT
    assert got["MACHINERY"].growth_pct == 0.0 and got["MACHINERY"].growth_phrase == L.FLAT_TEXT  # 0.004 %
    assert got["MACHINERY"].total_customer_text == "25.001"


def test_k2_unweighted_mean(spark):
    rows = [("BUILDING", CUR, "a", 10, 1, 0.1), ("BUILDING", CUR, "b", 1000, 9, 0.9),
            ("BUILDING", PREV, "a", 10, 4, 0.5)]
    r = usage.mau_growth(usage_df(spark, rows), P).collect()[0]
    assert r.total_mau == 10 and abs(r.mau_percentage - 0.5) < 1e-12
    assert r.mau_percentage_text == "50.00%" and r.growth_phrase == "meningkat sebanyak 150%"


def test_usage_conditional_aggregation_equals_lag(spark):
    """The fused one-aggregate plan equals aggregate-then-LAG on the same rows."""
    import random
    rnd = random.Random(7)
    rows = [(p, m, t, rnd.randint(0, 50), rnd.randint(0, 50), rnd.random())
            for p in L.Labels().products for m in (CUR, PREV) for t in "abc" if rnd.random() < 0.8]
    df = usage_df(spark, rows)
    fused = {r.product: (r.total_customer, r.growth_pct) for r in usage.customer_growth(df, P).collect()}
    monthly = df.filter(F.col("month").isin(PREV, CUR)).groupBy("product", "month").agg(
        F.sum("total_customer").alias("total_customer"))
    lagged = with_previous(monthly, ["total_customer"], "month", ["product"]).filter(F.col("month") == CUR)
    lag = {r.product: (r.total_customer, r.g) for r in lagged.select(
        "product", "total_customer",
        growth_pct_rounded(F.col("total_customer"), F.col("prev_total_customer")).alias("g")).collect()}
    assert fused == lag


def orders_df(spark, rows):
    return spark.createDataFrame(
        [(i, d, s, p, r, "N") for i, d, s, p, r in rows], schemas.ORDERS)


def test_k3_null_id_and_null_status(spark):
    rows = [(1, D(2001, 7, 3), "5-LOW", "BUILDING", "ASIA"),
            (None, D(2001, 7, 3), "5-LOW", "BUILDING", "ASIA"),      # NULL id: closed +1, total +0
            (3, D(2001, 7, 4), None, "BUILDING", "ASIA"),            # NULL status: dropped
            (4, D(2001, 7, 5), "1-URGENT", "BUILDING", "ASIA"),      # excluded
            (5, D(2001, 7, 6), "3-MEDIUM", "BUILDING", "ASIA"),
            (6, D(2001, 6, 6), "3-MEDIUM", "BUILDING", "ASIA")]
    r = orders.order_progress(orders_df(spark, rows), P).collect()[0]
    assert (r.total_orders, r.total_completed, r.total_on_progress, r.prev_total_orders) == (2, 2, 1, 1)
    assert r.growth_phrase == "meningkat sebanyak 100.00%" and r.completed_pct_text == "100.00%"


def test_k3_no_current_month_gives_no_row(spark):
    rows = [(6, D(2001, 6, 6), "3-MEDIUM", "BUILDING", "ASIA")]
    assert orders.order_progress(orders_df(spark, rows), P).count() == 0


def test_k4_arms(spark):
    rows = [(1, D(2001, 7, 1), "4-NOT SPECIFIED", "BUILDING", None),
            (2, D(2001, 7, 2), "3-MEDIUM", "BUILDING", None),
            (3, D(2001, 7, 2), "3-MEDIUM", "MACHINERY", "ASIA"),
            (4, D(2001, 7, 2), "5-LOW", "MACHINERY", "ASIA"),         # closed: not open
            (5, D(2001, 7, 2), "3-MEDIUM", "HOUSEHOLD", "ASIA"),
            (6, D(2001, 6, 2), "3-MEDIUM", "BUILDING", "EUROPE")]     # previous month: ignored
    got = {(r.category, r.label): (r.total_orders, r.percentage)
           for r in orders.order_category(orders_df(spark, rows), P).collect()}
    assert got[("status", "4-NOT SPECIFIED")] == ("1", None)
    assert got[("product", "BUILDING")] == ("2", "66.67")
    assert got[("product", "MACHINERY")] == ("1", "33.33")
    # NULL region has 2 open orders, ASIA 2: tie -> label ascending, NULL last -> ASIA
    regional = [k for k in got if k[0] == "regional"]
    assert regional == [("regional", "ASIA")] and got[("regional", "ASIA")] == ("2", None)


def test_k4_null_region_can_win(spark):
    rows = [(1, D(2001, 7, 1), "3-MEDIUM", "BUILDING", None), (2, D(2001, 7, 1), "3-MEDIUM", "BUILDING", None),
            (3, D(2001, 7, 1), "3-MEDIUM", "BUILDING", "ASIA")]
    got = [r for r in orders.order_category(orders_df(spark, rows), P).collect() if r.category == "regional"]
    assert len(got) == 1 and got[0].label is None and got[0].total_orders == "2"


def test_k4_by_keys_top_per_group(spark):
    rows = [(1, D(2001, 7, 1), "3-MEDIUM", "BUILDING", "ASIA"), (2, D(2001, 7, 1), "3-MEDIUM", "BUILDING", "ASIA"),
            (3, D(2001, 7, 1), "3-MEDIUM", "BUILDING", "EUROPE")]
    df = orders_df(spark, rows).withColumn("nation", F.when(F.col("order_id") == 3, "X").otherwise("Y"))
    got = {r.nation: r.label for r in orders.order_category(df, P, by=["nation"]).collect()
           if r.category == "regional"}
    assert got == {"X": "EUROPE", "Y": "ASIA"}


def daily_df(spark, rows):
    return spark.createDataFrame(rows, schemas.DAILY_METRICS)


def test_k5_null_counter_and_growth(spark):
    rows = [(D(2001, 6, 30), "O", 10, 5, 5, 50), (D(2001, 7, 30), "O", 12, None, 6, 40),
            (D(2001, 7, 31), "O", 13, None, 7, 44), (D(2001, 7, 31), "F", 1000, 1000, 1000, 1000)]
    got = {r.product_type: r for r in devices.device_growth(daily_df(spark, rows), P).collect()}
    assert got["bundle"].total_devices is None and got["bundle"].growth_phrase == L.FLAT_TEXT
    assert got["single"].total_devices == 44 and got["single"].growth_phrase == "menurun sebanyak 12.0%"


def test_k5_one_scan_equals_two_arm_union(spark):
    import random
    rnd = random.Random(3)
    rows = [(D(2001, 6, 1) + dt.timedelta(days=i), "O", *[rnd.randint(0, 100) for _ in range(4)])
            for i in range(61)]
    df = daily_df(spark, rows)
    fused = {r.product_type: (r.total_devices, r.prev_total_devices) for r in devices.device_growth(df, P).collect()}
    month = F.trunc("date", "MM")
    arm1 = df.groupBy(month.alias("m")).agg(
        (F.max("cumulative_a") + F.max("cumulative_b") + F.max("cumulative_c")).alias("t")).withColumn("k", F.lit("bundle"))
    arm2 = df.groupBy(month.alias("m")).agg(F.max("cumulative_d").alias("t")).withColumn("k", F.lit("single"))
    w = Window.partitionBy("k").orderBy("m")
    two = arm1.unionByName(arm2).withColumn("p", F.lag("t").over(w)).filter(F.col("m") == CUR)
    assert fused == {r.k: (r.t, r.p) for r in two.collect()}


def test_k4_shares_sum_to_100_before_rounding(spark):
    from kpiframe.functions.growth import share_pct
    from kpiframe.queries.registry import Ctx
    from conftest import SF_ORACLE
    c = Ctx(spark, SF_ORACLE)
    open_ = c.orders_p("current").filter(~F.col("fulfillment_status").isin(list(L.Labels().open_excluded)))
    counts = open_.filter(F.col("product").isin(list(L.Labels().share_products))).groupBy("product").count()
    shares = counts.select(share_pct(F.col("count"), F.sum("count").over(Window.partitionBy())).alias("s"))
    total = shares.agg(F.sum("s")).first()[0]
    assert abs(total - 100.0) < 1e-9
    shown = {r.label: float(r.percentage) for r in orders.order_category(c.orders_p("current"), P).collect()
             if r.category == "product"}
    assert abs(sum(shown.values()) - 100.0) <= 0.01 * len(shown)


def test_k4_fill_zero(spark):
    rows = [(1, D(2001, 7, 1), "3-MEDIUM", "BUILDING", "ASIA"), (2, D(2001, 7, 1), "5-LOW", "MACHINERY", "ASIA")]
    df = orders_df(spark, rows)
    plain = {(r.category, r.label) for r in orders.order_category(df, P).collect()}
    assert plain == {("product", "BUILDING"), ("regional", "ASIA")}
    filled = {(r.category, r.label): (r.total_orders, r.percentage)
              for r in orders.order_category(df, P, fill_zero=True).collect()}
    assert filled[("product", "MACHINERY")] == ("0", "0.00")
    assert filled[("product", "BUILDING")] == ("1", "100.00")
    assert filled[("status", "4-NOT SPECIFIED")] == ("0", None)
    assert filled[("regional", "ASIA")] == ("1", None)


def test_with_previous_by_row_and_by_calendar(spark):
    df = spark.createDataFrame([("a", D(2001, 1, 1), 10), ("a", D(2001, 2, 1), 20), ("a", D(2001, 4, 1), 40)],
                               "k string, m date, v bigint")
    by_row = {r.m: r.prev_v for r in with_previous(df, ["v"], "m", ["k"]).collect()}
    by_cal = {r.m: r.prev_v for r in with_previous(df, ["v"], "m", ["k"], calendar_unit="month").collect()}
    assert by_row == {D(2001, 1, 1): None, D(2001, 2, 1): 10, D(2001, 4, 1): 20}
    assert by_cal == {D(2001, 1, 1): None, D(2001, 2, 1): 10, D(2001, 4, 1): None}


def test_usage_and_devices_by_keys_add_up(spark):
    import random
    rnd = random.Random(9)
    rows = [(p, m, t, rnd.randint(1, 50), rnd.randint(0, 20), rnd.random())
            for p in L.Labels().products for m in (CUR, PREV) for t in "abc"]
    df = usage_df(spark, rows)
    whole = {r.product: r.total_customer for r in usage.usage_growth(df, P).collect()}
    split = usage.usage_growth(df, P, by=["tier"]).groupBy("product").agg(F.sum("total_customer").alias("t"))
    assert {r.product: r.t for r in split.collect()} == whole
    assert usage.customer_growth(df, P, by=["tier"]).count() == 3 * 3

    drows = [(D(2001, 6, 1) + dt.timedelta(days=i), "O", i, i, i, i) for i in range(61)]
    daily = daily_df(spark, drows).withColumn("site", F.when(F.dayofmonth("date") % 2 == 0, "x").otherwise("y"))
    per_site = devices.device_growth(daily, P, by=["site"]).collect()
    assert {(r.site, r.product_type) for r in per_site} == {(s, a) for s in "xy" for a in ("bundle", "single")}
