"""Driver-table mappings: hot keys and exact distinct semantics."""

import datetime as dt
import random
from collections import defaultdict

from kpiframe.functions.period import Period
from kpiframe.sources import mapped


def test_monthly_usage_with_hot_customer(spark):
    rnd = random.Random(2)
    tiers = ["1-URGENT", "3-MEDIUM", "5-LOW"]
    orders = []
    for i in range(4000):
        cust = 7 if i % 3 == 0 else rnd.randint(1, 60)  # customer 7 holds a third of all orders
        day = dt.datetime(2001, 5, 1) + dt.timedelta(days=rnd.randint(0, 120))
        orders.append((i, cust, rnd.choice("FOP"), 1.0, day, rnd.choice(tiers)))
    customers = [(c, f"c{c}", 1, 0.0, ["BUILDING", "MACHINERY"][c % 2]) for c in range(1, 61)]
    o = spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                                      "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    c = spark.createDataFrame(customers, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                                         "c_mktsegment string")
    seg = {cu[0]: cu[4] for cu in customers}
    want_total, want_mau = defaultdict(set), defaultdict(set)
    for _, cust, status, _, day, tier in orders:
        key = (seg[cust], dt.date(day.year, day.month, 1), tier)
        want_total[key].add(cust)
        if status == "F":
            want_mau[key].add(cust)
    got = {(r.product, r.month, r.tier): (r.total_customer, r.mau) for r in mapped.monthly_usage(o, c).collect()}
    assert got == {k: (len(v), len(want_mau[k])) for k, v in want_total.items()}
    # Period pruning gives the same rows for the two months.
    p = Period(dt.date(2001, 8, 15))
    pruned = {(r.product, r.month, r.tier): (r.total_customer, r.mau)
              for r in mapped.monthly_usage(o, c, p).collect()}
    assert pruned == {k: v for k, v in got.items() if k[1] in (p.previous_start, p.current_start)}


def test_read_source_with_declared_schema(spark, tmp_path):
    from kpiframe.sources import schemas
    from kpiframe.sources.tables import read_source
    rows = [("BUILDING", dt.date(2001, 7, 1), "a", 3, 1, 0.5)]
    spark.createDataFrame(rows, schemas.USAGE).write.parquet(str(tmp_path / "usage"))
    df = read_source(spark, str(tmp_path / "usage"), schemas.USAGE)
    assert df.schema.simpleString() == schemas.USAGE.simpleString()
    assert df.collect()[0].total_customer == 3


def test_hot_customer_order_join_is_split_by_aqe(spark, tmp_path):
    """A customer with a third of a month's orders: AQE splits the skewed join
    partition (no extra shuffle, since K3 aggregates on other keys) and the
    counts stay exact."""
    from kpiframe.operators import orders as ops
    from kpiframe.plans.inspect import explain_text

    rnd = random.Random(1)
    statuses = ["3-MEDIUM", "5-LOW", "4-NOT SPECIFIED"]
    rows = [(i, 7 if i % 3 == 0 else rnd.randint(1, 400), "O", 1.0,
             dt.datetime(2001, 7, 1) + dt.timedelta(days=rnd.randint(0, 30)), rnd.choice(statuses))
            for i in range(30000)]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                                "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(str(tmp_path / "o"))
    spark.createDataFrame([(k, f"c{k}", k % 25, 0.0, "BUILDING") for k in range(1, 401)],
                          "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
                          ).write.parquet(str(tmp_path / "c"))
    n = spark.createDataFrame([(k, f"n{k}", k % 5) for k in range(25)], "n_nationkey int, n_name string, n_regionkey int")
    r = spark.createDataFrame([(k, f"r{k}") for k in range(5)], "r_regionkey int, r_name string")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        p = Period(dt.date(2001, 8, 15))
        o, c = spark.read.parquet(str(tmp_path / "o")), spark.read.parquet(str(tmp_path / "c"))
        df = ops.order_progress(mapped.orders_flat(o, c, n, r, p), p)
        row = df.collect()[0]
        assert (row.total_orders, row.total_completed) == (30000, sum(1 for x in rows if x[5] == "5-LOW"))
        assert "SortMergeJoin(skew=true)" in explain_text(df)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_read_catalog_table(spark):
    from kpiframe.sources import schemas
    from kpiframe.sources.tables import read_catalog
    spark.createDataFrame([("BUILDING", dt.date(2001, 7, 1), "a", 3, 1, 0.5)], schemas.USAGE) \
        .createOrReplaceTempView("usage_monthly")
    assert read_catalog(spark, "usage_monthly").first().total_customer == 3


def test_an_appended_file_is_seen(spark, tmp_path):
    from kpiframe.sources.tables import DriverTables
    path = str(tmp_path / "orders.parquet")
    spark.range(10).write.parquet(path)
    assert DriverTables(spark, str(tmp_path)).orders.count() == 10
    spark.range(5).write.mode("append").parquet(path)
    assert DriverTables(spark, str(tmp_path)).orders.count() == 15
