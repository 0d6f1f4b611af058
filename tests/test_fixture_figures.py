"""Figures recorded in FIXTURES.md 2.3 (Spark = DuckDB there), pinned."""

import pytest
from pyspark.sql import functions as F

from kpiframe.labels import Labels
from kpiframe.operators import devices, orders, traffic, usage
from kpiframe.queries.registry import KPI_PERIOD, TRAFFIC_PERIOD, Ctx

from conftest import SF_ORACLE, SF_SMALL

ALL_SEGMENTS = Labels(products=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))

K1 = {
    SF_SMALL: {"AUTOMOBILE": (9, 3, 200.0), "BUILDING": (5, 5, 0.0), "FURNITURE": (6, 4, 50.0),
               "HOUSEHOLD": (6, 1, 500.0), "MACHINERY": (5, 2, 150.0)},
    SF_ORACLE: {"AUTOMOBILE": (40, 25, 60.0), "BUILDING": (35, 43, -18.6), "FURNITURE": (42, 38, 10.53),
                "HOUSEHOLD": (38, 43, -11.63), "MACHINERY": (47, 30, 56.67)},
}
K2 = {
    SF_SMALL: {"BUILDING": (3, 0.625, 200.0), "HOUSEHOLD": (2, 0.277778, None), "MACHINERY": (2, 0.5, None)},
    SF_ORACLE: {"BUILDING": (11, 0.366061, -38.89), "HOUSEHOLD": (15, 0.36381, 0.0),
                "MACHINERY": (13, 0.262727, 18.18)},
}
K3 = {SF_SMALL: (16, 7, 9, 60.0, 43.75), SF_ORACLE: (117, 23, 94, 7.34, 19.66)}
K4 = {SF_SMALL: ({"BUILDING": ("1", "33.33"), "MACHINERY": ("2", "66.67")}, ("AMERICA", "4"), "3"),
      SF_ORACLE: ({"BUILDING": ("17", "47.22"), "MACHINERY": ("19", "52.78")}, ("EUROPE", "23"), "42")}
K5 = {SF_SMALL: {"bundle": (2873, 2830, 1.52), "single": (408, 401, 1.75)},
      SF_ORACLE: {"bundle": (28944, 28562, 1.34), "single": (4196, 4151, 1.08)}}
# Page views previous -> current week for the three properties (user_id % 3 = 2, 1, 0).
K6 = {SF_SMALL: {"partner": (15, 17), "mobile": (17, 11), "website": (16, 12)},
      SF_ORACLE: {"partner": (145, 141), "mobile": (161, 142), "website": (173, 148)}}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_recorded_figures(spark, sf):
    c = Ctx(spark, sf)
    k1 = {r.product: (r.total_customer, r.prev_total_customer, r.growth_pct)
          for r in usage.customer_growth(c.usage_p(), KPI_PERIOD, ALL_SEGMENTS).collect()}
    assert k1 == K1[sf]
    k2 = {r.product: (r.total_mau, round(r.mau_percentage, 6), r.growth_pct) for r in c.k2().collect()}
    assert k2 == K2[sf]
    r = c.k3().first()
    assert (r.total_orders, r.total_completed, r.total_on_progress, r.growth_pct, r.completed_pct) == K3[sf]
    k4 = c.k4().collect()
    products = {x.label: (x.total_orders, x.percentage) for x in k4 if x.category == "product"}
    region = [(x.label, x.total_orders) for x in k4 if x.category == "regional"]
    status = [x.total_orders for x in k4 if x.category == "status"]
    assert (products, region[0], status[0]) == K4[sf]
    k5 = {x.product_type: (x.total_devices, x.prev_total_devices, x.growth_pct) for x in c.k5().collect()}
    assert k5 == K5[sf]
    k6 = c.k6().groupBy("property").agg(
        F.max(F.when(F.col("period") == "previous", F.col("page_views"))).alias("p"),
        F.max(F.when(F.col("period") == "current", F.col("page_views"))).alias("c"))
    assert {x.property: (x.p, x.c) for x in k6.collect()} == K6[sf]
