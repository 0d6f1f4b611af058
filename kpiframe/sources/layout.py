"""S1, S2 stored for their readers: orders by month, and both tables bucketed.

``store`` writes orders partitioned by the order month and bucketed by the
customer key, and customer bucketed alike. A reader of two months lists two
partitions, and the reduction of orders to customers and the join with them
take the buckets as they lie: no row of either table is shuffled. Only the
counted rows are, by product.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiframe.functions.period import Period, period_start

MONTH = "o_month"


class Bucketed:
    """Catalog tables ``<prefix>_orders`` and ``<prefix>_customer``."""

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark, self.prefix = spark, prefix

    @classmethod
    def store(cls, orders: DataFrame, customer: DataFrame, prefix: str | None = None, buckets: int | None = None) -> Bucketed:
        """Write both tables. ``buckets`` should be about the data's size over
        a task's share (by default the shuffle partitions); rows are dealt by
        key first, so a bucket is one file per month."""
        spark = orders.sparkSession
        made = cls(spark, prefix or f"kpi_{uuid.uuid4().hex}")
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        (orders.withColumn(MONTH, period_start(F.col("o_orderdate"))).repartition(n, "o_custkey")
         .write.format("parquet").partitionBy(MONTH).bucketBy(n, "o_custkey").sortBy("o_custkey")
         .saveAsTable(f"{made.prefix}_orders"))
        (customer.repartition(n, "c_custkey").write.format("parquet").bucketBy(n, "c_custkey").sortBy("c_custkey")
         .saveAsTable(f"{made.prefix}_customer"))
        return made

    def orders(self, period: Period | None = None) -> DataFrame:
        """Orders, with a ``period`` only from its months' partitions."""
        table = self.spark.table(f"{self.prefix}_orders")
        if period is None:
            return table
        return table.where((F.col(MONTH) >= F.lit(period.previous_start.replace(day=1)))
                           & (F.col(MONTH) < F.lit(period.current_end)))

    def customer(self) -> DataFrame:
        return self.spark.table(f"{self.prefix}_customer")

    def drop(self) -> None:
        for name in ("orders", "customer"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.prefix}_{name}")
