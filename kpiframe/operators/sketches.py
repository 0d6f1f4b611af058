"""A9 approximately: users from sketches that add up over days.

Distinct users of a period cannot be summed from distinct users of its days, so
every new period reads its raw events again. An HLL sketch can: one sketch per
property and day (``2**lg_k`` registers at most, a few KB, however many users)
is built once, kept, and any period's users are estimated from the union of its
days' sketches. Building is an aggregate that combines map-side.

The estimate of n users lies within ``bound(lg_k)`` times n with a probability
of about 99.7 % (three standard errors of 1.04 / sqrt(2**lg_k)).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiframe.functions.period import Period

LG_K = 12
SCHEMA = "property string, users binary, date date"


def bound(lg_k: int = LG_K) -> float:
    """Relative error that an estimate keeps within three standard errors."""
    return 3 * 1.04 / (2 ** lg_k) ** 0.5


def daily_users(events: DataFrame, lg_k: int = LG_K, by: Sequence[str] = ()) -> DataFrame:
    """``*by, property, date, users``: a sketch of each day's users. Rows
    without a user are not counted; a day of such rows has an empty sketch."""
    return events.groupBy(*by, "property", F.to_date("ts").alias("date")).agg(
        F.hll_sketch_agg("user_id", F.lit(lg_k)).alias("users"))


def store(daily: DataFrame, path: str) -> None:
    """Keep daily sketches by day, one small file each. The days present are
    replaced, so a day can be counted again and is never kept twice; the others
    stay."""
    (daily.repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def users(daily: DataFrame, period: Period, by: Sequence[str] = ()) -> DataFrame:
    """``*by, property, period, users``: estimates for the two periods."""
    days = period.filter(daily, "date")
    return days.groupBy(*by, "property", period.tag("date", daily.schema["date"].dataType).alias("period")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))
