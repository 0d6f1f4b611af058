"""S7: write rendered report text (and slot tables) as partitioned Parquet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_reports(rendered: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write K12 output partitioned by its column ``report_month``, the start of
    the period that K10 gave every report.

    With dynamic partition overwrite only the months present in ``rendered``
    are replaced, each as a whole, so re-running one month leaves the others,
    whatever the reports of either are called. Output files are written by the
    executors in parallel; nothing passes through the driver.

    A table without that column is taken if its ids begin with an ISO date,
    as the ids do that K10 makes itself; any other id fails the write.
    """
    _by_month(rendered, path, mode)


def _by_month(df: DataFrame, path: str, mode: str) -> None:
    if "report_month" not in df.columns:
        month = F.regexp_extract("report_id", r"^(\d{4}-\d{2}-\d{2})(/|$)", 1)
        df = df.withColumn("report_month", F.to_date(F.when(month != "", month).otherwise(F.raise_error(
            F.concat(F.lit("no report_month, and none in the id "), F.col("report_id"))).cast("string"))))
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("report_month").parquet(path))


def write_slots(slots: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a K10 slot table partitioned by ``report_month`` (same layout)."""
    _by_month(slots, path, mode)


RENDERED_SCHEMA = "report_id string, deck_id string, template_id string, text string, report_month date"
SLOTS_SCHEMA = "report_id string, slot string, value string, report_month date"


def read_slots(spark: SparkSession, path: str, report_month: dt.date | str) -> DataFrame:
    """The written slot table of one month (its start); only that partition is read."""
    month = dt.date.fromisoformat(report_month) if isinstance(report_month, str) else report_month
    return spark.read.schema(SLOTS_SCHEMA).parquet(path).filter(F.col("report_month") == F.lit(month))


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Read written reports back with an explicit schema."""
    return spark.read.schema(RENDERED_SCHEMA).parquet(path)
