"""S3 kept as a table: daily running counters, extended by the new days only.

``mapped.daily_metrics`` sums all of lineitem up to the report's period, so
every report reads its whole history. :class:`DailyCounters` stores one row per
day and customer type, with the day's counts and the running sums, partitioned
by month. ``extend`` reads the days after the last stored one, a range that
reaches lineitem's scan, and adds the last running sums to theirs; a report
then reads the two months it compares. ``restate`` counts again from a day on,
for rows that arrived late, or after a write that was broken off.

One job extends a store at a time. Rows are only ever added to lineitem: a day
that loses all its rows there keeps its row here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiframe.functions.period import Period, period_start
from kpiframe.sources import mapped
from kpiframe.sources.scratch import written

_SUMS = [f"cumulative_{x}" for x in mapped.COUNTERS]
SCHEMA = ("date date, customer_type string, " + ", ".join(f"{x} bigint" for x in [*mapped.COUNTERS, *_SUMS])
          + ", month date")


class DailyCounters:
    """The stored counters under ``path``, at first empty."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], SCHEMA).write.mode("append").partitionBy("month").parquet(path)

    def table(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def last_day(self) -> dt.date | None:
        """The last stored day, from the last month's partition."""
        month = self.table().agg(F.max("month")).first()[0]
        return month and self.table().where(F.col("month") == F.lit(month)).agg(F.max("date")).first()[0]

    def extend(self, lineitem: DataFrame, upto: dt.date) -> None:
        """Append the days after the last stored one and before ``upto``. Days
        that are stored are never counted twice, so it can be run again."""
        last = self.last_day()
        self._append(lineitem, last and last + dt.timedelta(days=1), upto)

    def restate(self, lineitem: DataFrame, since: dt.date) -> None:
        """Count the stored days from ``since`` on again. Months before that of
        ``since`` stay untouched."""
        last = self.last_day()
        if last is None or last < since:
            return
        first = since.replace(day=1)
        kept = written(self.table().where((F.col("month") == F.lit(first)) & (F.col("date") < F.lit(since))))
        counts = mapped.daily_counts(lineitem, since, last + dt.timedelta(days=1))
        both = kept.select("date", "customer_type", *mapped.COUNTERS).unionByName(counts)
        self._write(both, self._sums_before(first), "overwrite", first, last)

    def rows(self, period: Period) -> DataFrame:
        """S3 rows of the two periods; only their months are read."""
        months = (F.col("month") >= F.lit(period.previous_start.replace(day=1))) & (F.col("month") < F.lit(period.current_end))
        return period.filter(self.table().where(months), "date").select("date", "customer_type", *_SUMS)

    def _sums_before(self, day: dt.date | None) -> DataFrame:
        """The running sums of each type before ``day``: one row per type. A
        type may have no row in the last days, so all months count."""
        table = self.table() if day is None else self.table().where(
            (F.col("month") < F.lit(day)) & (F.col("date") < F.lit(day)))
        # running sums never fall, so the last is the largest
        return table.groupBy("customer_type").agg(*[F.max(c).alias(f"before_{c}") for c in _SUMS])

    def _append(self, lineitem: DataFrame, since: dt.date | None, upto: dt.date) -> None:
        if since is None or since < upto:
            self._write(mapped.daily_counts(lineitem, since, upto), self._sums_before(None), "append")

    def _write(self, daily: DataFrame, before: DataFrame, mode: str, first: dt.date | None = None,
               last: dt.date | None = None) -> None:
        w = Window.partitionBy("customer_type").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
        sums = [(F.sum(x).over(w) + F.coalesce(f"before_cumulative_{x}", F.lit(0))).cast("bigint").alias(f"cumulative_{x}")
                for x in mapped.COUNTERS]
        rows = daily.join(written(before), "customer_type", "left").select(
            "date", "customer_type", *mapped.COUNTERS, *sums, period_start(F.col("date")).alias("month"))
        (rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(self.path))
        self.spark.catalog.refreshByPath(self.path)
