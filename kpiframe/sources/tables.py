"""Readers for source tables with declared schemas, and the driver table set."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read one source with an explicit schema; Parquet by default.

    With a declared schema Spark skips footer-based inference, and any column
    the plan does not use is pruned from ``ReadSchema``.
    """
    return spark.read.schema(schema).format(fmt).load(path)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """Read a catalog table (e.g. a month-partitioned fact table)."""
    return spark.table(name)


class DriverTables:
    """Lazy handles on the driver's Parquet tables under ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        if name not in DRIVER_TABLES:
            raise KeyError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer")

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @cached_property
    def region(self) -> DataFrame:
        return self.table("region")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")
