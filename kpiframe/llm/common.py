"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiframe.session import checkpoint_dir, ensure_checkpoint_dir

#: The white space that separates words everywhere in this subpackage.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession) -> str:
    """A new folder name in the shared folder of ``spark.checkpoint.dir``.

    Where that is unset, a single-machine session gets a temporary folder and
    a cluster the warehouse folder, which its executors share.
    """
    base = checkpoint_dir(spark)
    if not base:
        master = spark.conf.get("spark.master", "")
        alone = master.startswith("local") and not master.startswith("local-cluster")
        base = ensure_checkpoint_dir(
            spark, tempfile.mkdtemp(prefix="llm-") if alone else spark.conf.get("spark.sql.warehouse.dir") + "/_llm")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def materialise(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back: it
    cuts the lineage, survives lost executors and is computed only once."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that name a row by its id and text, nulls included; rows that
    agree in both are interchangeable and share a key."""
    return F.unhex(F.md5(F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("~")), F.when(text.isNull(), "n").otherwise("t"),
        F.coalesce(text, F.lit("")))))


def fresh(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def worker_state() -> dict:
    """What a Python worker keeps from task to task: tables read from
    vocabulary files and bounded caches that only save time."""
    import sys
    import types

    name = "_llm_worker_state"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__.setdefault("kept", {})


def groups_of(batches, size: int, weigh):
    """Rows of Arrow record batches as lists of dicts of about ``size`` weight
    (at least one row each), so that a task holds one such list at a time."""
    part, weight = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            part.append(row)
            weight += weigh(row)
            if weight >= size:
                yield part
                part, weight = [], 0
    if part:
        yield part
