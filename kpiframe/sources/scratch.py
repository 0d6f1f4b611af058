"""Places for tables that a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from kpiframe.session import checkpoint_dir, ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str = "kpi") -> str:
    """A new path in the shared folder that the cluster names in
    ``spark.checkpoint.dir``. Where that is unset, a session on one machine
    gets a temporary folder, and a cluster its warehouse folder."""
    base = checkpoint_dir(spark)
    if not base:
        master = spark.conf.get("spark.master", "")
        alone = master.startswith("local") and not master.startswith("local-cluster")
        base = ensure_checkpoint_dir(
            spark, tempfile.mkdtemp(prefix="kpi-") if alone else spark.conf.get("spark.sql.warehouse.dir") + "/_kpi")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "kpi") -> DataFrame:
    """``df`` written once and read back: its lineage is cut, a lost executor
    costs a read, and what uses it twice computes it once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
