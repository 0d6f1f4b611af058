"""Session settings suited to these plans (tests, bench, local runs).

On a cluster the session comes from the platform; the builders only need
AQE on. ``ensure_checkpoint_dir`` keeps a cluster's shared
``spark.checkpoint.dir`` and sets one only where none is configured.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    # PySpark 4 captures the Python call site on every API call (several JVM
    # round trips each) to enrich error messages; plan building is much
    # faster without it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Settings for the ~100 TB deployment (applied with ``cluster_builder``).
# - Scans: 512 MB splits; after column pruning a lineitem split is a few
#   narrow columns, so one task stays well inside executor memory.
# - Shuffles: start from 8000 partitions and let AQE coalesce to ~256 MB.
#   Every big aggregation here is partial/final, so post-shuffle data is
#   small; the large shuffles are the customer-key join of two months of
#   orders and the per-user slot rows of two traffic periods.
# - Skew: AQE splits skewed join partitions (a customer with a third of the
#   orders of a month); the session and usage paths pre-aggregate hot keys
#   themselves.
# - Broadcast: the planner may broadcast up to 64 MB by file statistics
#   (dimension tables); fact-side joins stay shuffle joins.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def cluster_builder(app: str = "kpiframe", extra: dict[str, str] | None = None):
    """``SparkSession.builder`` with :data:`CLUSTER_CONF` (master from spark-submit)."""
    builder = SparkSession.builder.appName(app)
    for k, v in {**CLUSTER_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    return builder


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kpiframe",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint directory of this session, if one is configured."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Return the session's checkpoint dir, setting ``fallback`` only if unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
