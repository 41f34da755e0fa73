"""Session settings."""

from __future__ import annotations

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles: it starts from many partitions and merges
# small ones, and it splits skewed ones in joins and before writes.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def cluster_session(app: str) -> SparkSession:
    """A session on the cluster that spark-submit names; what is set there stays."""
    builder, given = SparkSession.builder.appName(app), SparkConf()
    running = SparkSession.getActiveSession()
    for key, value in CLUSTER_SETTINGS.items():
        if running is None and not given.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str, cores: int | str = "*") -> SparkSession:
    """A session in one process, for tests and timing."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
