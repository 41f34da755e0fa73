"""Catalog and database tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmill.functions.times import partition_hour


def read_day(spark: SparkSession, table: str, day: str) -> DataFrame:
    """One day of a partitioned table; other days are pruned."""
    return spark.table(table).where(F.col("day") == day)


def read_history(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def partition_hours(spark: SparkSession, table: str, day: str | None = None) -> DataFrame:
    """Day and hour (a number) of each partition, from the catalog; no data is read."""
    only = f" PARTITION (day='{day}')" if day else ""
    names = spark.sql(f"SHOW PARTITIONS {table}{only}")
    return names.select(
        F.regexp_extract("partition", r"day=([^/]+)", 1).alias("day"),
        partition_hour(F.col("partition")).alias("hour"))


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
    split_column: str | None = None, lower: int = 0, upper: int = 0, partitions: int = 1,
) -> DataFrame:
    """A database table. With a numeric split column it is read in parallel ranges."""
    if split_column is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    return spark.read.jdbc(url, table, column=split_column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=dict(properties))
