"""Appending result tables to a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_jdbc(
    frame: DataFrame, url: str, table: str, properties: Mapping[str, str], connections: int = 4
) -> None:
    """Append rows. Each partition opens a connection, so they are dealt to as many as allowed.

    The shuffle keeps the work before it as parallel as it is. Credentials come from
    `properties`; nothing is stored in this library.
    """
    frame.repartition(connections).write.mode("append").jdbc(url, table, properties=dict(properties))


def dated_region_counts(counts: DataFrame) -> DataFrame:
    """Province counts with the current date, ready for `append_jdbc`."""
    return counts.select("province", "counts", F.current_date().alias("date"))
