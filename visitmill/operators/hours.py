"""Assigning rows to hour partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill.functions.times import hour_lower, hour_number, hour_of, hour_upper
from visitmill.schema import INTENDED, check_semantics

# Text between day and `10` in the upper bound of hour 9, in the two existing writers.
SESSION_NINE_JOINT = "0"
LOG_NINE_JOINT = "-0"


def with_hour(
    frame: DataFrame,
    time: str,
    semantics: str = INTENDED,
    hours: DataFrame | None = None,
    nine_joint: str = LOG_NINE_JOINT,
) -> DataFrame:
    """Add `hour` to rows that carry `day` and a log time.

    Intended: the hour of the time. Reference: one row for each hour of `hours`
    (columns day, hour as a number) whose inclusive bounds hold the time. Both ends
    being inclusive, a row at exactly HH:00:00 also lands in the hour before; the
    malformed bound of hour 9 sorts after all times of the day or before them,
    depending on the writer. A row can therefore only belong to its own hour, the
    hour before, or hour 9. These few candidates are built from the row itself and
    checked against their bounds, so the range join becomes an equi-join. `hours` has
    at most 24 rows per calendar day, which bounds what is broadcast.
    """
    if not check_semantics(semantics):
        return frame.withColumn("hour", hour_of(F.col(time)))
    if hours is None:
        raise ValueError("reference semantics needs the hours present in the source")
    own = hour_number(F.col(time))
    candidates = F.array_distinct(F.array(own, F.greatest(own - 1, F.lit(0)), F.lit(9)))
    spread = frame.withColumn("_hour", F.explode(candidates))
    held = spread.where(_holds(F.col(time), F.col("day"), F.col("_hour"), nine_joint))
    present = (hours.where(F.col("hour").between(0, 23))
               .select("day", F.col("hour").alias("_hour")).distinct())
    return (held.join(F.broadcast(present), ["day", "_hour"], "left_semi")
            .select(*frame.columns, F.lpad(F.col("_hour").cast("string"), 2, "0").alias("hour")))


def _holds(time: Column, day: Column, hour: Column, nine_joint: str) -> Column:
    return time.between(hour_lower(day, hour), hour_upper(day, hour, nine_joint))


def source_hours(source: DataFrame) -> DataFrame:
    """Hours present per day, from rows. With a table, prefer its partition list."""
    return source.select("day", F.col("hour").cast("int").alias("hour")).distinct()
