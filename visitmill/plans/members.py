"""Known members per key combination, so that all-time counts need no full history scan.

The table holds (keys, id) with a bitmap of the days of a month on which the pair was seen,
partitioned by month: bit d stands for day d. A day that runs again clears its bit in the
one month and sets it anew, and a bound on the history is a mask. So the table grows with
the members and months, not with the log, and no day needs any other day of the log. A
second table names the days that it covers.
"""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmill.functions.text import literal
from visitmill.operators.metrics import (
    EVENT_COLUMN, METRICS, VISITOR, identity_facts, roll_up, set_keys,
)
from visitmill.schema import MISSING, strings
from visitmill.sinks.staging import stage
from visitmill.sinks.tables import (
    create_table, drop_partitions, insert_partitions, recorded_days, replace_slices,
)

_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def facts_with_known_members(
    spark: SparkSession, history: str, source: str, table: str, day: str, as_of: str | None = None
) -> DataFrame:
    """Identity facts of a day of the `history` table plus every known member.

    The day's members are recorded first, whether or not it was recorded before. Days of the
    history that the members table lacks are read once, and days that the history lost are
    cleared. So the result is that of a scan of all days, as each was when it last ran,
    whichever days were run in which order.
    """
    frame = spark.table(history)
    keys = set_keys([n for n, m in METRICS.items() if m.source == source])
    create_table(spark, table, T.StructType([
        *strings(*keys, "id"), T.StructField("days", T.LongType()), *strings("month")]), ("month",))
    covered = f"{table}_days"
    create_table(spark, covered, T.StructType([
        T.StructField("run", T.BooleanType()), *strings("day")]), ("day",))

    today = stage(identity_facts(frame.where(f"day = {literal(day)}"), keys, day,
                                 EVENT_COLUMN[source], (VISITOR,), as_of))
    there = {d for d in recorded_days(spark, history) if _DAY.fullmatch(d)}
    done = recorded_days(spark, covered)
    lacking, lost = there - done - {day}, done - there - {day}
    seen = today.where("is_member").select(*keys, "id", F.lit(day).alias("day"))
    if lacking:
        older = frame.where(F.col("day").isin(sorted(lacking)) & (F.col("customerId") != MISSING))
        seen = seen.unionByName(older.select(*keys, F.col("customerId").alias("id"), "day"))
    _record(spark, seen, table, covered, keys, {day} | lacking, lost)

    # Of the rows of the day itself the facts know more; the pairs meet in the roll-up.
    members = known_members(spark, table, as_of).selectExpr(
        *keys, "true as is_member", "id", "false as on_day", "false as is_new",
        "true as in_history")
    return stage(roll_up(today.unionByName(members), keys))


def known_members(spark: SparkSession, table: str, as_of: str | None = None) -> DataFrame:
    """(keys, id, days, month) of the members seen up to a day, or ever."""
    rows = spark.table(table)
    if as_of is None:
        return rows
    month, last = literal(as_of[:7]), (2 << int(as_of[8:10])) - 1
    return rows.where(f"month < {month} or (month = {month} and days & {last}L <> 0)")


def _record(
    spark: SparkSession, seen: DataFrame, table: str, covered: str, keys: tuple[str, ...],
    days: Collection[str], lost: Collection[str],
) -> None:
    """Clear the bits of some days and set those of the members `seen` (keys, id, day) on them.

    Only the months of the days are read and written. The days don't count as covered in
    between, so if this fails the next run records them again.
    """
    drop_partitions(spark, covered, [{"day": d} for d in sorted({*days, *lost})])
    cleared: dict[str, int] = {}
    for d in (*days, *lost):
        cleared[d[:7]] = cleared.get(d[:7], 0) | 1 << int(d[8:10])
    mask = " ".join(f"when {literal(m)} then {bits}L" for m, bits in cleared.items())
    kept = spark.table(table).where(F.col("month").isin(sorted(cleared))).selectExpr(
        *keys, "id", f"days & ~(case month {mask} end) as days", "month")
    new = seen.selectExpr(
        *keys, "id", "shiftleft(1L, int(substr(day, 9, 2))) as days", "substr(day, 1, 7) as month")
    merged = (
        kept.unionByName(new).groupBy(*keys, "id", "month").agg(F.bit_or("days").alias("days"))
        .where("days <> 0"))
    # Staged, because a table cannot be read and overwritten in one query.
    replace_slices(stage(merged), table, ("month",), {(m,) for m in cleared})
    rows = spark.createDataFrame([(True, d) for d in sorted(days)], "run boolean, day string")
    insert_partitions(rows.coalesce(1), covered, overwrite=True, compact=False)
