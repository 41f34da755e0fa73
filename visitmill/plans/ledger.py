"""A ledger of raw files, so that loading a folder again adds nothing twice.

The ledger holds a row for each raw file: its size and time, and the hours of the source
table that its rows went to. A file that it names as loaded is skipped while size and time
are the same. The rows of a file that changed, or that a cut-off run may have left behind,
are replaced: the hours concerned are made anew from all files that have rows in them. Files
that are gone, or empty now (which Spark's readers don't list), keep the rows they had.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmill.schema import PARTITION_COLUMNS
from visitmill.sinks.staging import stage
from visitmill.sinks.tables import create_table, insert_partitions, replace_slices

#: `path` names a file as rows do, `location` as readers do; `hours` are "day/hour".
SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("location", T.StringType()),
    T.StructField("bytes", T.LongType()), T.StructField("modified", T.TimestampType()),
    T.StructField("loaded", T.BooleanType()), T.StructField("hours", T.ArrayType(T.StringType()))])
# In place of a path: a day that was loaded as a whole, which no file owns.
WHOLE_DAY = "whole day "
#: The column of a file's name beside its lines and rows.
FILE_COLUMN = "_file"

Clean = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Loaded:
    """Locations of the files that a run loaded for the first time, and of those it replaced."""

    new: tuple[str, ...]
    replaced: tuple[str, ...]


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, location, bytes, modified) of the files of a folder or glob; none is opened."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("path").alias("location"),
        F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def load_files(
    spark: SparkSession, path: str, table: str, clean: Clean, compact: bool = True
) -> Loaded:
    """Bring the rows of the files of a folder or glob into the source table, each file once.

    `clean` takes lines (value and the file's name) and returns rows that keep the name.
    New files are appended. What comes to the driver are the files to load, with their
    hours; Spark's own listing of the folder is there too.
    """
    ledger = ledger_table(spark, table)
    known = spark.table(ledger).select("path", *[F.col(c).alias(f"old_{c}") for c in SCHEMA.names[2:]])
    todo = raw_files(spark, path).join(known, "path", "left").where(
        "old_loaded is null or not old_loaded or bytes <> old_bytes or modified <> old_modified").collect()
    if not todo:
        return Loaded((), ())
    changed, new = ([r for r in todo if (r["old_loaded"] is None) == first] for first in (False, True))
    if changed:
        # Refused before anything is marked or written.
        _check_owned(spark, ledger, {h for r in changed for h in r["old_hours"]})
    _note(spark, ledger, todo, False, {r["path"]: r["old_hours"] or [] for r in todo})
    hours: dict[str, list[str]] = {}
    if changed:
        hours |= _replace(spark, ledger, table, changed, clean, compact)
    if new:
        seen = Observation()
        rows = clean(_lines(spark, new)).observe(seen, F.collect_set(F.struct(FILE_COLUMN, _hour())).alias("hours"))
        insert_partitions(rows.drop(FILE_COLUMN), table, compact=compact)
        for file, hour in seen.get["hours"] or []:
            hours.setdefault(file, []).append(hour)
    _note(spark, ledger, todo, True, hours)
    return Loaded(tuple(r["location"] for r in new), tuple(r["location"] for r in changed))


def ledger_table(spark: SparkSession, table: str) -> str:
    name = f"{table}_files"
    create_table(spark, name, SCHEMA, partitions=())
    return name


def own_day(spark: SparkSession, table: str, day: str) -> None:
    """Note that a day was replaced as a whole, so no file owns rows of it any longer."""
    ledger = ledger_table(spark, table)
    kept = spark.table(ledger).where(F.col("path") != WHOLE_DAY + day).withColumn(
        "hours", F.filter("hours", lambda h: ~h.startswith(f"{day}/")))
    whole = spark.createDataFrame([(WHOLE_DAY + day, None, None, None, True, [])], SCHEMA)
    _write(ledger, kept.unionByName(whole))


def _hour() -> F.Column:
    return F.concat_ws("/", *PARTITION_COLUMNS).alias("hour")


def _lines(spark: SparkSession, files: list[Row]) -> DataFrame:
    return spark.read.text([r["location"] for r in files]).select(
        "value", F.col("_metadata.file_path").alias(FILE_COLUMN))


def _replace(
    spark: SparkSession, ledger: str, table: str, changed: list[Row], clean: Clean, compact: bool
) -> dict[str, list[str]]:
    """Make the hours of changed files anew, and return the hours that each file has now."""
    rows = stage(clean(_lines(spark, changed)))
    now = {r[FILE_COLUMN]: r["hours"] for r in rows.groupBy(FILE_COLUMN).agg(F.collect_set(_hour()).alias("hours")).collect()}
    concerned = {h for held in (now.values(), (r["old_hours"] for r in changed)) for hours in held for h in hours}
    if not concerned:
        return now
    _check_owned(spark, ledger, concerned)
    others = spark.table(ledger).where("loaded and location is not null").where(
        F.arrays_overlap("hours", F.array(*[F.lit(h) for h in sorted(concerned)]))).select("location").collect()
    if others:
        rest = clean(_lines(spark, others)).where(F.concat_ws("/", *PARTITION_COLUMNS).isin(sorted(concerned)))
        rows = rows.unionByName(rest)
    wanted = {tuple(h.split("/")) for h in concerned}
    replace_slices(rows.drop(FILE_COLUMN), table, PARTITION_COLUMNS, wanted, compact=compact)
    return now


def _check_owned(spark: SparkSession, ledger: str, hours: set[str]) -> None:
    days = sorted({h.split("/")[0] for h in hours})
    whole = spark.table(ledger).where(F.col("path").isin([WHOLE_DAY + d for d in days])).select("path").collect()
    if whole:
        names = ", ".join(sorted(r["path"].removeprefix(WHOLE_DAY) for r in whole))
        raise ValueError(f"a changed file has rows of {names}, which was loaded as a whole day: load that day again")


def _note(
    spark: SparkSession, ledger: str, files: list[Row], loaded: bool, hours: dict[str, list[str]]
) -> None:
    """Give files their new rows in the ledger."""
    fresh = spark.createDataFrame(
        [(r["path"], r["location"], r["bytes"], r["modified"], loaded, sorted(hours.get(r["path"], [])))
         for r in files], SCHEMA)
    kept = spark.table(ledger).join(F.broadcast(fresh.select("path")), "path", "left_anti")
    _write(ledger, kept.unionByName(fresh))


def _write(ledger: str, rows: DataFrame) -> None:
    # Staged, because a table cannot be read and overwritten in one query.
    held = stage(rows.select(*SCHEMA.names))
    held.coalesce(1).write.insertInto(ledger, overwrite=True)
