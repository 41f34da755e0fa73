"""Partitioned catalog tables."""

from __future__ import annotations

from collections.abc import Collection, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmill.functions.text import literal
from visitmill.schema import PARTITION_COLUMNS
from visitmill.sinks.staging import stage

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def create_table(
    spark: SparkSession, table: str, schema: T.StructType,
    partitions: tuple[str, ...] = PARTITION_COLUMNS, location: str | None = None,
) -> None:
    """Create a parquet table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    ddl = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
    if partitions:
        ddl += f" PARTITIONED BY ({', '.join(partitions)})"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def _compacted(rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rebalance before a partitioned write.

    One shuffle, after which files have the advisory size instead of being one small
    file per task and hour, and an hour with most of the rows is split over tasks.
    """
    return rows.hint("rebalance", *[F.col(c) for c in partitions])


def insert_partitions(
    frame: DataFrame, table: str, overwrite: bool = False, compact: bool = True
) -> None:
    """Insert rows into the (day, hour) partitions of a table, matching columns by name.

    Appends; with `overwrite` each partition present in the frame is replaced.
    """
    spark = frame.sparkSession
    rows = frame.select(*spark.table(table).columns)
    if compact:
        rows = _compacted(rows, PARTITION_COLUMNS)
    with _overwrite_mode(spark, "dynamic"):
        rows.write.insertInto(table, overwrite=overwrite)


def replace_day(
    frame: DataFrame, table: str, day: str, partitions: tuple[str, ...] = PARTITION_COLUMNS,
    compact: bool = True,
) -> None:
    """Make a frame the whole content of one day, so that a job may run again."""
    replace_slices(frame, table, ("day",), {(day,)}, tuple(c for c in partitions if c != "day"), compact)


def replace_slices(
    frame: DataFrame, table: str, columns: tuple[str, ...], wanted: Collection[tuple[str, ...]],
    inner: tuple[str, ...] = (), compact: bool = True,
) -> None:
    """Make a frame the whole content of the partitions with the wanted values of some columns.

    New partitions take the place of the old ones when the whole write commits; only then
    are those dropped that the frame no longer has. So a run that fails leaves the old
    rows, and one that is cut off before the drops is mended by the next. A row with other
    values stops the write. `inner` are the partition columns besides `columns`. The
    session's overwrite mode doesn't matter.
    """
    spark, wanted = frame.sparkSession, set(wanted)
    before = [p for p in _partitions(spark, table) if tuple(p[c] for c in columns) in wanted]
    names = sorted("/".join(values) for values in wanted)
    shown = f"{' and '.join(columns)} in the output for {', '.join(names[:5])}"
    belongs = F.concat_ws("/", *columns).isin(names)
    rows = frame.withColumn(columns[0], F.when(belongs, F.col(columns[0])).otherwise(
        F.raise_error(F.lit(f"row of another {shown}")))).select(*spark.table(table).columns)
    spread = [*(columns if len(wanted) > 1 else ()), *inner]
    if compact and spread:
        rows = _compacted(rows, spread)
    # At most the partitions of these values, gathered while the rows are written.
    written = Observation()
    rows = rows.observe(written, F.collect_set(F.struct(*columns, *inner)).alias("partitions"))
    with _overwrite_mode(spark, "dynamic"):
        rows.write.insertInto(table, overwrite=True)
    now = {tuple(p) for p in written.get["partitions"]}
    drop_partitions(spark, table, [p for p in before if tuple(p[c] for c in (*columns, *inner)) not in now])


def drop_partitions(spark: SparkSession, table: str, partitions: Collection[dict[str, str]]) -> None:
    """Drop partitions, given by the values of their columns."""
    for values in partitions:
        spec = ", ".join(f"{c} = {literal(v)}" for c, v in values.items())
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Partition values from the catalog."""
    return [dict(part.split("=", 1) for part in row[0].split("/"))
            for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def recorded_days(spark: SparkSession, table: str) -> set[str]:
    """The days that a table has partitions of, from the catalog."""
    return {p["day"] for p in _partitions(spark, table)}


REJECTS = T.StructType([T.StructField("line", T.StringType()), T.StructField("file", T.StringType())])


def load_text_table(
    spark: SparkSession, path: str, table: str, schema: T.StructType, sep: str = ",",
    rejects: str | None = None,
) -> tuple[int, int]:
    """Create an unpartitioned table and append a delimited text file to it.

    A line with another number of cells, or with a cell that its column's type can't hold,
    goes to the table `rejects` (line, file), by default `{table}_rejects`. Empty lines are
    left out. Returns how many rows were appended and how many lines rejected; the text is
    read once.
    """
    rejects = rejects or f"{table}_rejects"
    create_table(spark, table, schema, partitions=())
    create_table(spark, rejects, REJECTS, partitions=())
    bad = "_rejected"
    typed = T.StructType([*schema, T.StructField(bad, T.StringType())])
    rows = spark.read.csv(path, schema=typed, sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord=bad)
    counted = Observation()
    # Staged, since the two tables are written one after the other.
    held = stage(rows.select("*", F.col("_metadata.file_path").alias("_file")).observe(
        counted, F.count(F.lit(1)).alias("lines"), F.count(bad).alias("rejected")))
    held.where(F.col(bad).isNull()).select(*schema.names).write.insertInto(table)
    held.where(F.col(bad).isNotNull()).select(F.col(bad), "_file").write.insertInto(rejects)
    rejected = counted.get["rejected"]
    return counted.get["lines"] - rejected, rejected


def write_lines(lines: DataFrame, path: str) -> None:
    """Text export of a one-column frame; an existing export is replaced."""
    lines.write.mode("overwrite").text(path)
