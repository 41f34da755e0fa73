"""The five daily jobs, as functions over tables and files.

1. clean: raw lines to the source table
2. channel: source table to the platform table
3. region: platform table to the area table
4. session: source table to the session table
5. metrics: all three to fifteen small result tables

Jobs 2 to 4 replace the day they are given, and so does job 1 with a day, so a day can be
run again; without, job 1 loads each file once. Intermediate files go when a job ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmill.operators.channel import platform_table
from visitmill.operators.clean import clean_logs, cleaned_lines
from visitmill.operators.hours import SESSION_NINE_JOINT, with_hour
from visitmill.operators.lookup import BROADCAST_BYTES, measure
from visitmill.operators.metrics import METRICS, available, metric_set, metric_set_from_facts
from visitmill.operators.region import area_table, region_index
from visitmill.operators.sessions import session_summary
from visitmill.plans.ledger import FILE_COLUMN, load_files, own_day
from visitmill.plans.members import facts_with_known_members
from visitmill.schema import (
    AREA_SCHEMA, INTENDED, PLATFORM_SCHEMA, SESSION_SCHEMA, SESSION_SCHEMA_REFERENCE,
    SOURCE_SCHEMA, check_semantics,
)
from visitmill.sinks.jdbc import append_jdbc
from visitmill.sinks.staging import stage, staged_files
from visitmill.sinks.tables import create_table, insert_partitions, replace_day, write_lines
from visitmill.sources.logs import read_lines
from visitmill.sources.rules import read_channel_rules, read_ip_rules
from visitmill.sources.tables import partition_hours, read_day, read_history

# The two area tables by app channel are not produced by default, as before.
DEFAULT_METRICS = tuple(n for n in METRICS if not n.endswith("_area_channel"))


def default_metrics(semantics: str = INTENDED) -> tuple[str, ...]:
    """What a reading has of the default metrics."""
    found = available(semantics)
    return tuple(n for n in DEFAULT_METRICS if n in found)


Sink = Callable[[DataFrame, str], None]


@dataclass(frozen=True)
class Tables:
    """Names of the tables that the jobs share."""

    source: str = "visit_source"
    platform: str = "visit_platform"
    area: str = "visit_area"
    session: str = "visit_session"


def create_tables(spark: SparkSession, tables: Tables, semantics: str = INTENDED) -> None:
    session = SESSION_SCHEMA_REFERENCE if check_semantics(semantics) else SESSION_SCHEMA
    for name, schema in ((tables.source, SOURCE_SCHEMA), (tables.platform, PLATFORM_SCHEMA),
                         (tables.area, AREA_SCHEMA), (tables.session, session)):
        create_table(spark, name, schema)


def clean_job(
    spark: SparkSession, path: str, tables: Tables = Tables(), semantics: str = INTENDED,
    overwrite: bool = False, export: str | None = None, compact: bool = True,
    day: str | None = None, **options,
) -> None:
    """Clean raw files into the source table, and optionally export the lines as text.

    Without a day each file is loaded once: a ledger beside the source table tells the files
    that it holds, a file that changed has its rows replaced, and a run over the same files
    adds nothing. With a `day`, the path names all files that may hold rows of that day, and
    those rows become the whole day. `overwrite` is for input that holds whole hours: they
    replace the table's. The reference reading appends whatever it is given.

    `compact=False` saves the shuffle before the write when the raw files are already in
    time order, so that each split holds few hours. An export holds the rows of the day, of
    the overwritten hours, or of the files that this run loaded. `options` go to `clean_logs`.
    """
    def cleaned(lines: DataFrame, *keep: str) -> DataFrame:
        return clean_logs(lines, semantics, keep=keep, **options)

    with staged_files(spark):
        if day is not None:
            rows = cleaned(read_lines(spark, path))
            own_day(spark, tables.source, day)
            replace_day(rows.where(F.col("day") == day), tables.source, day, compact=compact)
            rows = read_day(spark, tables.source, day)
        elif overwrite or check_semantics(semantics):
            rows = cleaned(read_lines(spark, path))
            rows = stage(rows) if export else rows
            insert_partitions(rows, tables.source, overwrite, compact)
        else:
            loaded = load_files(spark, path, tables.source, lambda lines: cleaned(lines, FILE_COLUMN), compact)
            files = [*loaded.new, *loaded.replaced]
            rows = cleaned(read_lines(spark, files)) if export and files else None
        if export and rows is not None:
            write_lines(cleaned_lines(rows), export)


def _write_day(
    frame: DataFrame, table: str, day: str, semantics: str, compact: bool = False
) -> None:
    """Write a day of output.

    Rows that come straight from a table partitioned by hour need no rebalancing: a scan
    task holds one hour, or a few small ones. After a shuffled lookup they do.
    """
    if check_semantics(semantics):
        insert_partitions(frame, table, compact=compact)
    else:
        replace_day(frame, table, day, compact=compact)


def channel_job(
    spark: SparkSession, day: str, rules_path: str, tables: Tables = Tables(),
    semantics: str = INTENDED, on_bad_rule: str = "fail", broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    rules = read_channel_rules(spark, rules_path, on_bad_rule)
    rows = platform_table(read_day(spark, tables.source, day), rules, broadcast_bytes)
    fits = measure(rules.drop("line_no")).fits(broadcast_bytes)
    with staged_files(spark):
        _write_day(rows, tables.platform, day, semantics, compact=not fits)


def region_job(
    spark: SparkSession, day: str, rules_path: str, tables: Tables = Tables(),
    semantics: str = INTENDED, on_bad_rule: str = "fail", broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    index = region_index(read_ip_rules(spark, rules_path, on_bad_rule), broadcast_bytes)
    rows = area_table(read_day(spark, tables.platform, day), index, semantics)
    with staged_files(spark):
        _write_day(rows, tables.area, day, semantics, compact=not index.fits)


def session_job(
    spark: SparkSession, day: str, tables: Tables = Tables(), semantics: str = INTENDED
) -> None:
    sessions = session_summary(read_day(spark, tables.source, day), semantics)
    placed = with_hour(sessions, "startTime", semantics,
                       partition_hours(spark, tables.source, day), SESSION_NINE_JOINT)
    _write_day(placed, tables.session, day, semantics, compact=True)


def metrics_job(
    spark: SparkSession, day: str, sink: Sink, tables: Tables = Tables(),
    semantics: str = INTENDED, as_of: str | None = None,
    metrics: Iterable[str] | None = None, incremental: bool = True,
) -> None:
    """Compute the metric tables of a day and hand each to the sink with its name.

    Only the day itself is scanned, once for all metrics of an input table. All-time
    members come from a table of known members, in which each run records its day, and days
    that it lacks. `incremental=False` scans the history instead.
    """
    wanted = set(default_metrics(semantics) if metrics is None else metrics)
    unknown = wanted - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {sorted(unknown)}")
    for source in ("source", "area", "platform"):
        names = [n for n in METRICS if n in wanted and METRICS[n].source == source]
        if not names:
            continue
        table = getattr(tables, source)
        with staged_files(spark):
            if incremental:
                facts = facts_with_known_members(
                    spark, table, source, f"{table}_member_months", day, as_of)
                found = metric_set_from_facts(facts, names, day, semantics)
            else:
                found = metric_set(
                    read_history(spark, table), source, day, semantics, as_of, names)
            for name, frame in found.items():
                sink(frame, METRICS[name].table)


def jdbc_sink(url: str, properties: dict[str, str], prefix: str = "") -> Sink:
    """Append to database tables."""
    return lambda frame, table: append_jdbc(frame, url, prefix + table, properties)


def table_sink(spark: SparkSession, day: str, prefix: str = "") -> Sink:
    """Replace the day's rows in catalog tables that are partitioned by day."""
    def write(frame: DataFrame, table: str) -> None:
        inner = T.StructType([f for f in frame.schema if f.name != "day"])
        schema = T.StructType([*inner, T.StructField("day", T.StringType())])
        create_table(spark, prefix + table, schema, ("day",))
        replace_day(frame, prefix + table, day, ("day",))
    return write
