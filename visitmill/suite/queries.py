"""The registered queries: each operator over data derived from the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmill.operators import clean, keyvalue, metrics, region, sessions
from visitmill.operators.channel import platform_table
from visitmill.operators.hours import (
    LOG_NINE_JOINT, SESSION_NINE_JOINT, source_hours, with_hour,
)
from visitmill.plans import jobs
from visitmill.plans.members import facts_with_known_members
from visitmill.schema import INTENDED, REFERENCE, SOURCE_SCHEMA
from visitmill.sinks.staging import shared_folder, stage
from visitmill.sinks.tables import create_table, insert_partitions, load_text_table, replace_day
from visitmill.sources.logs import read_json, read_lines
from visitmill.sources.rules import read_channel_rules, read_ip_rules
from visitmill.sources.tables import partition_hours, read_day, read_history
from visitmill.suite import derived
from visitmill.suite.derived import DAY

Query = Callable[[SparkSession, str], DataFrame]


def source(spark: SparkSession, folder: str, semantics: str = INTENDED) -> DataFrame:
    return clean.clean_logs(derived.raw_lines(spark, folder), semantics, derived.TEST_URLS)


def platform(spark: SparkSession, folder: str, semantics: str = INTENDED) -> DataFrame:
    return platform_table(source(spark, folder, semantics), derived.channel_rules(spark))


def area(spark: SparkSession, folder: str, semantics: str = INTENDED) -> DataFrame:
    index = region.region_index(derived.ip_rules(spark))
    return region.area_table(platform(spark, folder, semantics), index, semantics)


INPUT = {"source": source, "platform": platform, "area": area}


def _metric(name: str, semantics: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        frame = INPUT[metrics.METRICS[name].source](spark, folder, semantics)
        return metrics.metric_table(frame, name, DAY, semantics)
    return query


def _set_in_one_pass(table: str) -> Query:
    """All metric tables of an input as one long result, from a single scan."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables = metrics.metric_set(INPUT[table](spark, folder), table, DAY)
        long = [
            frame.select(
                F.lit(name).alias("metric"),
                *[F.col(out).alias(f"key{i}") if out else F.lit(None).cast("string").alias(f"key{i}")
                  for i, out in enumerate(_two_keys(name), 1)],
                "uv_act", "uv_new",
                (F.col("uv_all") if "uv_all" in frame.columns else F.lit(None).cast("bigint"))
                .alias("uv_all"))
            for name, frame in tables.items() if "uv_act" in frame.columns
        ]
        result = long[0]
        for frame in long[1:]:
            result = result.unionByName(frame)
        return result
    return query


def _grouping_sets(table: str) -> Query:
    """The same from one aggregate with grouping sets."""
    return lambda spark, folder: metrics.metric_sets_at_once(INPUT[table](spark, folder), table, DAY)


def _two_keys(name: str) -> tuple[str | None, str | None]:
    outs = [out for _, out in metrics.METRICS[name].keys]
    return (outs + [None, None])[0], (outs + [None, None])[1]


def _session_hours(semantics: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        logs, hours = _with_hours(spark, folder, semantics)
        return with_hour(sessions.session_summary(logs, semantics), "startTime", semantics,
                         hours, SESSION_NINE_JOINT)
    return query


def _log_hours(semantics: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        logs, hours = _with_hours(spark, folder, semantics)
        return with_hour(logs.select("reqSerial", "serverTime", "day"), "serverTime", semantics,
                         hours, LOG_NINE_JOINT)
    return query


def _with_hours(spark: SparkSession, folder: str, semantics: str) -> tuple[DataFrame, DataFrame | None]:
    """Clean rows and, where the reading needs them, the hours that they are in; cleaned once.

    The session job has the hours from the partitions of its table.
    """
    logs = source(spark, folder, semantics)
    if semantics == INTENDED:
        return logs, None
    logs = stage(logs)
    return logs, source_hours(logs)


def _new_table(spark: SparkSession, name: str | None = None) -> str:
    name = name or f"visitmill_source_{uuid.uuid4().hex}"
    create_table(spark, name, SOURCE_SCHEMA, location=f"{shared_folder(spark)}/visitmill/{name}")
    return name


def _source_table(spark: SparkSession, folder: str) -> str:
    """Clean logs in a partitioned table of their own in the shared folder."""
    name = _new_table(spark)
    insert_partitions(source(spark, folder), name)
    return name


def _table_day(spark: SparkSession, folder: str) -> DataFrame:
    return read_day(spark, _source_table(spark, folder), DAY)


def _table_history(spark: SparkSession, folder: str) -> DataFrame:
    return read_history(spark, _source_table(spark, folder)).groupBy("day").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("sessionId").alias("sessions"))


def _table_hours(spark: SparkSession, folder: str) -> DataFrame:
    return partition_hours(spark, _source_table(spark, folder))


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return region.enriched_logs(source(spark, folder), derived.channel_rules(spark),
                                region.region_index(derived.ip_rules(spark)))


def _rerun(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per day of a table of which one day was replaced twice by itself."""
    name = _new_table(spark)
    rows = source(spark, folder)
    insert_partitions(rows, name)
    for _ in range(2):
        replace_day(rows.where(F.col("day") == DAY), name, DAY)
    return read_history(spark, name).groupBy("day").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("sessionId").alias("sessions"))


def _write_files(lines: DataFrame, folder: str) -> None:
    """Write lines as text files whose names are the same each time."""
    spark, parts = lines.sparkSession, f"{folder}-{uuid.uuid4().hex}"
    lines.write.text(parts)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(folder))
    for status in system.listStatus(path(parts)):
        name = status.getPath().getName()
        if name.startswith("part-"):
            target = path(f"{folder}/{name[:10]}")
            system.delete(target, False)
            system.rename(status.getPath(), target)


def _clean_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files loaded again and again, of which some changed and some came later.

    At first a third of the lines is doubled and another third isn't there.
    """
    at = f"{shared_folder(spark)}/visitmill/{uuid.uuid4().hex}"
    # Four sets of files are written from the lines, which are made once.
    lines = stage(derived.raw_lines(spark, folder).selectExpr("value", "pmod(xxhash64(value), 3) as part"))
    for part in (0, 1):
        copies = "explode(array(value, value)) as value" if part else "value"
        _write_files(lines.where(f"part = {part}").selectExpr(copies), f"{at}/raw/{part}")
    tables = jobs.Tables(*[f"visitmill_{uuid.uuid4().hex}" for _ in range(4)])
    _new_table(spark, tables.source)
    for _ in range(2):
        jobs.clean_job(spark, f"{at}/raw/[012]", tables, test_urls=derived.TEST_URLS)
    for part in (1, 2):
        _write_files(lines.where(f"part = {part}").select("value"), f"{at}/raw/{part}")
    for _ in range(2):
        jobs.clean_job(spark, f"{at}/raw/[012]", tables, test_urls=derived.TEST_URLS)
    return read_history(spark, tables.source)


def _zones(spark: SparkSession, folder: str) -> DataFrame:
    lines = derived.zone_lines(spark, folder)
    return clean.clean_logs(lines, INTENDED, derived.TEST_URLS).select("reqSerial", "serverTime")


def _members_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.metric_table(source(spark, folder), "daily_members", DAY, as_of=derived.AS_OF)


def _members_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """All-time members from the members table, after a run of an earlier and of the day."""
    history = _source_table(spark, folder)
    members = f"visitmill_members_{uuid.uuid4().hex}"
    for day in (derived.AS_OF, DAY):
        facts = facts_with_known_members(spark, history, "source", members, day)
    return metrics.metric_from_facts(facts, "daily_members", DAY)


def _members_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """All-time members after an earlier day lost some of its rows and was run again."""
    history = _new_table(spark)
    rows = source(spark, folder)
    insert_partitions(rows, history)
    members = f"visitmill_members_{uuid.uuid4().hex}"
    for day in (DAY, derived.AS_OF):
        facts_with_known_members(spark, history, "source", members, day)
    left = rows.where(f"day = '{derived.AS_OF}' and right(reqSerial, 1) < '3'")
    replace_day(left, history, derived.AS_OF)
    for day in (derived.AS_OF, DAY):
        facts = facts_with_known_members(spark, history, "source", members, day)
    return metrics.metric_from_facts(facts, "daily_members", DAY)


def _from_files(spark: SparkSession, folder: str) -> DataFrame:
    """Both lookups over raw lines and rules that were written as text files and read back."""
    at = f"{shared_folder(spark)}/visitmill/{uuid.uuid4().hex}"
    derived.raw_lines(spark, folder).write.text(f"{at}/raw")
    rules = derived.channel_rules(spark).orderBy("line_no").coalesce(1)
    rules.select(F.concat_ws("\t", "channelFrom", "app_channel", "platform", "traffic")).write.text(f"{at}/channel")
    derived.ip_rules(spark).select(F.concat_ws(
        "|", F.lit("a"), F.lit("b"), "startNum", "endNum", F.lit("x"), F.lit("y"),
        "province", "city", "area", "operator")).write.text(f"{at}/ip")
    rows = clean.clean_logs(read_lines(spark, f"{at}/raw"), INTENDED, derived.TEST_URLS)
    return region.enriched_logs(rows, read_channel_rules(spark, f"{at}/channel"),
                                region.region_index(read_ip_rules(spark, f"{at}/ip")))


def _shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """Both lookups without a broadcast."""
    index = region.region_index(derived.ip_rules(spark), broadcast_bytes=0)
    return region.enriched_logs(source(spark, folder), derived.channel_rules(spark), index, broadcast_bytes=0)


def _shuffled_skew(spark: SparkSession, folder: str) -> DataFrame:
    """Both lookups without a broadcast, with a third of the rows on one address and one code."""
    index = region.region_index(derived.ip_rules(spark), broadcast_bytes=0)
    rows = derived.skewed(source(spark, folder))
    return region.enriched_logs(rows, derived.channel_rules(spark), index, broadcast_bytes=0)


def _lenient(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_logs(derived.impossible_lines(spark, folder), REFERENCE, derived.TEST_URLS)


def _text_table(spark: SparkSession, folder: str) -> DataFrame:
    """A typed table loaded from text, together with the lines that didn't fit."""
    at, name = f"{shared_folder(spark)}/visitmill/{uuid.uuid4().hex}", f"visitmill_people_{uuid.uuid4().hex}"
    derived.people_lines(spark, folder).write.text(at)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("day", T.DateType())])
    load_text_table(spark, at, name, schema)
    return spark.table(name).unionByName(spark.table(f"{name}_rejects").select("line"), allowMissingColumns=True)


def _json_scan(spark: SparkSession, folder: str) -> DataFrame:
    """JSON files with two sets of fields and broken lines, read with an inferred schema."""
    at = f"{shared_folder(spark)}/visitmill/{uuid.uuid4().hex}"
    for newer in (False, True):
        derived.json_lines(spark, folder, newer).write.text(f"{at}/{int(newer)}")
    return read_json(spark, f"{at}/*", bad_line="bad_line").select(
        "id", "kind", "user", "size", F.col("at.day").alias("day"), "bad_line")


def registered() -> dict[str, Query]:
    found: dict[str, Query] = {
        "clean_logs": source,
        "clean_logs_ref": lambda s, d: source(s, d, REFERENCE),
        "rejected_by_reason": lambda s, d: clean.rejected_by_reason(derived.raw_lines(s, d), INTENDED, derived.TEST_URLS),
        "rejected_by_reason_ref":
            lambda s, d: clean.rejected_by_reason(derived.raw_lines(s, d), REFERENCE, derived.TEST_URLS),
        "cleaned_lines": lambda s, d: clean.cleaned_lines(source(s, d)),
        "hourly_row_counts": lambda s, d: clean.hourly_row_counts(source(s, d)),
        "distinct_hours": lambda s, d: clean.distinct_hours(source(s, d)),
        "channel_enriched": platform,
        "ip_enriched": area,
        "ip_enriched_ref": lambda s, d: area(s, d, REFERENCE),
        "channel_ip_enriched": _enriched,
        "session_summary": lambda s, d: sessions.session_summary(source(s, d)),
        "session_summary_ref":
            lambda s, d: sessions.session_summary(source(s, d, REFERENCE), REFERENCE),
        "session_hours": _session_hours(INTENDED),
        "session_hours_ref": _session_hours(REFERENCE),
        "log_hours": _log_hours(INTENDED),
        "log_hours_ref": _log_hours(REFERENCE),
        "members_by_region_unfiltered":
            lambda s, d: metrics.members_by_region_unfiltered(area(s, d)),
        "province_counts": lambda s, d: region.region_counts(area(s, d)),
        "json_key_values":
            lambda s, d: keyvalue.key_values(derived.json_objects(s, d), "json", "report"),
        "json_report_record":
            lambda s, d: keyvalue.key_value_record(derived.json_objects(s, d), "json", "report"),
        "rejected_by_reason_bad_time": lambda s, d: clean.rejected_by_reason(
            derived.bad_time_lines(s, d), INTENDED, derived.TEST_URLS),
        "clean_logs_zones": _zones,
        "json_bad_objects": lambda s, d: keyvalue.bad_objects(
            derived.broken_json_objects(s, d), "json", "report").select("event_id"),
        "members_as_of": _members_as_of,
        "members_incremental": _members_incremental,
        "members_rerun": _members_rerun,
        "enriched_from_files": _from_files,
        "enriched_shuffled": _shuffled,
        "enriched_shuffled_skew": _shuffled_skew,
        "clean_logs_lenient_ref": _lenient,
        "text_table_loaded": _text_table,
        "json_scan": _json_scan,
        "area_grouping_sets": _grouping_sets("area"),
        "platform_grouping_sets": _grouping_sets("platform"),
        "clean_twice": _clean_twice,
        "table_rerun": _rerun,
        "table_day": _table_day,
        "table_history": _table_history,
        "table_hours": _table_hours,
        "area_metric_set": _set_in_one_pass("area"),
        "platform_metric_set": _set_in_one_pass("platform"),
    }
    for name, metric in metrics.METRICS.items():
        found[name] = _metric(name, INTENDED)
        if len(metric.keys) == 1:
            found[f"{name}_ref"] = _metric(name, REFERENCE)
    return found
