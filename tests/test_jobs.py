import uuid

import pytest
from log_help import lines, raw_line, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmill.operators.metrics import METRICS, metric_table
from visitmill.plans import jobs
from visitmill.schema import PLATFORM_COLUMNS, SOURCE_COLUMNS
from visitmill.sinks import jdbc
from visitmill.sinks.staging import shared_folder, stage
from visitmill.sinks.tables import (
    create_table, insert_partitions, load_text_table, replace_day, write_lines,
)
from visitmill.sources.tables import partition_hours, read_day, read_history, read_jdbc
from visitmill.suite import derived, queries

SMALL = "/root/testdata/sf0.001"
DAY = "2024-01-10"
SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("v", "day", "hour")])


def table(spark, schema=SCHEMA):
    name = f"t_{uuid.uuid4().hex}"
    create_table(spark, name, schema)
    return name


def values(spark, *found):
    return spark.createDataFrame(found, "v string, day string, hour string")


def test_append_overwrite_and_column_order(spark):
    name = table(spark)
    insert_partitions(values(spark, ("a", DAY, "09"), ("b", DAY, "10")), name)
    insert_partitions(values(spark, ("c", DAY, "10")).select("hour", "v", "day"), name)
    assert rows(spark.table(name)) == [("a", DAY, "09"), ("b", DAY, "10"), ("c", DAY, "10")]
    insert_partitions(values(spark, ("d", DAY, "10")), name, overwrite=True)
    assert rows(spark.table(name)) == [("a", DAY, "09"), ("d", DAY, "10")]


def test_replace_day_empties_vanished_hours_only(spark):
    name = table(spark)
    insert_partitions(values(spark, ("a", DAY, "09"), ("b", "2024-01-09", "10")), name)
    replace_day(values(spark, ("c", DAY, "11")), name, DAY)
    assert rows(spark.table(name)) == [("b", "2024-01-09", "10"), ("c", DAY, "11")]
    with pytest.raises(Exception, match="row of another day"):
        replace_day(values(spark, ("c", "2024-01-08", "11")), name, DAY)


@pytest.mark.parametrize("compact", [True, False])
def test_a_failed_run_leaves_the_old_rows(spark, compact):
    name = table(spark)
    old = [("a", DAY, "09"), ("b", DAY, "10")]
    insert_partitions(values(spark, *old), name)
    broken = values(spark, *[(str(i), DAY, f"{i % 24:02d}") for i in range(48)]).repartition(4).selectExpr(
        "if(v = '37', raise_error('lost'), v) as v", "day", "hour")
    for frame in (broken, values(spark, ("c", DAY, "09"), ("d", "2024-01-08", "09"))):
        with pytest.raises(Exception, match="lost|row of another day"):
            replace_day(frame, name, DAY, compact=compact)
        assert rows(spark.table(name)) == old
    replace_day(values(spark, ("c", DAY, "09")).where("false"), name, DAY, compact=compact)
    assert rows(spark.table(name)) == []


def test_jobs_leave_no_staged_files(spark, tmp_path, monkeypatch):
    from visitmill.sinks import staging

    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    with staging.staged_files(spark):
        assert stage(values(spark, ("a", DAY, "09"))).count() == 1
        assert list((tmp_path / "visitmill").iterdir())
    assert not list((tmp_path / "visitmill").iterdir())


def test_clean_job_of_a_day_runs_again(spark, tmp_path):
    times = [f"Wed Jan {d} 11:05:09 CST 2024" for d in ("10", "10", "11")]
    (tmp_path / "raw").write_text("".join(raw_line(reqSerial=f"r{i}", serverTime=t) + "\n"
                                          for i, t in enumerate(times)))
    names = jobs.Tables(*[f"c{uuid.uuid4().hex}_{n}" for n in ("source", "platform", "area", "session")])
    jobs.create_tables(spark, names)
    for _ in range(2):
        jobs.clean_job(spark, str(tmp_path / "raw"), names, day=DAY, export=str(tmp_path / "out"))
        assert rows(spark.table(names.source).select("reqSerial")) == [("r0",), ("r1",)]
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_pruned_scan_history_and_partition_hours(spark):
    name = table(spark)
    insert_partitions(values(spark, ("a", DAY, "09"), ("b", "2024-01-09", "10")), name)
    assert rows(read_day(spark, name, DAY)) == [("a", DAY, "09")]
    assert read_history(spark, name).count() == 2
    assert rows(partition_hours(spark, name, DAY)) == [(DAY, 9)]
    assert rows(partition_hours(spark, name)) == [("2024-01-09", 10), (DAY, 9)]


def test_load_text_and_write_lines(spark, tmp_path):
    (tmp_path / "people.txt").write_text("ann,31\nbob,42\n")
    name = f"people_{uuid.uuid4().hex}"
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])
    for times in (1, 2):
        assert load_text_table(spark, str(tmp_path / "people.txt"), name, schema) == (2, 0)
        assert spark.table(name).count() == 2 * times
    write_lines(lines(spark, "x\ty"), str(tmp_path / "out"))
    assert rows(spark.read.text(str(tmp_path / "out"))) == [("x\ty",)]


def test_lines_that_do_not_fit_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.txt").write_text('ann|31\n\nbob|old\n"c|d"|7\nonly\nfay|1|2\n|9\n')
    (tmp_path / "b.txt").write_text("gil|99999999999\nhal|-3\n")
    name, bad = f"people_{uuid.uuid4().hex}", f"bad_{uuid.uuid4().hex}"
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])
    assert load_text_table(spark, str(tmp_path / "*.txt"), name, schema, "|", bad) == (4, 4)
    assert rows(spark.table(name)) == sorted([("ann", 31), ("c|d", 7), (None, 9), ("hal", -3)], key=repr)
    got = spark.table(bad).selectExpr("line", "element_at(split(file, '/'), -1) as file")
    assert rows(got) == sorted([("bob|old", "a.txt"), ("only", "a.txt"), ("fay|1|2", "a.txt"),
                                ("gil|99999999999", "b.txt")], key=repr)


def test_stage_keeps_rows_in_the_shared_folder(spark):
    staged = stage(values(spark, ("a", DAY, "09")))
    assert rows(staged) == [("a", DAY, "09")]
    assert shared_folder(spark) in staged.inputFiles()[0]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Files for the jobs: lines of about three days, and both rule files."""
    folder = tmp_path_factory.mktemp("inputs")
    raw = derived.raw_lines(spark, SMALL).where("value rlike 'Jan (09|10|11) |^short'")
    raw.write.text(str(folder / "raw"))
    patch = pytest.MonkeyPatch()
    patch.setattr(derived, "raw_lines", lambda *_: spark.read.text(str(folder / "raw")))
    channel = derived.channel_rules(spark).orderBy("line_no").collect()
    (folder / "channel.txt").write_text("".join(
        f"{r.channelFrom}\t{r.app_channel}\t{r.platform}\t{r.traffic}\n" for r in channel))
    (folder / "ip.txt").write_text("".join(
        f"a|b|{r.startNum}|{r.endNum}|x|y|{r.province}|{r.city}|{r.area}|{r.operator}\n"
        for r in derived.ip_rules(spark).collect()))
    yield folder
    patch.undo()


def run(spark, inputs, semantics="intended"):
    prefix = f"j{uuid.uuid4().hex}_"
    names = jobs.Tables(*[prefix + n for n in ("source", "platform", "area", "session")])
    jobs.create_tables(spark, names, semantics)
    jobs.clean_job(spark, str(inputs / "raw"), names, semantics, export=str(inputs / prefix),
                   test_urls=derived.TEST_URLS)
    # One day is the daily job; the others are filled directly, to have a history.
    platform = queries.platform(spark, SMALL, semantics).where(f"day <> '{DAY}'")
    area = queries.area(spark, SMALL, semantics).where(f"day <> '{DAY}'")
    insert_partitions(platform, names.platform)
    insert_partitions(area, names.area)
    assert spark.table(names.source).select("day").distinct().count() >= 3
    return names, prefix


def daily(spark, inputs, names, semantics="intended"):
    jobs.channel_job(spark, DAY, str(inputs / "channel.txt"), names, semantics)
    jobs.region_job(spark, DAY, str(inputs / "ip.txt"), names, semantics)
    jobs.session_job(spark, DAY, names, semantics)


def test_five_jobs_and_running_them_again(spark, inputs):
    names, prefix = run(spark, inputs)
    source = queries.source(spark, SMALL)
    assert rows(spark.table(names.source)) == rows(source)
    assert spark.read.text(str(inputs / prefix)).count() == source.count()
    for _ in range(2):
        daily(spark, inputs, names)
        assert rows(spark.table(names.platform)) == rows(queries.platform(spark, SMALL))
        assert rows(spark.table(names.area)) == rows(queries.area(spark, SMALL))
        sessions = queries.registered()["session_hours"](spark, SMALL).where(f"day = '{DAY}'")
        assert rows(spark.table(names.session)) == rows(
            sessions.select(*spark.table(names.session).columns))
    sink = jobs.table_sink(spark, DAY, prefix)
    for _ in range(2):
        jobs.metrics_job(spark, DAY, sink, names)
    made = {t.name for t in spark.catalog.listTables() if t.name.startswith(prefix)}
    assert len([t for t in made if "_dw_" in t]) == 13
    for name in jobs.DEFAULT_METRICS:
        metric = METRICS[name]
        want = metric_table(queries.INPUT[metric.source](spark, SMALL), name, DAY)
        got = spark.table((prefix + metric.table).lower())
        assert rows(got.select(*want.columns)) == rows(want), name


def test_reference_jobs_append(spark, inputs):
    names, _ = run(spark, inputs, "reference")
    for times in (1, 2):
        daily(spark, inputs, names, "reference")
        want = queries.registered()["session_hours_ref"](spark, SMALL).where(f"day = '{DAY}'")
        got = spark.table(names.session)
        assert rows(got) == sorted(rows(want.select(*got.columns)) * times, key=repr)
    assert tuple(spark.table(names.platform).columns) == PLATFORM_COLUMNS
    assert tuple(spark.table(names.source).columns) == SOURCE_COLUMNS


def test_incremental_metrics_equal_a_full_scan(spark):
    prefix = f"i{uuid.uuid4().hex}_"
    names = jobs.Tables(*[prefix + n for n in ("source", "platform", "area", "session")])
    data = {"source": [], "area": [], "platform": []}
    days = ["2024-01-08", "2024-01-09", DAY]
    for i in range(300):
        data["source"].append((f"d{i % 7}", f"c{i % 23}" if i % 3 else "-1", days[i % 3 - i % 2],
                               "e_l" if i % 5 == 0 else "v", f"k{i % 4}" if i % 9 else None))
    frame = spark.createDataFrame(
        data["source"], "deviceNum string, customerId string, day string, event string, k string")
    for source in data:
        keys = {k for m in METRICS.values() if m.source == source for k in m.inputs}
        event = "eventName" if source == "source" else "eventId"
        rows_ = frame.selectExpr("deviceNum", "customerId", f"event as {event}",
                                 *[f"k as {k}" for k in sorted(keys)], "day")
        rows_.write.partitionBy("day").saveAsTable(getattr(names, source))

    def collect(day, **how):
        found = {}
        jobs.metrics_job(spark, day, lambda f, t: found.update({t: rows(f)}), names, **how)
        return found
    # The first run fills what lacks; then out of order, and one day twice.
    for day in (days[2], days[0], days[2], days[2]):
        assert collect(day) == collect(day, incremental=False)
    for as_of in days:
        for day in days[::2]:
            how = {"as_of": as_of, "semantics": "reference" if day == DAY else "intended"}
            assert collect(day, **how) == collect(day, incremental=False, **how)
    assert len(collect(DAY)) == 13


def test_metrics_job_refuses_unknown_names(spark):
    with pytest.raises(ValueError, match="unknown metrics"):
        jobs.metrics_job(spark, DAY, lambda frame, name: None, metrics=["nope"])


def test_jdbc_calls(spark, monkeypatch):
    """What is handed to Spark; no database is started for this."""
    seen = {}

    def fake_write(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=self._mode_seen, properties=properties)

    writer = type(spark.range(1).write)
    monkeypatch.setattr(writer, "_mode_seen", None, raising=False)

    def fake_mode(self, mode):
        self._mode_seen = mode
        return self
    monkeypatch.setattr(writer, "mode", fake_mode)
    monkeypatch.setattr(writer, "jdbc", fake_write)
    jobs.jdbc_sink("jdbc:x:y", {"user": "u"}, "db.")(spark.range(5), "t")
    assert seen == {"url": "jdbc:x:y", "table": "db.t", "mode": "append",
                    "properties": {"user": "u"}}

    reader, calls = type(spark.read), []
    monkeypatch.setattr(reader, "jdbc", lambda self, url, table, **more: calls.append(more))
    read_jdbc(spark, "u", "t", {"user": "u"})
    read_jdbc(spark, "u", "t", {}, "id", 0, 100, 4)
    assert calls[0] == {"properties": {"user": "u"}}
    assert calls[1]["numPartitions"] == 4 and calls[1]["column"] == "id"


def test_dated_counts(spark):
    frame = spark.createDataFrame([("P", 3)], "province string, counts bigint")
    got = jdbc.dated_region_counts(frame)
    assert got.columns == ["province", "counts", "date"]
    assert got.where(F.col("date") == F.current_date()).count() == 1
