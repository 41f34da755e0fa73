import random

import pytest
from log_help import lines, plan, raw_line, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from visitmill.operators.clean import clean_logs
from visitmill.operators.hours import LOG_NINE_JOINT, SESSION_NINE_JOINT, source_hours, with_hour
from visitmill.operators.sessions import session_summary
from visitmill.schema import SESSION_SCHEMA, SOURCE_COLUMNS, strings

DAY = "2024-01-10"


def source(spark, *events):
    """Clean rows from (request, session, time, page) and optional further fields."""
    out = []
    for request, session, time, page, *more in events:
        row = dict.fromkeys(SOURCE_COLUMNS, "x")
        row.update(reqSerial=request, sessionId=session, serverTime=f"{DAY}-{time}",
                   currentUrl=page, deviceNum=f"d-{request}", customerId=f"c-{request}",
                   day=DAY, hour=time[:2])
        row.update(*more)
        out.append(tuple(row[c] for c in SOURCE_COLUMNS))
    return spark.createDataFrame(out, strings(*SOURCE_COLUMNS))


def test_summary(spark):
    frame = source(spark, ("r2", "s", "10:00:05", "/b"), ("r1", "s", "10:00:00", "/a"),
                   ("r3", "s", "11:00:00", "/a"), ("r9", "t", "09:00:00", "/z"))
    got = session_summary(frame)
    assert rows(got) == [
        ("d-r1", "c-r1", "s", f"{DAY}-10:00:00", f"{DAY}-11:00:00", "/a", "/a", 2, DAY),
        ("d-r9", "c-r9", "t", f"{DAY}-09:00:00", f"{DAY}-09:00:00", "/z", "/z", 1, DAY)]
    assert got.schema["visitPageNum"].dataType == SESSION_SCHEMA["visitPageNum"].dataType
    assert rows(session_summary(frame, "reference"))[0][7] == "2"


def test_ties_are_ordered_by_request(spark):
    frame = source(spark, *[(f"r{i}", "s", "10:00:00", f"/{i}") for i in (3, 1, 2)])
    row = session_summary(frame).first()
    assert (row.deviceNum, row.entryPage, row.leavePage) == ("d-r1", "/1", "/3")


def test_comma_shifts_the_reference_order(spark):
    frame = source(spark, ("r1", "s", "10:00:00", "/first", {"sysDesc": "a,b", "clientTime": "z"}),
                   ("r2", "s", "11:00:00", "/second"))
    assert session_summary(frame).first().entryPage == "/first"
    row = session_summary(frame, "reference").first()
    assert (row.entryPage, row.leavePage) == ("/second", "/first")
    assert (row.startTime, row.endTime) == (f"{DAY}-11:00:00", f"{DAY}-10:00:00")


def test_cut_at_midnight(spark):
    late = "Wed Jan 10 23:59:59 CST 2024"
    early = "Thu Jan 11 00:00:01 CST 2024"
    frame = clean_logs(lines(spark, raw_line(serverTime=late), raw_line(serverTime=early)))
    assert session_summary(frame).count() == 2


def test_missing_page_counts_once(spark):
    frame = source(spark, ("r1", "s", "10:00:00", None), ("r2", "s", "10:00:01", None),
                   ("r3", "s", "10:00:02", "/a"))
    assert session_summary(frame).first().visitPageNum == 2


def by_window(frame):
    w = Window.partitionBy("day", "sessionId")
    order = ["serverTime", "reqSerial"]
    first = F.row_number().over(w.orderBy(*order))
    last = F.row_number().over(w.orderBy(*[F.desc(c) for c in order]))
    pages = F.size(F.collect_set("currentUrl").over(w))
    ranked = frame.select("*", first.alias("f"), last.alias("l"), pages.alias("p"))
    a, z = ranked.where("f = 1"), ranked.where("l = 1")
    z = z.selectExpr("day", "sessionId", "serverTime as e", "currentUrl as u")
    return a.join(z, ["day", "sessionId"]).selectExpr(
        "deviceNum", "customerId", "sessionId", "serverTime", "e", "currentUrl", "u",
        "bigint(p)", "day")


def test_equals_window_form_with_a_hot_session(spark):
    chance = random.Random(7)
    events = [(f"r{i:04d}", "hot" if i % 3 == 0 else f"s{chance.randint(0, 40)}",
               f"{chance.randint(0, 23):02d}:00:{chance.randint(0, 3):02d}",
               f"/{chance.randint(0, 30)}") for i in range(1500)]
    frame = source(spark, *events)
    got = session_summary(frame)
    assert rows(got) == rows(by_window(frame))
    text = plan(got)
    # The hot session is first combined per page, on the map side and after a shuffle by
    # session and page, and no list of events is built.
    assert "currentUrl" in text.split("hashpartitioning(", 1)[1].split(")")[0]
    assert "collect" not in text and "Window" not in text


def bounds(day, hour, joint):
    low = f"{day}-{hour:02d}:00:00"
    high = f"{day}{joint if hour == 9 else '-'}{hour + 1:02d}:00:00"
    return low, high


@pytest.mark.parametrize("joint", [SESSION_NINE_JOINT, LOG_NINE_JOINT])
@pytest.mark.parametrize("present", [range(24), (0, 8, 10, 23), (9, 11)])
def test_reference_hours_equal_between(spark, joint, present):
    times = [f"{DAY}-{h:02d}:{m}" for h in range(24) for m in ("00:00", "00:01", "59:59")]
    frame = spark.createDataFrame([(t, DAY) for t in times], "t string, day string")
    hours = spark.createDataFrame([(DAY, h) for h in present], "day string, hour int")
    got = rows(with_hour(frame, "t", "reference", hours, joint).select("t", "hour"))
    expected = []
    for t in times:
        for h in present:
            low, high = bounds(DAY, h, joint)
            if low <= t <= high:
                expected.append((t, f"{h:02d}"))
    assert got == sorted(expected)
    assert "BroadcastHashJoin" in plan(with_hour(frame, "t", "reference", hours, joint))


def test_intended_hours(spark):
    frame = spark.createDataFrame([(f"{DAY}-09:00:00", DAY)], "t string, day string")
    assert rows(with_hour(frame, "t")) == [(f"{DAY}-09:00:00", DAY, "09")]
    with pytest.raises(ValueError):
        with_hour(frame, "t", "reference")


def test_source_hours(spark):
    frame = source(spark, ("r1", "s", "09:30:00", "/"), ("r2", "s", "10:00:00", "/"),
                   ("r3", "s", "10:00:01", "/"))
    assert rows(source_hours(frame)) == [(DAY, 10), (DAY, 9)]
