import re
from datetime import datetime

import pytest
from log_help import TIME, lines, plan, raw_line, rows
from pyspark.sql import types as T

from visitmill.functions.times import yesterday
from visitmill.operators.clean import (
    clean_logs, cleaned_lines, distinct_hours, hourly_row_counts, rejected_by_reason,
)
from visitmill.schema import RAW_FIELDS, REFERENCE, SOURCE_COLUMNS
from visitmill.sources.logs import inferred_json_schema, read_json, read_lines
from visitmill.suite import derived

SMALL = "/root/testdata/sf0.001"


def cleaned(spark, *texts, **options):
    return clean_logs(lines(spark, *texts), **options).collect()


def test_columns_and_times(spark):
    frame = clean_logs(lines(spark, raw_line()))
    assert tuple(frame.columns) == SOURCE_COLUMNS
    row = frame.first()
    assert row.serverTime == row.clientTime == "2024-01-10-11:05:09"
    assert (row.day, row.hour) == ("2024-01-10", "11")


def test_trailing_empty_fields_do_not_count(spark):
    assert not cleaned(spark, raw_line(memo=""))
    assert len(cleaned(spark, raw_line() + "\t")) == 1
    assert len(cleaned(spark, raw_line() + "\t\t\t")) == 1
    assert not cleaned(spark, raw_line() + "\tmore")
    assert not cleaned(spark, "", "\t\t", "short\tline")
    # The end of the text counts, not the end before a line terminator.
    assert cleaned(spark, raw_line(memo="m\t\r"))  == []


@pytest.mark.parametrize("change, reason", [
    ({"deviceNum": "-1", "customerId": "-1"}, "identity"),
    ({"sessionId": "-1"}, "session"),
    ({"serverTime": "-1"}, "server_time"),
    ({"currentUrl": "x http://127.0.0.1/y"}, "current_url"),
    ({"previousUrl": "http://static.test.example/y"}, "previous_url"),
])
def test_rejects(spark, change, reason):
    line = raw_line(**change)
    for semantics in ("intended", "reference"):
        assert not cleaned(spark, line, semantics=semantics, test_urls=derived.TEST_URLS)
        found = dict(rows(rejected_by_reason(
            lines(spark, line, raw_line()), semantics, derived.TEST_URLS)))
        assert found == {reason: 1, "kept": 1}


def test_one_identity_is_enough(spark):
    assert len(cleaned(spark, raw_line(deviceNum="-1"), raw_line(customerId="-1"))) == 2


def test_missing_client_time(spark):
    line = raw_line(clientTime="-1")
    assert cleaned(spark, line)[0].clientTime == "-1"
    assert not cleaned(spark, line, semantics=REFERENCE)
    assert dict(rows(rejected_by_reason(lines(spark, line), REFERENCE))) == {"client_time": 1}


def test_time_text_elsewhere_in_the_line(spark):
    line = raw_line(title=f"at {TIME}!")
    assert cleaned(spark, line)[0].title == f"at {TIME}!"
    assert cleaned(spark, line, semantics=REFERENCE)[0].title == "at 2024-01-10-11:05:09!"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_zones(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        def server(text, **options):
            return cleaned(spark, raw_line(serverTime=text), **options)[0].serverTime
        assert server("Wed Jan 10 11:05:09 UTC 2024") == "2024-01-10-19:05:09"
        assert server("Wed Jan 10 20:05:09 GMT+00:00 2024") == "2024-01-11-04:05:09"
        assert server("Fri Jan 5 1:02:03 CST 2024") == "2024-01-05-01:02:03"
        assert server(TIME, zones={"CST": "America/Chicago"}) == "2024-01-11-01:05:09"
        # A wall clock time that the session's zone skips is kept.
        assert server("Sun Mar 10 02:30:00 CST 2024") == "2024-03-10-02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


IMPOSSIBLE = {
    "Wed Feb 30 11:05:09 CST 2024": "2024-03-01-11:05:09", "Wed Feb 29 11:05:09 CST 2023": "2023-03-01-11:05:09",
    "Wed Jan 10 25:05:09 CST 2024": "2024-01-11-01:05:09", "Wed Jan 10 11:61:70 CST 2024": "2024-01-10-12:02:10",
    "Sun Dec 31 24:00:00 CST 2023": "2024-01-01-00:00:00", "Wed Jan 0 00:00:00 CST 2024": "2023-12-31-00:00:00",
    "Wed Jan 32 11:05:09 GMT+00:00 2024": "2024-02-01-19:05:09", "Wed Jan 10 1000:00:00 EST 2024": "2024-02-21-05:00:00",
}


@pytest.mark.parametrize("text", IMPOSSIBLE)
def test_impossible_times_are_carried_over_in_the_reference_reading(spark, text):
    line = raw_line(serverTime=text, clientTime=text)
    row = cleaned(spark, line, semantics=REFERENCE)[0]
    assert row.serverTime == row.clientTime == IMPOSSIBLE[text]
    assert (row.day, row.hour) == (IMPOSSIBLE[text][:10], IMPOSSIBLE[text][11:13])
    assert dict(rows(rejected_by_reason(lines(spark, line), REFERENCE))) == {"kept": 1}
    with pytest.raises(Exception, match="unreadable log time"):
        cleaned(spark, line)


@pytest.mark.parametrize(("bad", "semantics"), [
    *[(bad, semantics) for semantics in ("intended", "reference") for bad in (
        "2024-01-10 11:05:09", "Wed Jan 10 11:05 CST 2024", "Xyz Jan 10 11:05:09 CST 2024",
        "Wed Jan 10 11:05:09 QQQ 2024", "Wed Jan 99999 11:05:09 CST 2024", "Wed Feb 30 11:05:09 QQQ 2024")],
    ("Wed Feb 30 11:05:09 CST 2024", "intended"), ("Wed Jan 10 25:05:09 CST 2024", "intended")])
def test_unreadable_time_fails_or_drops(spark, bad, semantics):
    line = raw_line(serverTime=bad)
    with pytest.raises(Exception, match="unreadable log time"):
        cleaned(spark, line, semantics=semantics)
    assert len(cleaned(spark, line, raw_line(), semantics=semantics, on_bad_time="drop")) == 1
    # Meant is that an event is not lost for its client's clock.
    line = raw_line(clientTime=bad)
    with pytest.raises(Exception, match="unreadable log time"):
        cleaned(spark, line, semantics=semantics)
    kept = cleaned(spark, line, semantics=semantics, on_bad_time="drop")
    assert [row.clientTime for row in kept] == (["-1"] if semantics == "intended" else [])


def test_own_test_hosts(spark):
    line = raw_line(currentUrl="http://it's.test/x")
    assert len(cleaned(spark, line)) == 1
    assert not cleaned(spark, line, test_urls=["http://it's.test"])


def plain_clean(line):
    """The clean rule once more, in plain Python."""
    fields = re.sub("\t+$", "", line).split("\t")
    at = dict(zip(RAW_FIELDS, fields))
    if len(fields) != 30 or "-1" in (at["sessionId"], at["serverTime"], at["clientTime"]):
        return None
    if at["deviceNum"] == at["customerId"] == "-1":
        return None
    if any(host in at[url] for url in ("currentUrl", "previousUrl")
           for host in ("http://127.0.0.1", "http://static.test.example")):
        return None
    for name in ("clientTime", "serverTime"):
        new = datetime.strptime(at[name], "%a %b %d %H:%M:%S CST %Y").strftime("%Y-%m-%d-%H:%M:%S")
        line = line.replace(at[name], new)
    return line.rstrip("\t")


def test_same_lines_as_a_plain_restatement(spark):
    raw = derived.raw_lines(spark, SMALL)
    expected = sorted(filter(None, (plain_clean(r.value) for r in raw.collect())))
    got = sorted(r.value for r in cleaned_lines(clean_logs(raw, REFERENCE, derived.TEST_URLS)).collect())
    assert got == expected and len(got) > 500


def test_hour_reports(spark):
    frame = clean_logs(lines(spark, raw_line(), raw_line(), raw_line(
        serverTime="Wed Jan 10 09:00:00 CST 2024")))
    assert rows(hourly_row_counts(frame)) == [("2024-01-10", "09", 1), ("2024-01-10", "11", 2)]
    assert [r.hour for r in distinct_hours(frame).collect()] == [9, 11]


def test_reading_files(spark, tmp_path):
    (tmp_path / "a.log").write_text(raw_line() + "\n" + raw_line() + "\r\n")
    assert clean_logs(read_lines(spark, str(tmp_path / "*.log"))).count() == 2
    (tmp_path / "r.json").write_text('{"a": 1, "b": "x"}\n{"a": 2}\n')
    assert rows(read_json(spark, str(tmp_path / "r.json"))) == [(1, "x"), (2, None)]


def test_json_files_that_differ_and_broken_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "v": 2, "in": {"x": "p"}}\n{"id": 2, "v"\n\n')
    (tmp_path / "b.json").write_text('{"id": 3, "v": 2.5, "in": {"y": true}}\n7\n{"id": "4"}\nnull\n')
    found = read_json(spark, str(tmp_path), bad_line="_bad")
    assert found.schema["v"].dataType.simpleString() == "double"
    assert found.schema["id"].dataType.simpleString() == "string"
    assert found.schema["in"].dataType.simpleString() == "struct<x:string,y:boolean>"
    got = found.select("id", "v", "in.x", "in.y", "_bad").where("id is not null or _bad is not null")
    assert rows(got) == sorted([
        ("1", 2.0, "p", None, None), ("3", 2.5, None, True, None), ("4", None, None, None, None),
        (None, None, None, None, '{"id": 2, "v"'), (None, None, None, None, "7"), (None, None, None, None, "null")], key=repr)
    # A given schema: values that don't fit are bad lines as well.
    own = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
    assert len(read_json(spark, str(tmp_path), own, bad_line="_bad").where("_bad is not null").collect()) == 4
    assert read_json(spark, str(tmp_path)).columns == ["id", "in", "v"]


def test_json_schema_of_a_share_of_the_files(spark, tmp_path):
    for k in range(12):
        (tmp_path / f"{k}.json").write_text(f'{{"id": {k}, "only_in_{k}": 1}}\n')
    share = inferred_json_schema(spark, str(tmp_path), 0.5)
    assert share == inferred_json_schema(spark, str(tmp_path), 0.5) and 2 <= len(share) < 13
    assert len(inferred_json_schema(spark, str(tmp_path), 1e-6)) == 2
    assert len(inferred_json_schema(spark, str(tmp_path))) == 13
    assert read_json(spark, str(tmp_path), share=0.5).count() == 12
    with pytest.raises(ValueError, match="share"):
        inferred_json_schema(spark, str(tmp_path), 0)


def test_yesterday():
    assert yesterday(datetime(2024, 3, 1).date()) == "2024-02-29"


def test_usual_zones_and_one_digit_days(spark):
    for token, hour in (("EST", "2024-01-11-00"), ("PDT", "2024-01-11-02"), ("JST", "2024-01-10-10"),
                        ("MSK", "2024-01-10-16"), ("HKT", "2024-01-10-11"), ("UTC", "2024-01-10-19")):
        line = raw_line(serverTime=f"Wed Jan 10 11:05:09 {token} 2024")
        assert cleaned(spark, line)[0]["serverTime"] == f"{hour}:05:09"
    one = raw_line(serverTime="Tue Jan 2 1:05:09 CST 2024")
    assert cleaned(spark, one)[0]["serverTime"] == "2024-01-02-01:05:09"


def test_kept_and_rejected_add_up_with_unreadable_times(spark):
    bad = [raw_line(), raw_line(clientTime="soon"), raw_line(serverTime="soon")]
    kept = cleaned(spark, *bad, on_bad_time="drop")
    assert [r["clientTime"] for r in kept] == ["2024-01-10-11:05:09", "-1"]
    counts = dict(rows(rejected_by_reason(lines(spark, *bad))))
    assert counts == {"kept": len(kept), "bad_time": 1}


def test_cleaning_never_shuffles(spark, tmp_path):
    (tmp_path / "a.log").write_text(raw_line() + "\n")
    from visitmill.sources.logs import read_lines
    assert "Exchange" not in plan(clean_logs(read_lines(spark, str(tmp_path))))
