"""Log lines, rules and JSON objects that Spark derives from the `events` table.

Residues of the event id decide which lines are short, lack an identity, come from a
test host and so on, so that every rule of the clean step meets rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "2024-01-10"
AS_OF = "2024-01-05"
TEST_URLS = ("http://127.0.0.1", "http://static.test.example")

_TIME = "case when event_id%13=0 then date_trunc('hour', ts) else ts end"


def _log_time(value: str) -> str:
    return (f"date_format({value}, 'EEE MMM dd HH:mm:ss') || ' CST ' || "
            f"date_format({value}, 'yyyy')")


_FIELDS = (
    "'r' || event_id", "'t' || event_id", "'sys1'",
    "case when event_id%53=0 then 'site,a' else 'site' end",
    "case when event_type='signup' then 'e_l' else event_type end", "'1.0'", "'pc'",
    "case when event_id%7=6 then '-1' else '0100100' || (event_id%7) end",
    "case when event_id%37=0 then '-1' else 'd' || (user_id%97) end",
    "case when event_id%37=0 or (user_id%6<>5 and (user_id%3=0 or event_id%4=0))"
    " then '-1' else 'c' || user_id end",
    "case when event_id%29=0 then '-1' else 's' || user_id || '-' || day(tt) end",
    f"case when event_id%47=0 then '-1' else {_log_time('tt - interval 2 seconds')} end",
    f"case when event_id%31=0 then '-1' else {_log_time('tt')} end",
    "'zh'", "'ua'", "'1x1'",
    "'10.' || (user_id%6) || '.' || (event_id%256) || '.' || (user_id%256)", "'web'", "'dom1'",
    "case when event_id%41=0 then 'http://127.0.0.1/x'"
    " else 'http://www.example.com/p' || (event_id%11) end",
    "case when event_id%43=0 then 'http://static.test.example/x'"
    " else 'http://www.example.com/q' || (event_id%5) end",
    "'title'", "'-1'", "'-1'", "'-1'", "'-1'", "'-1'", "'-1'", "'200'",
    "case when event_id%19=0 then '' else 'memo' end",
)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type")


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One raw line per event."""
    events = _events(spark, folder)
    line = f"concat_ws('\t', {', '.join(_FIELDS)}) || if(event_id%23=0, '\t', '')"
    return events.selectExpr("*", f"{_TIME} as tt").selectExpr(
        f"if(event_id%17=0, 'short\tline' || event_id, {line}) as value")


ZONE_HOURS = {"CST": 8, "EST": -5, "JST": 9, "PDT": -7, "UTC": 0, "MSK": 3}


def zone_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The raw lines with times of several zones, by event, and one-digit days."""
    token = f"element_at(array({', '.join(map(repr, ZONE_HOURS))}), int(n % {len(ZONE_HOURS)}) + 1)"
    return _numbered(spark, folder).selectExpr(
        f"regexp_replace(replace(value, ' CST ', ' ' || {token} || ' '), "
        "'([A-Z][a-z]{2} [A-Z][a-z]{2}) 0([0-9]) ', '$1 $2 ') as value")


def impossible_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The raw lines, some with days, hours and seconds that the calendar doesn't have."""
    return _numbered(spark, folder).selectExpr(
        "if(n % 3 = 0, replace(value, ' Jan ', ' Feb '), value) as value", "n").selectExpr(
        "if(n % 5 = 0, regexp_replace(value, ':[0-5]([0-9]) CST', ':7$1 CST'), value) as value", "n").selectExpr(
        "if(n % 7 = 0, regexp_replace(value, ' [01]([0-9]):([0-9][0-9]):', ' 2$1:$2:'), value) as value")


def bad_time_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The raw lines, some with a zone that nobody knows."""
    return _numbered(spark, folder).selectExpr(
        "if(n % 59 = 0, replace(value, ' CST ', ' QQQ '), value) as value")


def _numbered(spark: SparkSession, folder: str) -> DataFrame:
    """Raw lines with the event's number; that of a short line isn't needed."""
    return raw_lines(spark, folder).selectExpr(
        "value", "coalesce(try_cast(regexp_extract(value, '^r([0-9]+)', 1) as bigint), 1) as n")


def channel_rules(spark: SparkSession) -> DataFrame:
    """Channel rules; the last one repeats a code and must lose."""
    return spark.sql("""
        select * from values
          (1L, '01001000', 'appA', 'ios', 'natural'), (2L, '01001001', 'appA', 'android', 'paid'),
          (3L, '01001002', 'appB', 'android', 'natural'), (4L, '01001003', 'appB', 'ios', 'paid'),
          (5L, '01001004', 'appC', 'h5', 'paid'), (6L, '01001001', 'dup', 'dup', 'dup')
        as t(line_no, channelFrom, app_channel, platform, traffic)""")


def ip_rules(spark: SparkSession) -> DataFrame:
    """IP rules from one address to several /16 wide, with gaps; city HY is in two provinces and
    one city is empty."""
    return spark.sql("""
        select * from values
          (167772160L, 167804927L, 'GD', 'GZ', 'GZ-area', 'op1'),
          (167804928L, 167805183L, 'GD', 'FS', 'FS-area', 'op2'),
          (167805184L, 167805190L, 'GD', 'SZ', 'SZ-area', 'op1'),
          (167805191L, 167805191L, 'GX', 'NN', 'NN-area', 'op3'),
          (167805300L, 167808100L, 'GX', 'GL', 'GL-area', 'op1'),
          (167820000L, 167903231L, 'GD', 'HY', 'HY-area', 'op2'),
          (167903232L, 167968767L, 'HN', 'HY', 'HY-area', 'op1'),
          (167968768L, 168034303L, 'SH', 'SH', 'SH-area', 'op2'),
          (168099840L, 184549375L, 'BJ', '', 'BJ-area', 'op1')
        as t(startNum, endNum, province, city, area, operator)""")


def skewed(source: DataFrame) -> DataFrame:
    """Clean rows of which a third comes from one address with one channel code."""
    hot = "int(substr(reqSerial, 2)) % 3 = 0"
    return source.withColumns({
        "ip": F.expr(f"if({hot}, '10.1.2.3', ip)"), "channelForm": F.expr(f"if({hot}, '01001002', channelForm)")})


def people_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Comma-separated lines with a number, a name and a date; some don't fit their columns."""
    return _events(spark, folder).selectExpr(
        """event_id || ',"n,' || user_id || '",' || case when event_id % 13 = 0 then 'soon'
            when event_id % 17 = 0 then '2024-02-30' else date_format(ts, 'yyyy-MM-dd') end
            || if(event_id % 19 = 0, ',more', '') as value""")


def json_lines(spark: SparkSession, folder: str, newer: bool) -> DataFrame:
    """One JSON record per event as text; newer ones have other fields, and some are cut off."""
    events = _events(spark, folder).where(f"event_id % 2 = {int(newer)}")
    fields = "'kind', event_type, 'size', event_id / 2" if newer else "'kind', event_type, 'user', user_id"
    return events.selectExpr(
        f"to_json(named_struct('id', event_id, {fields}, 'at', named_struct('day', date_format(ts, 'yyyy-MM-dd')))) as j",
        "event_id").selectExpr("if(event_id % 23 = 0, substr(j, 1, 12), j) as value")


def broken_json_objects(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON objects, some cut off and some with a number for a section."""
    return json_objects(spark, folder).selectExpr(
        "event_id", """case when event_id % 97 = 0 then substr(json, 1, 20)
            when event_id % 89 = 0 then '{"report":5}' else json end as json""")


def json_objects(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON object per event, with a `report` and a `user_basic` section.

    Every seventh report lacks its version, and every eleventh names its source twice.
    """
    events = _events(spark, folder)

    def pair(key: str, value: str) -> str:
        return f"""'{{"key":"{key}","value":"' || {value} || '"}}'"""

    report = [
        pair("data_type", "event_type"), pair("source_name", "'s' || user_id%7"),
        "if(event_id%11=0, " + pair("source_name", "'again' || user_id") + ", null)",
        pair("task_id", "event_id"),
        "if(event_id%7=0, null, " + pair("version", "'1.' || event_id%3") + ")",
    ]
    basic = [pair("name", "'n' || user_id"), pair("city", "'c' || user_id%5")]
    return events.selectExpr(
        "event_id",
        f"""'{{"report":[' || concat_ws(',', {', '.join(report)}) ||
            '],"user_basic":[' || concat_ws(',', {', '.join(basic)}) || ']}}' as json""")
