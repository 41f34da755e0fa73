"""Log times: `Wed Jan 10 11:05:09 CST 2024` to `2024-01-10-11:05:09`, and hour bounds."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitmill.functions.text import literal, literal_map

# Fixed values of the log format.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
# Usual zone names of such times, by their offsets. CST is China's, where the logs are from.
DEFAULT_ZONES = {
    "CST": "Asia/Shanghai",
    "AEDT": "+11:00", "AEST": "+10:00", "AKDT": "-08:00", "AKST": "-09:00", "BST": "+01:00",
    "CDT": "-05:00", "CEST": "+02:00", "CET": "+01:00", "EDT": "-04:00", "EEST": "+03:00",
    "EET": "+02:00", "EST": "-05:00", "HKT": "+08:00", "HST": "-10:00", "ICT": "+07:00",
    "IST": "+05:30", "JST": "+09:00", "KST": "+09:00", "MDT": "-06:00", "MSK": "+03:00",
    "MST": "-07:00", "NZDT": "+13:00", "NZST": "+12:00", "PDT": "-07:00", "PST": "-08:00",
    "SGT": "+08:00", "WEST": "+01:00", "WET": "+00:00", "WIB": "+07:00", "Z": "UTC",
}
DEFAULT_ZONE = "Asia/Shanghai"
_PATTERN = "MMM d H:m:s VV yyyy"


def log_time(
    text: str,
    zones: Mapping[str, str] = DEFAULT_ZONES,
    zone: str = DEFAULT_ZONE,
    on_bad_time: str = "fail",
    lenient: bool = False,
) -> str:
    """Reformat a log time as wall clock time of `zone`; takes and gives SQL text.

    `zones` names the zone of each token that is ambiguous on its own (CST is also US
    Central time); UTC, GMT+08:00 and the like are understood as they are. Unreadable
    text fails the query, or gives NULL with `drop`. With `lenient`, days, hours, minutes and
    seconds that the calendar doesn't have are carried over (February 30 is March 1 or 2).
    The result does not depend on the session's zone.
    """
    if on_bad_time not in ("fail", "drop"):
        raise ValueError(f"on_bad_time must be 'fail' or 'drop', got {on_bad_time!r}")
    attempts = [_parsed(text, zones, zone)]
    local = [re.escape(token) for token, name in zones.items() if name == zone]
    if local:
        attempts.insert(0, _rearranged(text, local))
    if lenient:
        attempts.append(_carried_over(text, zones, zone))
    if on_bad_time == "fail":
        attempts.append(f"raise_error(concat('unreadable log time: ', coalesce({text}, 'NULL')))")
    return f"coalesce({', '.join(attempts)})"


def _rearranged(text: str, local_tokens: list[str]) -> str:
    """Times already in the wanted zone, with two-digit days: only the parts move.

    Nearly all times are of this kind, and moving substrings costs a fifth of parsing.
    """
    shape = (f"^({'|'.join(WEEKDAYS)}) ({'|'.join(MONTHS)}) [0-3][0-9] "
             f"([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9] ({'|'.join(local_tokens)}) [0-9]{{4}}$")
    numbers = literal_map({month: f"{i:02d}" for i, month in enumerate(MONTHS, 1)})
    return f"""case when rlike({text}, {literal(shape)}) then concat(
        cast(try_cast(concat(
            substr({text}, -4), '-', try_element_at({numbers}, substr({text}, 5, 3)), '-',
            substr({text}, 9, 2)) as date) as string),
        '-', substr({text}, 12, 8)) end"""


def _parsed(text: str, zones: Mapping[str, str], zone: str) -> str:
    """Any readable time. The weekday is cut off, as Spark does not parse it."""
    weekdays = ", ".join(f"'{name}'" for name in WEEKDAYS)
    named = literal_map(dict(zones)) if zones else "map()"
    rest = f"""element_at(transform(array(split({text}, ' ')), p -> case
        when size(p) = 6 and p[0] in ({weekdays}) then
        concat_ws(' ', p[1], p[2], p[3], coalesce(try_element_at({named}, p[4]), p[4]), p[5]) end), 1)"""
    return f"""replace(cast(convert_timezone('UTC', {literal(zone)}, timestampadd(SECOND,
        unix_seconds(try_to_timestamp({rest}, '{_PATTERN}')),
        timestamp_ntz'1970-01-01 00:00:00')) as string), ' ', '-')"""


def _carried_over(text: str, zones: Mapping[str, str], zone: str) -> str:
    """Times with parts of up to four digits, added to the first of the month one by one."""
    shape = (rf"^({'|'.join(WEEKDAYS)}) ({'|'.join(MONTHS)}) [0-9]{{1,4}} "
             r"[0-9]{1,4}:[0-9]{1,4}:[0-9]{1,4} [^ ]+ [0-9]{4}$")
    named = literal_map(dict(zones)) if zones else "map()"
    numbers = literal_map({month: str(i) for i, month in enumerate(MONTHS, 1)})
    # p: weekday, month, day, clock, zone, year. An unknown zone gives NULL.
    added = f"make_timestamp_ntz(int(p[5]), int(try_element_at({numbers}, p[1])), 1, 0, 0, 0)"
    for unit, value in (("DAY", "int(p[2]) - 1"), ("HOUR", "int(split(p[3], ':')[0])"),
                        ("MINUTE", "int(split(p[3], ':')[1])"), ("SECOND", "int(split(p[3], ':')[2])")):
        added = f"timestampadd({unit}, {value}, {added})"
    known = f"try_to_timestamp(concat('Jan 1 0:0:0 ', z, ' 2000'), '{_PATTERN}') is not null"
    moved = f"""element_at(transform(array(coalesce(try_element_at({named}, p[4]), p[4])), z -> case
        when {known} then replace(cast(convert_timezone(z, {literal(zone)}, {added}) as string), ' ', '-') end), 1)"""
    return f"""case when rlike({text}, {literal(shape)}) then
        element_at(transform(array(split({text}, ' ')), p -> {moved}), 1) end"""


def day_of(time: Column) -> Column:
    return F.substring(time, 1, 10)


def hour_of(time: Column) -> Column:
    return F.substring(time, 12, 2)


def hour_number(time: Column) -> Column:
    return hour_of(time).cast("int")


def hour_label(hour: Column) -> Column:
    return F.lpad(hour.cast("string"), 2, "0")


def hour_lower(day: Column, hour: Column) -> Column:
    """First instant of an hour, as log time text."""
    return F.concat(day, F.lit("-"), hour_label(hour), F.lit(":00:00"))


def hour_upper(day: Column, hour: Column, nine_joint: str = "-") -> Column:
    """First instant after an hour. Hour 23 ends at `-24:00:00`, which still sorts last.

    `nine_joint` is the text between day and `10` for hour 9 only; the earlier jobs
    have a malformed bound there.
    """
    joint = F.when(hour == 9, F.lit(nine_joint)).otherwise(F.lit("-"))
    return F.concat(day, joint, hour_label(hour + 1), F.lit(":00:00"))


def partition_hour(partition: Column) -> Column:
    """Hour number from a partition name such as `day=2024-01-10/hour=09`."""
    return F.regexp_extract(partition, r"hour=(\d+)", 1).cast("int")


def yesterday(today: date | None = None, zone: str = DEFAULT_ZONE) -> str:
    """The day before `today`, by default today in the zone of the logs."""
    return ((today or datetime.now(ZoneInfo(zone)).date()) - timedelta(days=1)).isoformat()
