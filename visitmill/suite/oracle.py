"""DuckDB SQL for the registered queries.

Written apart from the Spark code and in another way: times with strptime, sessions
with row_number, distinct counts per subquery, the range join on BETWEEN.
"""

from __future__ import annotations

from typing import NamedTuple

DAY, AS_OF = "2024-01-10", "2024-01-05"
MEMBER, VISITOR = "member", "visitor"


class Metric(NamedTuple):
    family: str
    source: str
    keys: tuple[tuple[str, str], ...] = ()

    @property
    def inputs(self) -> tuple[str, ...]:
        return tuple(k for k, _ in self.keys)


_BY = {
    "": (), "province": (("ipProvince", "province"),),
    "city": (("ipProvince", "province"), ("ipCity", "city")),
    "channel": (("app_channel", "app_channel"),), "area_channel": (("app_channel", "app_channel"),),
    "platform": (("platform", "platform"),), "traffic": (("traffic", "traffic"),),
}
METRICS = {
    "daily_users": Metric(VISITOR, "source"), "daily_visitors": Metric(VISITOR, "source"),
    "daily_members": Metric(MEMBER, "source"),
} | {
    f"{family}s_by_{key}": Metric(family, table, _BY[key])
    for table, keys in (("area", ("province", "city", "area_channel")),
                        ("platform", ("platform", "channel", "traffic")))
    for family in (VISITOR, MEMBER) for key in keys
}
RAW_FIELDS = (
    "reqSerial traceId sysId sysDesc eventName version platformChannel channelForm deviceNum customerId "
    "sessionId clientTime serverTime language userAgent resolution ip terminalChannel domainId currentUrl "
    "previousUrl title orderId productId amount category action duration respCode memo").split()
REPORT_FIELDS = "data_type source_name source_name_zh data_gain_time task_id update_time version".split()

_CT = "strftime({x}, '%a %b %d %H:%M:%S CST %Y')"
_NEW = "strftime(strptime({x}, '%a %b %d %H:%M:%S CST %Y'), '%Y-%m-%d-%H:%M:%S')"

_LINES = f"""
ticks as (select event_id, user_id, event_type,
    case when event_id % 13 = 0 then date_trunc('hour', ts) else ts end as tt from events),
lines as (select case when event_id % 17 = 0 then 'short' || chr(9) || 'line' || event_id
  else array_to_string([
    'r' || event_id, 't' || event_id, 'sys1',
    case when event_id % 53 = 0 then 'site,a' else 'site' end,
    case when event_type = 'signup' then 'e_l' else event_type end, '1.0', 'pc',
    case when event_id % 7 = 6 then '-1' else '0100100' || (event_id % 7) end,
    case when event_id % 37 = 0 then '-1' else 'd' || (user_id % 97) end,
    case when event_id % 37 = 0 or (user_id % 6 <> 5 and (user_id % 3 = 0 or event_id % 4 = 0))
      then '-1' else 'c' || user_id end,
    case when event_id % 29 = 0 then '-1' else 's' || user_id || '-' || day(tt) end,
    case when event_id % 47 = 0 then '-1' else {_CT.format(x="tt - interval '2' second")} end,
    case when event_id % 31 = 0 then '-1' else {_CT.format(x='tt')} end,
    'zh', 'ua', '1x1',
    '10.' || (user_id % 6) || '.' || (event_id % 256) || '.' || (user_id % 256), 'web', 'dom1',
    case when event_id % 41 = 0 then 'http://127.0.0.1/x'
      else 'http://www.example.com/p' || (event_id % 11) end,
    case when event_id % 43 = 0 then 'http://static.test.example/x'
      else 'http://www.example.com/q' || (event_id % 5) end,
    'title', '-1', '-1', '-1', '-1', '-1', '-1', '200',
    case when event_id % 19 = 0 then '' else 'memo' end], chr(9))
   || case when event_id % 23 = 0 then chr(9) else '' end end as value from ticks),
cells as (select value, string_split(regexp_replace(value, '\\t+$', ''), chr(9)) as f from lines)
"""

# Parts of a time as numbers, added to the first of its month.
_CARRIED = "strftime(make_date({year}, {month}, 1) + to_days({day} - 1) + to_hours({hour}) " \
           "+ to_minutes({minute}) + to_seconds({second}), '%Y-%m-%d-%H:%M:%S')".format(
               year="cast(right({x}, 4) as integer)",
               month="(instr('JanFebMarAprMayJunJulAugSepOctNovDec', substr({x}, 5, 3)) + 2) // 3",
               **{part: f"cast(substr({{x}}, {at}, 2) as integer)"
                  for part, at in (("day", 9), ("hour", 12), ("minute", 15), ("second", 18))})
_IMPOSSIBLE = """
events_of as (select value, coalesce(try_cast(regexp_extract(value, '^r([0-9]+)', 1) as bigint), 1) as n from lines),
months_of as (select n, case when n % 3 = 0 then replace(value, ' Jan ', ' Feb ') else value end as value
  from events_of),
seconds_of as (select n, case when n % 5 = 0
  then regexp_replace(value, ':[0-5]([0-9]) CST', ':7\\1 CST', 'g') else value end as value from months_of),
hours_of as (select case when n % 7 = 0
  then regexp_replace(value, ' [01]([0-9]):([0-9][0-9]):', ' 2\\1:\\2:', 'g') else value end as value from seconds_of),
cells as (select value, string_split(regexp_replace(value, '\\t+$', ''), chr(9)) as f from hours_of)
"""

_TEST_HOST = "({c} like '%http://127.0.0.1%' or {c} like '%http://static.test.example%')"


def _reject(reference: bool) -> str:
    steps = [
        ("arity", "len(f) <> 30"),
        ("identity", "f[9] = '-1' and f[10] = '-1'"),
        ("session", "f[11] = '-1'"),
        ("server_time", "f[13] = '-1'"),
        ("current_url", _TEST_HOST.format(c="f[20]")),
        ("previous_url", _TEST_HOST.format(c="f[21]")),
    ]
    if reference:
        steps.append(("client_time", "f[12] = '-1'"))
    return "case " + " ".join(f"when {c} then '{n}'" for n, c in steps) + " else 'kept' end"


def _source(reference: bool, new: str = _NEW) -> str:
    good = f"good as (select * from cells where {_reject(reference)} = 'kept')"
    if reference:
        timed = f"""timed as (select string_split(regexp_replace(
            replace(replace(value, f[12], {new.format(x='f[12]')}),
                    f[13], {new.format(x='f[13]')}), '\\t+$', ''), chr(9)) as f from good)"""
        value = [f"f[{i}]" for i in range(1, 31)]
    else:
        timed = "timed as (select f from good)"
        value = [f"f[{i}]" for i in range(1, 31)]
        value[11] = f"case when f[12] = '-1' then '-1' else {_NEW.format(x='f[12]')} end"
        value[12] = _NEW.format(x="f[13]")
    columns = ", ".join(f"{v} as {n}" for v, n in zip(value, RAW_FIELDS))
    return f"""{good}, {timed},
fields as (select {columns} from timed),
source as (select *, substr(serverTime, 1, 10) as day, substr(serverTime, 12, 2) as hour
  from fields)"""


_PLATFORM = """
codes(code, app_channel, platform, traffic) as (values
  ('01001000', 'appA', 'ios', 'natural'), ('01001001', 'appA', 'android', 'paid'),
  ('01001002', 'appB', 'android', 'natural'), ('01001003', 'appB', 'ios', 'paid'),
  ('01001004', 'appC', 'h5', 'paid')),
platforms as (select s.eventName as eventId, s.deviceNum, s.customerId, s.sessionId, s.serverTime,
    s.ip, s.channelForm as channelFrom,
    case when s.channelForm = '-1' then '-1' else coalesce(c.platform, '') end as platform,
    case when s.channelForm = '-1' then '-1' else coalesce(c.app_channel, '') end as app_channel,
    case when s.channelForm = '-1' then '-1' else coalesce(c.traffic, '') end as traffic,
    s.day, s.hour
  from source s left join codes c on c.code = s.channelForm)"""


def _area(reference: bool) -> str:
    city = "r.city" if reference else "case when r.city = '' then r.zone else r.city end"
    return f"""
ranges(lo, hi, province, city, zone, carrier) as (values
  (167772160, 167804927, 'GD', 'GZ', 'GZ-area', 'op1'),
  (167804928, 167805183, 'GD', 'FS', 'FS-area', 'op2'),
  (167805184, 167805190, 'GD', 'SZ', 'SZ-area', 'op1'),
  (167805191, 167805191, 'GX', 'NN', 'NN-area', 'op3'),
  (167805300, 167808100, 'GX', 'GL', 'GL-area', 'op1'),
  (167820000, 167903231, 'GD', 'HY', 'HY-area', 'op2'),
  (167903232, 167968767, 'HN', 'HY', 'HY-area', 'op1'),
  (167968768, 168034303, 'SH', 'SH', 'SH-area', 'op2'),
  (168099840, 184549375, 'BJ', '', 'BJ-area', 'op1')),
numbers as (select *, split_part(ip, '.', 1)::bigint * 16777216
    + split_part(ip, '.', 2)::bigint * 65536 + split_part(ip, '.', 3)::bigint * 256
    + split_part(ip, '.', 4)::bigint as n from platforms),
areas as (select p.eventId, p.deviceNum, p.customerId, p.sessionId, p.serverTime, p.ip,
    coalesce(r.province, '-1') as ipProvince,
    case when r.lo is null then '-1' else {city} end as ipCity,
    coalesce(r.carrier, '-1') as operator, p.app_channel, p.day, p.hour,
    p.platform, p.traffic, coalesce(r.zone, '-1') as ipArea
  from numbers p left join ranges r on p.n between r.lo and r.hi)"""


def _with(reference: bool, *parts: str) -> str:
    return "with " + ", ".join([_LINES, _source(reference), *parts])


def _from(table: str, reference: bool) -> str:
    parts = {"source": (), "platform": (_PLATFORM,), "area": (_PLATFORM, _area(reference))}[table]
    return _with(reference, *parts)


_TABLE = {"source": "source", "platform": "platforms", "area": "areas"}
_AREA_COLUMNS = ("eventId, deviceNum, customerId, sessionId, serverTime, ip, ipProvince, ipCity, "
                 "operator, app_channel, day, hour")


def _sessions(reference: bool) -> str:
    columns = ", ".join(f"coalesce({c}, 'null')" for c in (*RAW_FIELDS, "day", "hour"))
    key = (f"string_split('[' || concat_ws(',', {columns}) || ']', ',')[13]"
           if reference else "serverTime")
    pages = "cast(p.pages as varchar)" if reference else "p.pages"
    return f"""
keyed as (select *, {key} as k from source),
ranked as (select *,
    row_number() over (partition by day, sessionId order by k, reqSerial) as first_rank,
    row_number() over (partition by day, sessionId order by k desc, reqSerial desc) as last_rank
  from keyed),
visits as (select a.deviceNum, a.customerId, a.sessionId as sessionID, a.serverTime as startTime,
    z.serverTime as endTime, a.currentUrl as entryPage, z.currentUrl as leavePage,
    {pages} as visitPageNum, a.day
  from ranked a
  join ranked z on a.day = z.day and a.sessionId = z.sessionId and z.last_rank = 1
  join (select day, sessionId, count(distinct currentUrl) as pages from source group by all) p
    on a.day = p.day and a.sessionId = p.sessionId
  where a.first_rank = 1)"""


def _bounds(nine: str) -> str:
    """Hours of the source with the text bounds that the existing writers use."""
    return f"""
hours as (select distinct day, cast(hour as int) as h from source),
bounds as (select day, h, day || '-' || lpad(cast(h as varchar), 2, '0') || ':00:00' as lo,
    case when h = 9 then day || '{nine}' || '10:00:00'
         else day || '-' || lpad(cast(h + 1 as varchar), 2, '0') || ':00:00' end as hi
  from hours)"""


_VISITOR, _MEMBER, _NEW_USER = "customerId = '-1'", "customerId <> '-1'", "{e} = 'e_l'"


def _metric(name: str, metric: Metric, reference: bool) -> str:
    head = _from(metric.source, reference)
    event = "eventName" if metric.source == "source" else "eventId"
    table, new, today = _TABLE[metric.source], _NEW_USER.format(e=event), f"day = '{DAY}'"
    if not metric.keys:
        def count(column: str, *conditions: str) -> str:
            return (f"(select count(distinct {column}) from {table} "
                    f"where {' and '.join(conditions)})")
        v, vn = count("deviceNum", _VISITOR, today), count("deviceNum", _VISITOR, today, new)
        m, mn = count("customerId", _MEMBER, today), count("customerId", _MEMBER, today, new)
        columns = {
            "daily_users": f"{v} + {m} as UV",
            "daily_visitors": f"{v} + {m} as uv_act, {vn} + {mn} as uv_new",
            "daily_members": f"{m} as uv_act, {mn} as uv_new, "
                             f"{count('customerId', _MEMBER)} as uv_all",
        }[name]
        return f"{head} select {columns}, '{DAY}' as day"

    keys = ", ".join(metric.inputs)

    def part(alias: str, column: str, *conditions: str) -> str:
        return (f"{alias} as (select {keys}, count(distinct {column}) as n from {table} "
                f"where {' and '.join(conditions)} group by {keys})")

    parts = [
        part("v", "deviceNum", _VISITOR, today), part("vn", "deviceNum", _VISITOR, today, new),
        part("m", "customerId", _MEMBER, today), part("mn", "customerId", _MEMBER, today, new),
        part("mall", "customerId", _MEMBER),
    ]
    names = ", ".join(f"d.{k} as {out}" for k, out in metric.keys)
    if metric.family == MEMBER:
        domain, others = "mall", ("m", "mn")
        columns = ("d.n as uv_act, mn.n as uv_new, m.n as uv_all" if reference else
                   "coalesce(m.n, 0) as uv_act, coalesce(mn.n, 0) as uv_new, d.n as uv_all")
    elif reference:
        domain, others = "v", ("m", "vn", "mn")

        def zero(x: str) -> str:
            return f"case when {x}.n is null then 0 end"
        columns = f"d.n + {zero('m')} as uv_act, {zero('vn')} + {zero('mn')} as uv_new"
    else:
        parts.append(f"anyone as (select distinct {keys} from {table} where {today})")
        domain, others = "anyone", ("v", "m", "vn", "mn")
        columns = ("coalesce(v.n, 0) + coalesce(m.n, 0) as uv_act, "
                   "coalesce(vn.n, 0) + coalesce(mn.n, 0) as uv_new")
    joins = " ".join(
        f"left join {o} on " + " and ".join(f"d.{k} = {o}.{k}" for k in metric.inputs) for o in others)
    return (f"{head}, {', '.join(parts)} "
            f"select {columns}, {names}, '{DAY}' as day from {domain} d {joins}")


def _metric_set(table: str) -> str:
    rows = []
    for name, metric in METRICS.items():
        if metric.source != table:
            continue
        outs = [out for _, out in metric.keys]
        key2 = outs[1] if len(outs) > 1 else "cast(null as varchar)"
        total = "uv_all" if metric.family == MEMBER else "cast(null as bigint)"
        rows.append(f"select '{name}' as metric, {outs[0]} as key1, {key2} as key2, "
                    f"uv_act, uv_new, {total} as uv_all from ({_metric(name, metric, False)})")
    return " union all ".join(rows)


def _json() -> str:
    def pair(key: str, value: str) -> str:
        return f"""'{{"key":"{key}","value":"' || {value} || '"}}'"""
    report = ", ".join([
        pair("data_type", "event_type"), pair("source_name", "'s' || user_id % 7"),
        f"case when event_id % 11 = 0 then {pair('source_name', chr(39) + 'again' + chr(39) + ' || user_id')} end",
        pair("task_id", "event_id"),
        f"case when event_id % 7 <> 0 then {pair('version', chr(39) + '1.' + chr(39) + ' || event_id % 3')} end",
    ])
    return f"""with texts as (select event_id, '{{"report":[' || concat_ws(',', {report}) || ']}}' as j
  from events),
arrays as (select event_id, from_json(json_extract(j, '$.report'),
    '[{{"key":"VARCHAR","value":"VARCHAR"}}]') as pairs from texts),
pairs as (select event_id, unnest(range(len(pairs))) as position, unnest(pairs) as p from arrays)"""


def oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    for suffix, reference in (("", False), ("_ref", True)):
        source = _with(reference)
        found[f"clean_logs{suffix}"] = f"{source} select * from source"
        found[f"rejected_by_reason{suffix}"] = (
            f"with {_LINES} select {_reject(reference)} as reason, count(*) as lines "
            "from cells group by 1")
        found[f"ip_enriched{suffix}"] = (
            f"{_from('area', reference)} select {_AREA_COLUMNS} from areas")
        found[f"session_summary{suffix}"] = (
            f"{_with(reference, _sessions(reference))} select * from visits")
    source = _with(False)
    found["cleaned_lines"] = f"{source} select concat_ws(chr(9), {', '.join(RAW_FIELDS)}) as value from source"
    found["hourly_row_counts"] = f"{source} select day, hour, count(*) as rows from source group by 1, 2"
    found["distinct_hours"] = f"{source} select distinct cast(hour as int) as hour from source"
    found["channel_enriched"] = f"{_from('platform', False)} select * from platforms"
    found["channel_ip_enriched"] = (
        f"{_from('area', False)} select eventId as eventName, deviceNum, customerId, sessionId, "
        "serverTime, platform, app_channel, traffic, ipProvince, ipCity, ipArea from areas")
    found["session_hours"] = (
        f"{_with(False, _sessions(False))} select *, substr(startTime, 12, 2) as hour from visits")
    found["session_hours_ref"] = (
        f"{_with(True, _sessions(True), _bounds('0'))} select visits.*, "
        "lpad(cast(h as varchar), 2, '0') as hour from visits "
        "join bounds b on b.day = visits.day and startTime between lo and hi")
    found["log_hours"] = f"{source} select reqSerial, serverTime, day, hour from source"
    found["log_hours_ref"] = (
        f"{_with(True, _bounds('-0'))} select s.reqSerial, s.serverTime, s.day, "
        "lpad(cast(h as varchar), 2, '0') as hour from source s "
        "join bounds b on b.day = s.day and serverTime between lo and hi")
    found["members_by_region_unfiltered"] = (
        f"{_from('area', False)} select count(distinct customerId) as customer_all, "
        "ipCity, ipProvince from areas group by ipCity, ipProvince")
    found["province_counts"] = (
        f"{_from('area', False)} select ipProvince as province, count(*) as counts "
        "from areas group by 1")
    found["json_key_values"] = (
        f"{_json()} select event_id, cast(position as int) as position, p.key as key, "
        "p.value as value from pairs")
    found["json_report_record"] = f"{_json()} select event_id, " + ", ".join(
        f"arg_max(p.value, position) filter (where p.key = '{f}') as {f}" for f in REPORT_FIELDS
    ) + " from pairs group by event_id"
    found["table_day"] = f"{source} select * from source where day = '{DAY}'"
    found["table_history"] = (
        f"{source} select day, count(*) as rows, count(distinct sessionId) as sessions "
        "from source group by day")
    found["table_hours"] = f"{source} select distinct day, cast(hour as int) as hour from source"
    raw = _LINES[:_LINES.rindex("cells as")]
    found["clean_logs_lenient_ref"] = f"with {raw}{_IMPOSSIBLE}, {_source(True, _CARRIED)} select * from source"
    skewed = """skewed as (select * replace (
        case when cast(substr(reqSerial, 2) as bigint) % 3 = 0 then '10.1.2.3' else ip end as ip,
        case when cast(substr(reqSerial, 2) as bigint) % 3 = 0 then '01001002' else channelForm end as channelForm)
      from source)"""
    found["enriched_shuffled_skew"] = (
        f"{_with(False, skewed, _PLATFORM.replace('from source s', 'from skewed s'), _area(False))} "
        "select eventId as eventName, deviceNum, customerId, sessionId, "
        "serverTime, platform, app_channel, traffic, ipProvince, ipCity, ipArea from areas")
    found["text_table_loaded"] = """
        select case when bad then cast(null as bigint) else event_id end as id,
          case when not bad then 'n,' || user_id end as name,
          case when not bad then cast(ts as date) end as day,
          case when bad then event_id || ',"n,' || user_id || '",' || case when event_id % 13 = 0 then 'soon'
            when event_id % 17 = 0 then '2024-02-30' else strftime(ts, '%Y-%m-%d') end
            || case when event_id % 19 = 0 then ',more' else '' end end as line
        from (select *, event_id % 13 = 0 or event_id % 17 = 0 or event_id % 19 = 0 as bad from events)"""
    found["json_scan"] = """
        select case when bad then null else event_id end as id, case when not bad then event_type end as kind,
          case when not bad and event_id % 2 = 0 then user_id end as user,
          case when not bad and event_id % 2 = 1 then event_id / 2 end as size,
          case when not bad then strftime(ts, '%Y-%m-%d') end as day,
          case when bad then substr('{"id":' || event_id || ',"kind":"' || event_type, 1, 12) end as bad_line
        from (select *, event_id % 23 = 0 as bad from events)"""
    found["clean_twice"] = found["clean_logs"]
    found["table_rerun"] = found["table_history"]
    found["members_incremental"] = _metric("daily_members", METRICS["daily_members"], False)
    found["enriched_from_files"] = found["enriched_shuffled"] = found["channel_ip_enriched"]
    found["rejected_by_reason_bad_time"] = (
        f"with {_LINES} select case when r = 'kept' and cast(substr(f[1], 2) as bigint) % 59 = 0 "
        f"then 'bad_time' else r end as reason, count(*) as lines "
        f"from (select f, {_reject(False)} as r from cells) group by 1")
    hours = "[8, -5, 9, -7, 0, 3][cast(substr(reqSerial, 2) as bigint) % 6 + 1]"
    found["clean_logs_zones"] = (
        f"{source} select reqSerial, strftime(strptime(serverTime, '%Y-%m-%d-%H:%M:%S') "
        f"+ to_hours(8 - {hours}), '%Y-%m-%d-%H:%M:%S') as serverTime from source")
    found["json_bad_objects"] = "select event_id from events where event_id % 97 = 0 or event_id % 89 = 0"
    found["members_as_of"] = (
        f"{source} select count(distinct customerId) filter (day = '{DAY}') as uv_act, "
        f"count(distinct customerId) filter (day = '{DAY}' and eventName = 'e_l') as uv_new, "
        f"count(distinct customerId) filter (day <= '{AS_OF}') as uv_all, '{DAY}' as day "
        "from source where customerId <> '-1'")
    found["members_rerun"] = (
        f"{source} select count(distinct customerId) filter (day = '{DAY}') as uv_act, "
        f"count(distinct customerId) filter (day = '{DAY}' and eventName = 'e_l') as uv_new, "
        f"count(distinct customerId) as uv_all, '{DAY}' as day from source "
        f"where customerId <> '-1' and (day <> '{AS_OF}' or right(reqSerial, 1) < '3')")
    for name in ("area", "platform"):
        found[f"{name}_grouping_sets"] = _metric_set(name)
    found["area_metric_set"] = _metric_set("area")
    found["platform_metric_set"] = _metric_set("platform")
    for name, metric in METRICS.items():
        found[name] = _metric(name, metric, False)
        if len(metric.keys) == 1:
            found[f"{name}_ref"] = _metric(name, metric, True)
    return found
