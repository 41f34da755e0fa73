"""Daily distinct-visitor and distinct-member metrics, in total and by dimension.

A visitor is a device seen without a member id, a member is a member id. All metrics
come from one shape:

1. identity facts: one row per (keys, visitor or member, id), with flags for "on the
   day" and "new on the day". This removes duplicates with map-side combining, and
   spreads any hot key over its ids.
2. totals: one row per key, counting ids by flag.

So a table is scanned once per metric set rather than once per distinct count, and no
row is multiplied, as Spark does for several distinct counts in one aggregate. Facts by
fine keys roll up exactly to coarser ones, so all metrics of a table share one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.functions.text import literal
from visitmill.schema import INTENDED, MISSING, NEW_USER_EVENT, check_semantics
from visitmill.sinks.staging import stage

VISITOR = "visitor"
MEMBER = "member"


@dataclass(frozen=True)
class Metric:
    """A metric table: who is counted, in which input table, by which columns."""

    table: str
    family: str
    source: str
    keys: tuple[tuple[str, str], ...] = ()

    @property
    def inputs(self) -> tuple[str, ...]:
        return tuple(k for k, _ in self.keys)


_PROVINCE = (("ipProvince", "province"),)
_CITY = (("ipProvince", "province"), ("ipCity", "city"))
_APP = (("app_channel", "app_channel"),)
_PLATFORM = (("platform", "platform"),)
_TRAFFIC = (("traffic", "traffic"),)

# Table names and column names are fixed values: dashboards read them.
METRICS: dict[str, Metric] = {
    "daily_users": Metric("dw_user_visit_daliy_act", VISITOR, "source"),
    "daily_visitors": Metric("dw_visitor_act_daliy_act", VISITOR, "source"),
    "daily_members": Metric("dw_customer_act_daliy_act", MEMBER, "source"),
    "visitors_by_province": Metric("dw_visitor_act_daliy_province", VISITOR, "area", _PROVINCE),
    "visitors_by_city": Metric("dw_visitor_act_daliy_city", VISITOR, "area", _CITY),
    "visitors_by_area_channel": Metric("dw_visitor_act_daliy_app_channel", VISITOR, "area", _APP),
    "members_by_province": Metric("dw_customer_act_daliy_province", MEMBER, "area", _PROVINCE),
    "members_by_city": Metric("dw_customer_act_daliy_city", MEMBER, "area", _CITY),
    "members_by_area_channel": Metric("dw_customer_act_daliy_app_channel", MEMBER, "area", _APP),
    "visitors_by_platform": Metric("dw_visitor_act_daliy_platform", VISITOR, "platform", _PLATFORM),
    "visitors_by_channel": Metric("dw_visitor_act_daliy_channel", VISITOR, "platform", _APP),
    "visitors_by_traffic": Metric("dw_visitor_act_daliy_traffic", VISITOR, "platform", _TRAFFIC),
    "members_by_platform": Metric("dw_customer_act_daliy_platform", MEMBER, "platform", _PLATFORM),
    "members_by_channel": Metric("dw_customer_act_daliy_channel", MEMBER, "platform", _APP),
    "members_by_traffic": Metric("dw_customer_act_daliy_traffic", MEMBER, "platform", _TRAFFIC),
}
EVENT_COLUMN = {"source": "eventName", "area": "eventId", "platform": "eventId"}


def identity_facts(
    frame: DataFrame, keys: tuple[str, ...], day: str, event: str,
    families: tuple[str, ...], as_of: str | None = None,
) -> DataFrame:
    """Phase 1. All-time members need the history (up to `as_of`), all else only the day."""
    is_day, member = f"day = {literal(day)}", f"customerId <> '{MISSING}'"
    if MEMBER not in families:
        rows = frame.where(f"{is_day} and customerId is not null")
    elif VISITOR not in families:
        rows = frame.where(member)
    else:
        rows = frame.where(f"{member} or ({is_day} and customerId = '{MISSING}')")
    on_day = f"day <=> {literal(day)}"
    in_history = "true" if as_of is None else f"coalesce(day <= {literal(as_of)}, false)"
    if as_of is not None:
        rows = rows.where(f"{is_day} or {in_history}")
    flagged = rows.selectExpr(
        *keys, f"{member} as is_member",
        f"case when {member} then customerId else deviceNum end as id",
        f"{on_day} as on_day", f"{on_day} and {event} <=> '{NEW_USER_EVENT}' as is_new",
        f"{in_history} as in_history")
    return roll_up(flagged, keys)


def roll_up(facts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Facts by a subset of their keys."""
    return facts.groupBy(*keys, "is_member", "id").agg(
        F.max("on_day").alias("on_day"), F.max("is_new").alias("is_new"),
        F.max("in_history").alias("in_history"))


def totals(facts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Phase 2. The `has_` flags tell "no such rows" from "no ids in them"."""
    groups = {
        "visitors": "not is_member and on_day", "new_visitors": "not is_member and is_new",
        "members": "is_member and on_day", "new_members": "is_member and is_new",
        "any_members": "is_member and in_history",
    }
    counts = [f"count_if({rule} and id is not null) as {name}" for name, rule in groups.items()]
    flags = [f"coalesce(max({rule}), false) as has_{name}" for name, rule in groups.items()]
    return facts.groupBy(*keys).agg(*[F.expr(e) for e in counts + flags])


def available(semantics: str = INTENDED) -> list[str]:
    """The metrics of a reading. The reference one has no tables by province and city.

    There the counts are joined on the city name alone, so every province of a name meets
    every other: all pairs within a name, which is not built here.
    """
    reference = check_semantics(semantics)
    return [n for n, m in METRICS.items() if not (reference and m.keys == _CITY)]


def metric_table(
    frame: DataFrame, name: str, day: str, semantics: str = INTENDED, as_of: str | None = None
) -> DataFrame:
    """One metric table for one day, from its input table."""
    metric = METRICS[name]
    facts = identity_facts(frame, metric.inputs, day, EVENT_COLUMN[metric.source],
                           (metric.family,), as_of)
    return metric_from_facts(facts, name, day, semantics)


def set_keys(names: Sequence[str]) -> tuple[str, ...]:
    """The key columns that any of the metrics needs."""
    return tuple(dict.fromkeys(k for n in names for k in METRICS[n].inputs))


def metric_set(
    frame: DataFrame, source: str, day: str, semantics: str = INTENDED, as_of: str | None = None,
    names: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """All (or the named) metric tables of one input table from a single scan of it.

    The facts by all keys are written once to the shared folder; each table rolls them up.
    """
    if names is None:
        names = [n for n in available(semantics) if METRICS[n].source == source]
    families = tuple(dict.fromkeys(METRICS[n].family for n in names))
    facts = identity_facts(frame, set_keys(names), day, EVENT_COLUMN[source], families, as_of)
    return metric_set_from_facts(stage(facts), names, day, semantics)


def metric_set_from_facts(
    facts: DataFrame, names: Sequence[str], day: str, semantics: str = INTENDED
) -> dict[str, DataFrame]:
    return {
        n: metric_from_facts(roll_up(facts, METRICS[n].inputs), n, day, semantics) for n in names
    }


def metric_sets_at_once(
    frame: DataFrame, source: str, day: str, as_of: str | None = None,
) -> DataFrame:
    """All metric tables by keys of one input as one long table, from grouping sets.

    Columns metric, key1, key2, uv_act, uv_new and uv_all. The facts are rolled up to all
    sets of keys in one aggregate, in which a row is repeated for each set, and counted in a
    second one. Nothing is staged in between.
    """
    names = [n for n in available() if METRICS[n].source == source and METRICS[n].keys]
    keys = set_keys(names)
    sets = list(dict.fromkeys(METRICS[n].inputs for n in names))
    facts = identity_facts(frame, keys, day, EVENT_COLUMN[source], (VISITOR, MEMBER), as_of)
    # The sets with the rest of a row's identity; a bit for each key that isn't in it names a set.
    grouped = ", ".join(f"({', '.join([*s, 'is_member', 'id'])})" for s in sets)
    which_set = " + ".join(f"int(grouping({k})) * {1 << i}" for i, k in enumerate(keys))
    rolled = facts.sparkSession.sql(
        f"select {', '.join(keys)}, is_member, id, {which_set} as which, max(on_day) as on_day, "
        "max(is_new) as is_new, max(in_history) as in_history from {facts} "
        f"group by grouping sets ({grouped})", facts=facts)
    counted = totals(rolled, ("which", *keys))
    which = {s: sum(1 << i for i, k in enumerate(keys) if k not in s) for s in sets}
    entries = []
    for name in names:
        metric = METRICS[name]
        held = [F.col(k) for k in metric.inputs]
        key1, key2 = (held + [F.lit(None).cast("string")])[:2]
        if metric.family == VISITOR:
            rows, columns = "has_visitors or has_members", [_ACTIVE, _NEW, "cast(null as bigint) as uv_all"]
        else:
            rows, columns = "has_any_members or has_members", _MEMBERS
        # A row belongs to the set's tables whose rule it meets.
        entries.append(F.when(
            F.expr(f"which = {which[metric.inputs]} and ({rows})"),
            F.struct(F.lit(name).alias("metric"), key1.alias("key1"), key2.alias("key2"), *[F.expr(c) for c in columns])))
    return counted.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("row")).select("row.*")


def metric_from_facts(
    facts: DataFrame, name: str, day: str, semantics: str = INTENDED
) -> DataFrame:
    """Shape facts by exactly the keys of a metric into its table."""
    reference = check_semantics(semantics)
    metric = METRICS[name]
    if name not in available(semantics):
        raise ValueError(f"{name} has no {semantics} form: it joins on the city name alone; use {INTENDED!r}")
    counted = totals(facts, metric.inputs)
    if not metric.keys:
        rows, columns = "true", _GRAND_TOTALS[name]
    elif reference:
        # A NULL key matches nothing, so there every joined count is missing.
        matched = f"{metric.inputs[0]} is not null"
        rows, columns = {
            # Keys come from visitor rows only, and a count that exists turns the sum NULL.
            VISITOR: ("has_visitors", [
                f"case when not ({matched} and has_members) then visitors end as uv_act",
                f"case when not ({matched} and (has_new_visitors or has_new_members))"
                " then 0L end as uv_new"]),
            # The first and third label are exchanged, and a missing count is NULL.
            MEMBER: ("has_any_members", [
                "any_members as uv_act",
                f"case when {matched} and has_new_members then new_members end as uv_new",
                f"case when {matched} and has_members then members end as uv_all"]),
        }[metric.family]
    else:
        rows, columns = {
            VISITOR: ("has_visitors or has_members", [_ACTIVE, _NEW]),
            MEMBER: ("has_any_members or has_members", _MEMBERS),
        }[metric.family]
    return _finish(counted.where(rows), metric, day, columns)


_ACTIVE = "visitors + members as uv_act"
_NEW = "new_visitors + new_members as uv_new"
_MEMBERS = ["members as uv_act", "new_members as uv_new", "any_members as uv_all"]
_GRAND_TOTALS = {
    "daily_users": ["visitors + members as UV"],
    "daily_visitors": [_ACTIVE, _NEW],
    "daily_members": _MEMBERS,
}


def _finish(frame: DataFrame, metric: Metric, day: str, columns: list[str]) -> DataFrame:
    names = [f"{k} as {out}" for k, out in metric.keys]
    return frame.selectExpr(*columns, *names, f"{literal(day)} as day")


def members_by_region_unfiltered(area: DataFrame) -> DataFrame:
    """Distinct member ids per province and city over all days, the `-1` id included."""
    return area.groupBy("ipCity", "ipProvince").agg(
        F.count_distinct("customerId").alias("customer_all"))
