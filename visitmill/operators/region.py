"""IP range to region enrichment: a range join turned into bucket equi-joins.

A rule [start, end] goes to the finest of a few bucket widths at which it touches no
more than two buckets. So every rule becomes at most two rows however wide it is, and,
rules being disjoint, a bucket holds at most a few hundred candidates however dense
the rules are. A probe looks up one bucket per width in use (two or three for real
rule sets) and keeps the candidate whose range holds it. There is no nested loop, and
no rule or address range needs special treatment.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.functions.ip import ip_number, ip_parts
from visitmill.functions.text import evaluate_once
from visitmill.functions.times import day_of, hour_of
from visitmill.operators.channel import with_channel
from visitmill.operators.lookup import (
    BROADCAST_BYTES, lookup_join, size_columns, staged_with_hot_keys)
from visitmill.schema import AREA_COLUMNS, INTENDED, MISSING, check_semantics

# Bucket widths as powers of two. At 63 every address of one sign shares a bucket.
SHIFTS = (8, 16, 24, 32, 40, 48, 56, 63)
_REGION = ("province", "city", "area", "operator")
_NO_REGION = f"cast(null as struct<{','.join(f'{c}:string' for c in _REGION)}>)"


@dataclass(frozen=True)
class RegionIndex:
    """Rules prepared for bucket lookup.

    `entries` has columns shift, bucket, startNum, endNum, region; `shifts` are the
    widths in use; `small` are those whose entries may be broadcast together.
    """

    entries: DataFrame
    shifts: tuple[int, ...]
    small: frozenset[int]

    @property
    def fits(self) -> bool:
        return self.small == frozenset(self.shifts)

    def at(self, shift: int) -> DataFrame:
        return self.entries.where(f"shift = {shift}").selectExpr(
            "bucket as _bucket", "startNum as _start", "endNum as _end",
            f"region as _region{shift}")


def _rule_shift() -> str:
    """The finest width at which a rule touches no more than two buckets."""
    *fine, widest = SHIFTS
    steps = " ".join(
        f"when shiftright(endNum, {s}) - shiftright(startNum, {s}) <= 1 then {s}" for s in fine)
    return f"case {steps} else {widest} end"


def region_index(
    rules: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> RegionIndex:
    """Prepare rules, which must be disjoint. At most one small row per width reaches the driver."""
    shifted = rules.withColumn("shift", F.expr(_rule_shift()))
    per_shift = shifted.groupBy("shift").agg(
        *size_columns(rules),
        F.expr("count_if(coalesce(endNum < startNum, true)) as bad"),
    ).collect()
    if any(row["bad"] for row in per_shift):
        raise ValueError("IP rules with a missing bound or with start above end")

    entries = shifted.selectExpr(
        "shift",
        "explode(array_distinct(array(shiftright(startNum, shift), shiftright(endNum, shift))))"
        " as bucket",
        "startNum", "endNum", f"struct({', '.join(_REGION)}) as region")
    # Wide buckets first: they hold few rules, but all addresses of a shuffled wide
    # bucket would meet in one task.
    small, room = set(), broadcast_bytes
    for row in sorted(per_shift, key=lambda row: -row["shift"]):
        room -= 2 * row["bytes"]
        if room < 0:
            break
        small.add(row["shift"])
    shifts = tuple(sorted(row["shift"] for row in per_shift))
    index = RegionIndex(entries, shifts, frozenset(small))
    if overlapping_rules(rules, index).limit(1).count():
        raise ValueError("IP rules overlap: an address may have more than one region")
    return index


def overlapping_rules(rules: DataFrame, index: RegionIndex) -> DataFrame:
    """Start addresses that lie in more than one rule; empty when rules are disjoint.

    Two ranges overlap exactly when one of them holds the other's start, so probing
    the rules with their own starts finds any overlap without sorting them in one task.
    """
    starts = rules.select(F.col("startNum").alias("_number"))
    hits = [_probe(starts, index, s, "inner").select("_number") for s in index.shifts]
    merged = hits[0] if hits else starts.limit(0)
    for hit in hits[1:]:
        merged = merged.unionByName(hit)
    return merged.groupBy("_number").agg(F.count(F.lit(1)).alias("rules")).where("rules > 1")


def _probe(frame: DataFrame, index: RegionIndex, shift: int, how: str) -> DataFrame:
    entries = index.at(shift)
    side = F.broadcast(entries) if shift in index.small else entries.hint("shuffle_merge")
    held = F.expr(f"shiftright(_number, {shift}) = _bucket and _number between _start and _end")
    return frame.join(side, held, how).drop("_bucket", "_start", "_end")


def _resolve(frame: DataFrame, index: RegionIndex) -> DataFrame:
    """Add `_region` (NULL on a miss) to a frame with `_number`."""
    probed = frame
    for shift in index.shifts:
        probed = _probe(probed, index, shift, "left")
    found = ", ".join([f"_region{s}" for s in index.shifts] + [_NO_REGION])
    return probed.selectExpr(*frame.columns, f"coalesce({found}) as _region")


def with_region(
    frame: DataFrame, index: RegionIndex, ip: str = "ip", semantics: str = INTENDED
) -> DataFrame:
    """Add ipProvince, ipCity, ipArea and operator; each is `-1` on a miss.

    Rules that fit are broadcast and the rows never move. Beyond that only the distinct
    addresses meet the rules, and the answer is joined back with salted keys.
    """
    reference = check_semantics(semantics)
    split = evaluate_once(frame, ip_parts(ip), "_parts", *frame.columns)
    numbered = split.selectExpr(
        *frame.columns, f"{ip_number('_parts', ip, strict=reference)} as _number")
    if index.fits:
        resolved = _resolve(numbered, index)
    else:
        numbered, hot = staged_with_hot_keys(numbered, "_number")
        addresses = numbered.select("_number").where("_number is not null").distinct()
        known = _resolve(addresses, index).where("_region is not null")
        resolved = lookup_join(numbered, known, "_number", fits=False, hot=hot)

    # An existing rule file never yields a NULL city, so the fallback to the area only
    # happens in the intended reading, where an empty city counts as missing.
    city = "_region.city" if reference else "coalesce(nullif(_region.city, ''), _region.area)"
    columns = {
        "ipProvince": "_region.province",
        "ipCity": city,
        "ipArea": "_region.area",
        "operator": "_region.operator",
    }
    return resolved.selectExpr(*frame.columns, *[
        f"case when _region is null then '{MISSING}' else {value} end as {name}"
        for name, value in columns.items()])


def area_table(
    platform: DataFrame, index: RegionIndex, semantics: str = INTENDED
) -> DataFrame:
    """Rows of the area table, in table order, from rows of the platform table."""
    eight = platform.select("eventId", "deviceNum", "customerId", "sessionId", "serverTime",
                            "ip", "app_channel")
    return (with_region(eight, index, "ip", semantics)
            .withColumns({"day": day_of(F.col("serverTime")), "hour": hour_of(F.col("serverTime"))})
            .select(*AREA_COLUMNS))


def enriched_logs(
    source: DataFrame, channel_rules: DataFrame, index: RegionIndex, semantics: str = INTENDED,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Both lookups over clean rows, without a table in between; one narrow stage if both fit."""
    columns = ("eventName", "deviceNum", "customerId", "sessionId", "serverTime")
    both = with_region(
        with_channel(source.select(*columns, "channelForm", "ip"), channel_rules,
                     broadcast_bytes=broadcast_bytes),
        index, "ip", semantics)
    return both.select(*columns, "platform", "app_channel", "traffic",
                       "ipProvince", "ipCity", "ipArea")


def region_counts(area: DataFrame) -> DataFrame:
    """Rows per province."""
    return area.groupBy(F.col("ipProvince").alias("province")).agg(
        F.count(F.lit(1)).alias("counts"))
