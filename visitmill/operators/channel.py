"""Channel code enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.functions.times import day_of, hour_of
from visitmill.operators.lookup import BROADCAST_BYTES, lookup_join, measure
from visitmill.schema import MISSING, PLATFORM_COLUMNS

_ATTRIBUTES = ("platform", "app_channel", "traffic")


def first_rules(rules: DataFrame) -> DataFrame:
    """One rule per code: the first line wins when a code is repeated."""
    return rules.groupBy("channelFrom").agg(
        F.min_by(F.struct(*_ATTRIBUTES), "line_no").alias("rule"))


def with_channel(
    frame: DataFrame, rules: DataFrame, code: str = "channelForm",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add platform, app_channel and traffic; `-1` stays `-1`, an unknown code gives ''."""
    lookup = first_rules(rules).withColumnRenamed("channelFrom", code)
    fits = measure(rules.drop("line_no")).fits(broadcast_bytes)
    joined = lookup_join(frame, lookup, code, fits)
    return joined.selectExpr(*frame.columns, *[
        f"case when {code} = '{MISSING}' then '{MISSING}' else coalesce(rule.{a}, '') end as {a}"
        for a in _ATTRIBUTES])


def platform_table(
    source: DataFrame, rules: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of the platform table, in table order."""
    seven = source.selectExpr(
        "eventName as eventId", "deviceNum", "customerId", "sessionId", "serverTime", "ip",
        "channelForm as channelFrom")
    return (with_channel(seven, rules, "channelFrom", broadcast_bytes)
            .withColumns({"day": day_of(F.col("serverTime")), "hour": hour_of(F.col("serverTime"))})
            .select(*PLATFORM_COLUMNS))
