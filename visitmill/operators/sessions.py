"""Session summaries: first and last event, and the number of different pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.functions.text import row_token
from visitmill.schema import INTENDED, SOURCE_COLUMNS, check_semantics

_TIME_TOKEN = 12


def session_summary(source: DataFrame, semantics: str = INTENDED) -> DataFrame:
    """One row per session and day; sessions are cut at midnight.

    One aggregate, which Spark runs by (session, day, page) first and by (session, day)
    then, combining before each shuffle: a session with a large part of the log is spread
    over its pages, and no list of its events is built. Events at the same time are
    ordered by request number.

    Reference mode orders by the 13th comma token of the printed row, which is another
    field as soon as an earlier one contains a comma.
    """
    reference = check_semantics(semantics)
    order = "serverTime, reqSerial"
    if reference:
        order = f"{row_token(SOURCE_COLUMNS, _TIME_TOKEN)} as order, reqSerial, serverTime"
    events = source.selectExpr(
        "sessionId", "day", "currentUrl",
        f"struct({order}, deviceNum, customerId, currentUrl) as event")
    sessions = events.groupBy("sessionId", "day").agg(
        F.min("event").alias("first"), F.max("event").alias("last"),
        # A missing page counts as one page.
        F.expr("count(distinct currentUrl) + max(int(currentUrl is null)) as pages"))
    return sessions.selectExpr(
        "first.deviceNum as deviceNum", "first.customerId as customerId",
        "sessionId as sessionID", "first.serverTime as startTime", "last.serverTime as endTime",
        "first.currentUrl as entryPage", "last.currentUrl as leavePage",
        f"cast(pages as {'string' if reference else 'bigint'}) as visitPageNum", "day")
