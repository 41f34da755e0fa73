"""Raw log lines to the clean 32-column source table. One narrow stage, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.functions.text import contains_any, evaluate_once, tab_fields
from visitmill.functions.times import DEFAULT_ZONE, DEFAULT_ZONES, log_time
from visitmill.schema import INTENDED, MISSING, RAW_FIELDS, TEST_URLS, check_semantics

_FIELDS = "fields"


def _field(name: str) -> str:
    return f"get({_FIELDS}, {RAW_FIELDS.index(name)})"


def _missing(name: str) -> str:
    return f"{_field(name)} = '{MISSING}'"


def _reject_rules(test_urls: Sequence[str], reference: bool) -> dict[str, str]:
    """Reasons to drop a line, in the order in which they are tried."""
    rules = {
        "arity": f"size({_FIELDS}) <> {len(RAW_FIELDS)}",
        "identity": f"({_missing('deviceNum')} and {_missing('customerId')})",
        "session": _missing("sessionId"),
        "server_time": _missing("serverTime"),
        "current_url": contains_any(_field("currentUrl"), test_urls),
        "previous_url": contains_any(_field("previousUrl"), test_urls),
    }
    if reference:
        # The earlier job loses these rows by accident.
        rules["client_time"] = _missing("clientTime")
    return rules


def clean_logs(
    lines: DataFrame,
    semantics: str = INTENDED,
    test_urls: Sequence[str] = TEST_URLS,
    zones: Mapping[str, str] = DEFAULT_ZONES,
    zone: str = DEFAULT_ZONE,
    on_bad_time: str = "fail",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Filter raw lines (column `value`), reformat their times, name their fields.

    Columns of `lines` named in `keep` stay, behind the others.
    """
    reference = check_semantics(semantics)
    rejected = " or ".join(_reject_rules(test_urls, reference).values())

    def readable(name: str) -> str:
        # The earlier job's parser carries impossible dates over.
        return log_time(_field(name), zones, zone, on_bad_time, lenient=reference)

    if reference:
        # Both time texts are replaced wherever they occur in the line.
        split = evaluate_once(lines, tab_fields("value"), _FIELDS, "value", *keep)
        timed = evaluate_once(
            split.where(f"not ({rejected})"),
            f"array({readable('clientTime')}, {readable('serverTime')})", "times",
            "value", _FIELDS, *keep)
        if on_bad_time == "drop":
            timed = timed.where("times[0] is not null and times[1] is not null")
        replaced = (f"replace(replace(value, {_field('clientTime')}, times[0]), "
                    f"{_field('serverTime')}, times[1])")
        timed, new = evaluate_once(timed, tab_fields(replaced), _FIELDS, *keep), {}
    else:
        split = evaluate_once(lines, tab_fields("value"), _FIELDS, *keep)
        # Only the server time is fixed here: `day` is derived from it, and filters on it
        # must not parse it again. The client time goes away when nobody reads it.
        timed = evaluate_once(split.where(f"not ({rejected})"), readable("serverTime"), "server",
                              _FIELDS, *keep)
        client = (f"case when {_missing('clientTime')} then '{MISSING}' "
                  f"else {readable('clientTime')} end")
        if on_bad_time == "drop":
            # An event is not lost for its client's clock.
            timed = timed.where("server is not null")
            client = f"coalesce({client}, '{MISSING}')"
        new = {"clientTime": client, "serverTime": "server"}
    named = timed.selectExpr(*[f"{new.get(n, _field(n))} as {n}" for n in RAW_FIELDS], *keep)
    return named.selectExpr(*RAW_FIELDS, "substr(serverTime, 1, 10) as day",
                            "substr(serverTime, 12, 2) as hour", *keep)


def rejected_by_reason(
    lines: DataFrame, semantics: str = INTENDED, test_urls: Sequence[str] = TEST_URLS,
    zones: Mapping[str, str] = DEFAULT_ZONES, zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Count the raw lines by the first rule that drops them; the rest are `kept`.

    `bad_time` counts the lines whose times `on_bad_time="drop"` drops and the default stops at.
    """
    reference = check_semantics(semantics)
    rules = _reject_rules(test_urls, reference)
    times = ("serverTime", "clientTime") if reference else ("serverTime",)
    rules["bad_time"] = " or ".join(
        f"{log_time(_field(name), zones, zone, 'drop', lenient=reference)} is null" for name in times)
    steps = " ".join(f"when {rule} then '{name}'" for name, rule in rules.items())
    return (evaluate_once(lines, tab_fields("value"), _FIELDS)
            .selectExpr(f"case {steps} else 'kept' end as reason")
            .groupBy("reason").agg(F.count(F.lit(1)).alias("lines")))


def cleaned_lines(source: DataFrame) -> DataFrame:
    """Clean rows as tab-separated text, for a text export."""
    return source.select(F.concat_ws("\t", *RAW_FIELDS).alias("value"))


def hourly_row_counts(source: DataFrame) -> DataFrame:
    return source.groupBy("day", "hour").agg(F.count(F.lit(1)).alias("rows"))


def distinct_hours(source: DataFrame) -> DataFrame:
    """Ascending hours of day that occur in a batch: at most 24 rows, hence one sort task."""
    return (source.select(F.col("hour").cast("int").alias("hour")).distinct().orderBy("hour"))
