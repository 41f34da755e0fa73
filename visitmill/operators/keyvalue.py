"""JSON objects that hold arrays of {key, value} pairs.

A text is parsed once, into a VARIANT, and the sections are taken from that. What is no JSON
gives none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill.functions.text import evaluate_once, literal
from visitmill.schema import REPORT_FIELDS

_PAIRS = "array<struct<key:string,value:string>>"


def _sections(frame: DataFrame, json: str, section: str) -> DataFrame:
    """The frame's columns with `_held`: whether a text is JSON, the section, and its pairs.

    The pairs are NULL if the section isn't there or holds something else.
    """
    quote = "'" if '"' in section else '"'
    path = literal(f"$[{quote}{section}{quote}]")
    parsed = evaluate_once(frame, f"try_parse_json(`{json}`)", "_object", *[f"`{c}`" for c in frame.columns])
    return evaluate_once(
        parsed, f"named_struct('json', _object is not null, 'section', variant_get(_object, {path}, 'variant'), "
                f"'parts', try_variant_get(_object, {path}, 'array<variant>'), "
                f"'pairs', try_variant_get(_object, {path}, '{_PAIRS}'))",
        "_held", *[f"`{c}`" for c in frame.columns])


def _is_bad(json: str) -> Column:
    """Whether a text is no JSON, or has something else than objects in the section's array.

    An absent or null section and a NULL text are not bad: they have no pairs.
    """
    return F.expr(
        f"`{json}` is not null and (not _held.json or (_held.pairs is null and _held.section is not null "
        "and not is_variant_null(_held.section)) or exists(zip_with(_held.parts, _held.pairs, "
        "(part, pair) -> pair is null and part is not null and not is_variant_null(part)), x -> x))")


def _pairs(frame: DataFrame, json: str, section: str, on_bad_json: str) -> tuple[DataFrame, Column]:
    """A frame with the parsed objects, and the column of a section's pairs in it."""
    if on_bad_json not in ("fail", "drop"):
        raise ValueError(f"on_bad_json must be 'fail' or 'drop', got {on_bad_json!r}")
    held = _sections(frame, json, section)
    if on_bad_json == "drop":
        return held, F.col("_held.pairs")
    message = F.concat(F.lit(f"no pairs in section {section}: "), F.substring(json, 1, 200))
    return held, F.when(_is_bad(json), F.raise_error(message)).otherwise(F.col("_held.pairs"))


def bad_objects(frame: DataFrame, json: str, section: str) -> DataFrame:
    """The rows that `on_bad_json="drop"` gives no pairs for although they hold something."""
    return _sections(frame, json, section).where(_is_bad(json)).select(*frame.columns)


def key_values(
    frame: DataFrame, json: str, section: str, on_bad_json: str = "fail"
) -> DataFrame:
    """One row per pair of a section: position, key and value, in array order.

    Bad objects fail the query, or have no rows with `drop`; `bad_objects` finds them.
    """
    keep = [c for c in frame.columns if c != json]
    held, pairs = _pairs(frame, json, section, on_bad_json)
    return held.select(*keep, F.posexplode(pairs).alias("position", "pair")).select(
        *keep, "position", "pair.key", "pair.value")


def key_value_record(
    frame: DataFrame, json: str, section: str, fields: Sequence[str] = REPORT_FIELDS,
    on_bad_json: str = "fail",
) -> DataFrame:
    """One row per object: named fields from the pairs of a section, the last of a key wins.

    A projection, so the objects are not regrouped by a shuffle. Bad objects fail the
    query, or give a row of NULLs with `drop`.
    """
    keep = [c for c in frame.columns if c != json]
    held, pairs = _pairs(frame, json, section, on_bad_json)
    parsed = held.select(*keep, F.explode(F.array(pairs)).alias("_pairs"))

    def value(name: str) -> Column:
        same = F.expr(f"filter(_pairs, pair -> pair.key = {literal(name)})")
        return F.try_element_at(same, F.lit(-1))["value"].alias(name)

    return parsed.select(*keep, *[value(name) for name in fields])
