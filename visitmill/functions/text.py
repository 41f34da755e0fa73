"""Text helpers: field splitting, containment, row rendering.

Functions take and give SQL expression text, for `selectExpr` and `F.expr`: a plan with
hundreds of expressions is then built in a few calls to the JVM instead of thousands.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(pairs: Mapping[str, str]) -> str:
    return f"map({', '.join(literal(x) for pair in pairs.items() for x in pair)})"


def tab_fields(line: str) -> str:
    """Split on tabs, ignoring empty fields at the end of the line.

    `split` keeps those, the log format does not count them: 31 fields with an
    empty last one are a valid 30-field line, 30 with an empty last one are not.
    """
    return f"split(trim(trailing '\t' from {line}), '\t')"


def evaluate_once(frame: DataFrame, value: str, name: str, *keep: str) -> DataFrame:
    """Evaluate an expression once per row and expose it as column `name`.

    A plain projection is copied into each later filter or projection that Catalyst
    merges with it, so one line would be split once per predicate. Nothing is merged
    across a generator, and a generator over a one-element array stays inside
    whole-stage codegen. It also starts a new generated method, which keeps each one
    below the 8000 bytes that the JVM is willing to compile.
    """
    return frame.selectExpr(*keep, f"explode(array({value})) as {name}")


def contains_any(value: str, needles: Iterable[str]) -> str:
    """True when any of the needles occurs in the value."""
    return "(" + " or ".join(["false"] + [f"contains({value}, {literal(n)})" for n in needles]) + ")"


def row_token(columns: Sequence[str], index: int) -> str:
    """The index-th comma token of a row printed as `[a,b,c]`, nulls as `null`."""
    cells = ", ".join(f"coalesce(cast({c} as string), 'null')" for c in columns)
    return f"get(split(concat('[', concat_ws(',', {cells}), ']'), ','), {index})"
