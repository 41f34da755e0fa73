"""Rule files: channel codes (tab-separated) and IP ranges (pipe-separated)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Column, position and type in the files: fixed values.
_CHANNEL_CELLS = (
    ("channelFrom", 0, "string"), ("app_channel", 1, "string"),
    ("platform", 2, "string"), ("traffic", 3, "string"),
)
_IP_CELLS = (
    ("startNum", 2, "bigint"), ("endNum", 3, "bigint"), ("province", 6, "string"),
    ("city", 7, "string"), ("area", 8, "string"), ("operator", 9, "string"),
)


def _read_rules(
    spark: SparkSession, path: str, sep: str, layout: tuple, on_bad_rule: str, *extra: Column
) -> DataFrame:
    """Cells of a delimited file. A line with a missing or unreadable cell fails or is dropped."""
    if on_bad_rule not in ("fail", "drop"):
        raise ValueError(f"on_bad_rule must be 'fail' or 'drop', got {on_bad_rule!r}")
    cells = F.split(F.rtrim("value", F.lit(sep)), f"[{sep}]")
    lines = spark.read.text(path).select("value", *extra, F.explode(F.array(cells)).alias("cells"))
    cell = {name: F.get("cells", F.lit(at)).try_cast(kind) for name, at, kind in layout}
    if on_bad_rule == "drop":
        lines = lines.where(reduce(lambda a, b: a & b, [c.isNotNull() for c in cell.values()]))
    else:
        complaint = F.raise_error(F.concat(F.lit("bad rule line: "), F.col("value")))
        cell = {name: F.coalesce(cell[name], complaint.cast(kind)) for name, _, kind in layout}
    kept = [c for c in lines.columns if c not in ("value", "cells")]
    return lines.select(*kept, *[c.alias(name) for name, c in cell.items()])


def read_channel_rules(spark: SparkSession, path: str, on_bad_rule: str = "fail") -> DataFrame:
    """Channel rules with `line_no`, a value that increases in file order.

    It is built from file, block and row position, because the blocks of a file are not
    handed out in order.
    """
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))
    return _read_rules(spark, path, "\t", _CHANNEL_CELLS, on_bad_rule, position.alias("line_no"))


def read_ip_rules(spark: SparkSession, path: str, on_bad_rule: str = "fail") -> DataFrame:
    return _read_rules(spark, path, "|", _IP_CELLS, on_bad_rule)
