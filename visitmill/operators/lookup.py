"""Left lookup joins that broadcast only behind a size check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from visitmill.sinks.staging import stage

# Estimated bytes of a lookup table up to which it is copied to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64
# Items that the sketch of frequent keys follows at least, and per shuffle partition.
SKETCH_ITEMS = 10_000
SKETCH_ITEMS_PER_SHARE = 16
# What the sketch can follow at most; it can name a tenth of that.
MOST_SKETCH_ITEMS = 1_000_000


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, limit: int = BROADCAST_BYTES) -> bool:
        return self.bytes <= limit


def size_columns(frame: DataFrame) -> list[Column]:
    """Aggregates for the row count and the in-memory size estimate of a frame."""
    width = " + ".join([str(ROW_OVERHEAD_BYTES)] + [
        f"coalesce(octet_length({name}), 0)" if kind == "string" else "8"
        for name, kind in frame.dtypes])
    return [F.expr("count(1) as rows"), F.expr(f"coalesce(sum(bigint({width})), 0) as bytes")]


def measure(frame: DataFrame) -> Size:
    """Row count and estimated size; one partial aggregate, one row to the driver."""
    row = frame.agg(*size_columns(frame)).first()
    return Size(row["rows"], row["bytes"])


def staged_with_hot_keys(left: DataFrame, key: str) -> tuple[DataFrame, list]:
    """Write the left side once, and name the keys with more than a shuffle partition's share.

    A sketch of frequent items watches the rows while they are written, so they are computed
    once and no key is counted by a shuffle. No more keys than partitions can be that
    frequent. The sketch errs by a fraction of such a share, and an error only salts a key
    more or less than needed: the joined rows are the same.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(MOST_SKETCH_ITEMS, max(SKETCH_ITEMS, SKETCH_ITEMS_PER_SHARE * tasks))
    named = min(tasks, MOST_SKETCH_ITEMS // 10)
    seen = Observation()
    staged = stage(left.observe(
        seen, F.expr(f"approx_top_k(`{key}`, {named}, {tracked})").alias("top"),
        F.count(F.lit(1)).alias("rows")))
    rows = seen.get["rows"]
    return staged, [item["item"] for item in seen.get["top"] or []
                    if item["item"] is not None and item["count"] * tasks > rows]


def lookup_join(
    left: DataFrame, lookup: DataFrame, key: str, fits: bool, hot: Sequence | None = None
) -> DataFrame:
    """Left join on a key that is unique in `lookup`.

    When the lookup fits it is broadcast and the left side does not move. Otherwise
    both sides are shuffled. A hot key is spread over all partitions by a hash of the whole
    row (repeatable when a task runs again), and only its lookup row is repeated for that.
    `hot` comes from `staged_with_hot_keys`, which is called here for a left side that
    wasn't written yet. Identical rows share a salt; adaptive skew-join handling splits those.
    """
    if fits:
        return left.join(F.broadcast(lookup), key, "left")
    if hot is None:
        left, hot = staged_with_hot_keys(left, key)
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col(key).isin(list(hot)) if hot else F.lit(False)
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(tasks)).cast("int")
    salted = left.withColumn("_salt", F.when(is_hot | F.col(key).isNull(), salt).otherwise(0))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(tasks - 1))).otherwise(F.array(F.lit(0)))
    repeated = lookup.withColumn("_salt", F.explode(salts))
    joined = salted.join(repeated.hint("shuffle_merge"), [key, "_salt"], "left")
    return joined.select(*left.columns, *[c for c in lookup.columns if c != key])
