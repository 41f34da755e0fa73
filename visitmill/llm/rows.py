"""Rows of documents as join keys: an id with a hash of the text beside it.

Ids may be null or repeat; id and text hash together name a row, and equal rows share a name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill.sinks.staging import stage

# Buckets of keys by which rows that aren't looked for are told from the others.
BUCKETS = 1 << 20


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """(doc_id, text_key, *columns) of documents."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), *columns)


def text_key() -> Column:
    return F.xxhash64("text")


def fresh(frame: DataFrame, stem: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in frame.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def with_found(docs: DataFrame, found: DataFrame, column: str, how: str = "left") -> tuple[DataFrame, str]:
    """Join `found` (doc_id, text_key, column), unique in its key, to the rows of `docs`.

    Returns the joined frame, with the columns of `docs` and the new one, and its name. `how`
    is left, or left_anti for the rows of `docs` that aren't found (without the new column).

    Only rows of `docs` whose key falls into the bucket of some found one are shuffled.
    """
    found = stage(found)
    key, name, found_id, found_key = (
        fresh(docs, s) for s in ("_text_key", f"_{column}", "_found_id", "_found_key"))
    right = found.select(
        F.col("doc_id").alias(found_id), F.col("text_key").alias(found_key), F.col(column).alias(name))
    left = docs.withColumn(key, text_key())
    near, far = _dealt(left, [F.col("doc_id").cast("long"), F.col(key)], right, [found_id, found_key])
    joined = near.join(
        right, near["doc_id"].eqNullSafe(right[found_id]) & near[key].eqNullSafe(right[found_key]), how)
    kind = found.schema[column].dataType
    if how == "left":
        far = far.withColumn(name, F.lit(None).cast(kind))
    return joined.drop(found_id, found_key).unionByName(far).drop(key), name


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id isn't among `ids` (doc_id); rows without one stay.

    Only rows whose id falls into the bucket of some id that goes are shuffled.
    """
    gone = fresh(docs, "_gone")
    ids = stage(ids.select(F.col("doc_id").cast("long").alias(gone)).where(F.col(gone).isNotNull()).distinct())
    near, far = _dealt(docs, [F.col("doc_id").cast("long")], ids, [gone])
    return near.join(ids, near["doc_id"] == ids[gone], "left_anti").unionByName(far)


def near_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id falls into the bucket of some of `ids` (doc_id): those of
    all these ids, and a few others. No row moves."""
    return _dealt(docs, [F.col("doc_id").cast("long")], ids, ["doc_id"])[0]


def _dealt(
    left: DataFrame, key: list[Column], right: DataFrame, right_key: list[str]
) -> tuple[DataFrame, DataFrame]:
    """The rows of `left` in the buckets of some keys of `right`, and the others.

    The buckets, at most BUCKETS numbers, are broadcast; no row of `left` moves.
    """
    name = fresh(left, "_bucket")

    def bucket(columns: list) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS))

    buckets = F.broadcast(right.select(bucket(right_key).alias(name)).distinct())
    met = bucket(key) == buckets[name]
    return left.join(buckets, met, "left_semi"), left.join(buckets, met, "left_anti")
