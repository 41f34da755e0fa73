"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.sinks.staging import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of an edge table (a, b) of longs; component is the least node.

    Large stars hang a node's greater neighbours on its least one, small stars its lesser
    neighbours, until nothing changes: a logarithmic number of rounds. The least neighbour is
    an aggregate that combines before its shuffle and returns by a join that adaptive
    execution may split, so a node with very many neighbours doesn't fill one task. Each
    round is written to the shared folder. Self loops, repeated edges and nulls are ignored.
    """
    pairs = stage(
        edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        .distinct())
    before = _state(pairs)
    while before[0]:
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        large = (
            _with_least(both).where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
            .distinct())
        down = large.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        small = _with_least(stage(down))
        pairs = stage(
            small.select(F.col("m").alias("lo"), F.col("v").alias("hi"))
            .unionByName(small.select(F.col("m").alias("lo"), F.col("u").alias("hi")))
            .where("lo <> hi").distinct())
        after = _state(pairs)
        if after == before:
            break
        before = after
    members = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return members.unionByName(
        pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def _with_least(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least, "u").select("u", "v", F.least("u", "least").alias("m"))


def _state(pairs: DataFrame) -> tuple:
    """Count and order-free checksums of the edges."""
    return tuple(pairs.agg(
        F.count("*"), F.bit_xor(F.xxhash64("lo", "hi")),
        F.bit_xor(F.xxhash64("hi", "lo", F.lit(1)))).first())
