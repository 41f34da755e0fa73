"""SimHash near-duplicates by meeting in the middle of Hamming balls."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitmill.llm.components import connected_components
from visitmill.llm.rows import without_ids
from visitmill.sinks.staging import stage

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# Shingles whose bits are unpacked at once.
UNPACKED = 1 << 14


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a text, unsigned; zero if it has no word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        firsts = [0, *(ends[:-shingle] + 1).tolist()]
        digest, seed = xxhash.xxh64_intdigest, SEED
        hashes = np.array(
            [digest(joined[a:b], seed)
             for a, b in zip(firsts, ends[shingle - 1:].tolist(), strict=True)],
            dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(hashes), UNPACKED):
        part = hashes[begin:begin + UNPACKED].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for each row of documents, fp as a signed long.

    Words are runs of anything but ASCII white space, A-Z lower-cased; all shingles of a
    text count as often as they occur. A shorter text is one shingle; a null or empty one
    has fingerprint zero.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = np.fromiter(
                (fingerprint(t.as_py() or b"", shingle) for t in texts),
                dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, "doc_id long, fp long")


def ball(radius: int) -> list[int]:
    """All 64-bit masks of at most `radius` ones, as signed longs."""
    masks = [sum(1 << bit for bit in bits)
             for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - 2**64 if m >= 2**63 else m for m in masks]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) links that join the same fingerprints as all pairs within `max_bits` would.

    `prints` holds distinct fp. Every fingerprint emits all variants within half the radius.
    Two fingerprints within the radius share a variant, and any two that share one are
    within the radius, so the neighbours in a variant's sorted list link all of its members:
    no pairs within a group. Each link is verified by its distance.
    """
    if max_bits % 2 or max_bits < 0:
        raise ValueError("max_bits is an even number: half of it is the radius of a ball")
    masks = F.array(*[F.lit(m) for m in ball(max_bits // 2)])
    variants = prints.select(
        "fp", F.explode(masks).alias("mask")).select("fp", F.expr("fp ^ mask").alias("variant"))
    order = Window.partitionBy("variant").orderBy("fp")
    met = variants.select("fp", F.lag("fp").over(order).alias("fp0"))
    return (
        met.where(F.expr(f"fp0 is not null and bit_count(fp ^ fp0) <= {int(max_bits)}"))
        .select(F.col("fp0").alias("a"), F.col("fp").alias("b")).distinct())


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fp, component_id) per row of `docs` (doc_id, text); other columns are ignored.

    Documents whose fingerprints differ in at most `max_bits` bits are linked; component_id
    is the smallest doc_id reachable. The nodes are fingerprints, so all copies are one node.
    Documents without a word have fingerprint zero and are linked like any other. Rows that
    repeat a doc_id each give a row; with different texts they are linked by that id. Rows
    with a null doc_id are members like others and link what lies on both sides of them;
    component_id is null only where no document of the component has an id. An empty table
    gives an empty result.
    """
    marked = stage(fingerprints(docs, shingle))
    prints = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    repeated = (
        marked.where("doc_id is not null").select("doc_id", "fp").distinct()
        .groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("other"))
        .where("a <> other").select("doc_id", "a"))
    same_id = (
        marked.select("doc_id", F.col("fp").alias("b")).join(repeated, "doc_id").select("a", "b").where("a <> b"))
    components = connected_components(links(prints.select("fp"), max_bits).unionByName(same_id))
    grouped = stage(
        prints.join(components, F.col("fp") == F.col("node"), "left")
        .select("fp", "least", F.coalesce("component", "fp").alias("component")))
    named = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = grouped.join(named, "component").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents whose doc_id is their component's smallest, with all their columns.

    Rows without a doc_id can't be told apart and stay. Rows that repeat the smallest id
    with the same doc_id are the same document and stay together.
    """
    others = near_duplicates(docs, **options).where("doc_id <> component_id").select("doc_id")
    return without_ids(docs, others)
