"""Ranked lexical search over posting lists that are blocked by the geometry of documents.

An index shard holds some thousand similar documents: what each term of the queries adds to
a document's score (its impact), and a posting list per term. Every list is clustered by
document similarity into blocks, and a block stores the greatest impact that any of its
documents has of each term, for the list's own term and all terms of less weight. For a
query the sum of these maxima, times the query's weights, bounds the score of every document
of the block whose heaviest query term is the list's. A block is skipped only when this
bound is below a score that the wanted number of documents reach, so nothing is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitmill.llm.words import ALPHANUMERIC, row_slices, text_bytes, word_hashes, word_spans
from visitmill.sinks.staging import stage

TOP = 20
# Documents of a shard, and entries (a document's query terms) after which it is closed too.
SHARD_DOCS = 2048
SHARD_ENTRIES = 1 << 20
# Documents of a block, on average; a shorter list is one block.
BLOCK = 128
# Random directions by whose signs documents are compared.
DIRECTIONS = 32
# One shard of so many gives the first scores to beat.
SEED_SHARDS = 16
# Bytes of items that are answered together, and so of what tasks get as broadcast.
ITEM_BYTES = 1 << 24
SLICE = 1 << 22
# Cells of the table in which the maxima of a list's blocks are gathered.
CELLS = 1 << 20

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

FORWARD = "doc_id long, n long, terms array<int>, tfs array<int>"
SIGNED = "doc_id long, sign long, terms array<int>, impacts array<int>"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


@dataclass(frozen=True)
class Vocabulary:
    """The distinct terms of some items: sorted hashes and the terms themselves."""

    hashes: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def __len__(self) -> int:
        return len(self.hashes)

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of some words are terms, and which ones: found by hash, compared byte by byte."""
        hashes = word_hashes(data, starts, ends)
        near = np.zeros(1 << 16, dtype=bool)
        near[(self.hashes >> np.uint64(48)).astype(np.int64)] = True
        at = np.flatnonzero(near[(hashes >> np.uint64(48)).astype(np.int64)])
        term = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self) - 1)
        sizes = ends[at] - starts[at]
        same = (self.hashes[term] == hashes[at]) & (self.sizes[term] == sizes)
        at, term, sizes = at[same], term[same], sizes[same]
        if not len(at):
            return at, term
        mine = _LOWER[data[_ranges(starts[at], sizes)]]
        equal = mine == self.text[_ranges(self.starts[term], sizes)]
        whole = np.logical_and.reduceat(equal, np.cumsum(sizes) - sizes)
        return at[whole], term[whole]


def vocabulary(texts: pa.Array) -> Vocabulary:
    data, offsets = text_bytes(texts)
    starts, ends, _ = word_spans(data, offsets, ALPHANUMERIC)
    hashes, first = np.unique(word_hashes(data, starts, ends), return_index=True)
    sizes = (ends - starts)[first]
    text = _LOWER[data[_ranges(starts[first], sizes)]] if len(first) else np.zeros(0, np.uint8)
    own = Vocabulary(hashes, text, np.cumsum(sizes) - sizes, sizes)
    if len(starts) and len(own.places(data, starts, ends)[0]) < len(starts):
        raise ValueError("two terms have one hash")
    return own


def _counted(
    own: Vocabulary, data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, ends of the texts' entries, and the entries' terms and frequencies."""
    rows = len(offsets) - 1
    starts, ends, text = word_spans(data, offsets, ALPHANUMERIC)
    n = np.bincount(text, minlength=rows)
    at, term = own.places(data, starts, ends)
    entry, tf = np.unique(text[at] * len(own) + term, return_counts=True)
    bounds = np.searchsorted(entry, np.arange(rows + 1) * len(own))
    return n, bounds, entry % max(1, len(own)), tf


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and values of a list column."""
    bounds = lists.offsets.to_numpy()
    return (bounds - bounds[0]).astype(np.int64), lists.flatten().to_numpy()


def forward(docs: DataFrame, own: Vocabulary) -> DataFrame:
    """Each document's number of words, and the vocabulary's terms in it with their frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(own)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last in row_slices(offsets, SLICE):
                begin = offsets[first]
                n, bounds, terms, tfs = _counted(
                    shared.value, data[begin:offsets[last]], offsets[first:last + 1] - begin)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(n.astype(np.int64)),
                     _lists(bounds, terms), _lists(bounds, tfs)], ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(each, FORWARD)


@dataclass(frozen=True)
class Weights:
    """What a vocabulary's terms weigh in a corpus, heaviest first.

    `rank` is the place of each term of the vocabulary in that order, `weight` goes by place.
    """

    n_docs: int
    n_words: int
    rank: np.ndarray
    weight: np.ndarray

    def impacts(self, n: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        """What a term adds to a document's score per unit of weight."""
        tfs = tfs.astype(np.int64)
        m = 100 - 25 + (25 * n * self.n_docs) // max(1, self.n_words)
        return (1_000_000_000 * tfs) // (1000 * tfs + 12 * m)


def weights(staged: DataFrame, own: Vocabulary) -> Weights:
    """Weights from all documents; one row per term of the vocabulary comes to the driver."""
    n_docs, n_words = staged.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(own), dtype=np.int64)
    held = staged.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toArrow()
    df[held["t"].to_numpy()] = held["df"].to_numpy()
    weight = np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    order = np.argsort(-weight, kind="stable")
    rank = np.empty(len(own), dtype=np.int64)
    rank[order] = np.arange(len(own))
    return Weights(n_docs, n_words, rank, weight[order])


def _directions(terms: int) -> np.ndarray:
    return np.random.default_rng(11).choice(np.array([-1, 1], dtype=np.float32), (terms, DIRECTIONS))


def _projected(
    bounds: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weight: np.ndarray, directions: np.ndarray
) -> np.ndarray:
    """Documents as points: their weighted terms along the random directions, of length one."""
    points = np.zeros((len(bounds) - 1, DIRECTIONS), dtype=np.float32)
    value = (weight[terms] * impacts).astype(np.float32)
    for first, last in row_slices(bounds, 1 << 17):
        part = slice(bounds[first], bounds[last])
        held = np.flatnonzero(bounds[first + 1:last + 1] > bounds[first:last])
        if len(held):
            moved = value[part, None] * directions[terms[part]]
            points[first + held] = np.add.reduceat(moved, bounds[first + held] - bounds[first], axis=0)
    length = np.sqrt((points * points).sum(axis=1, keepdims=True))
    return points / np.where(length > 0, length, 1)


def signed(staged: DataFrame, weighed: Weights) -> DataFrame:
    """Documents that hold a term, with impacts, terms in order of weight, and their signs."""
    shared = staged.sparkSession.sparkContext.broadcast(weighed)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        directions = _directions(len(w.weight))
        for batch in batches:
            bounds, terms = _flat(batch.column(2))
            tfs = _flat(batch.column(3))[1]
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            impacts = w.impacts(batch.column(1).to_numpy()[row], tfs)
            terms = w.rank[terms]
            order = np.argsort(row * len(w.weight) + terms)
            terms, impacts = terms[order], impacts[order]
            points = _projected(bounds, terms, impacts, w.weight, directions)
            sign = (points > 0) @ (np.int64(1) << np.arange(DIRECTIONS - 1, -1, -1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sign), _lists(bounds, terms), _lists(bounds, impacts)],
                ["doc_id", "sign", "terms", "impacts"])

    return staged.where(F.size("terms") > 0).mapInArrow(each, SIGNED)


@dataclass(frozen=True)
class Shard:
    """The index of some documents, as flat arrays; `..._ends` close what they count.

    Documents: doc_ends, terms, impacts. Lists: list_terms, list_ends (in blocks). Blocks:
    member_ends, members (documents), summary_ends, coordinates (terms) and maxima (impacts).
    """

    doc_ends: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray
    list_terms: np.ndarray
    list_ends: np.ndarray
    member_ends: np.ndarray
    members: np.ndarray
    summary_ends: np.ndarray
    coordinates: np.ndarray
    maxima: np.ndarray


SHARDS = "doc_ids array<long>, " + ", ".join(f"{f.name} array<int>" for f in fields(Shard))


def _maxima(block: np.ndarray, term: np.ndarray, impact: np.ndarray, terms: int) -> tuple[np.ndarray, ...]:
    """The greatest impact of each (block, term): blocks, terms and maxima in order."""
    blocks = int(block.max()) + 1
    if blocks * terms <= CELLS:
        table = np.zeros(blocks * terms, dtype=np.int64)
        np.maximum.at(table, block * terms + term, impact)
        cell = np.flatnonzero(table)
        return cell // terms, cell % terms, table[cell]
    cell = block * terms + term
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    return cell[first] // terms, cell[first] % terms, np.maximum.reduceat(impact[order], first)


def _clustered(docs: np.ndarray, points: np.ndarray, size: int) -> np.ndarray:
    """A cluster for each document: that of the nearest of some leaders, spread over the signs."""
    count = -(-len(docs) // size)
    leaders = docs[(np.arange(count) * len(docs)) // count]
    out = np.empty(len(docs), dtype=np.int64)
    for begin in range(0, len(docs), 1 << 12):
        part = docs[begin:begin + (1 << 12)]
        out[begin:begin + len(part)] = np.argmax(points[part] @ points[leaders].T, axis=1)
    return np.unique(out, return_inverse=True)[1]


def built(
    bounds: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weight: np.ndarray, directions: np.ndarray,
    size: int = BLOCK,
) -> Shard:
    """The index of documents in the order of their signs, terms of each by weight."""
    terms, impacts = terms.astype(np.int64), impacts.astype(np.int64)
    points = _projected(bounds, terms, impacts, weight, directions)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.argsort(terms, kind="stable")
    list_terms, first = np.unique(terms[order], return_index=True)
    ends = np.append(first[1:], len(order))
    # Short lists are one block each and are summarised together.
    short = ends - first <= size
    block_of = np.zeros(len(order), dtype=np.int64)
    counts = np.ones(len(list_terms), dtype=np.int64)
    for k in np.flatnonzero(~short):
        part = slice(first[k], ends[k])
        block_of[part] = _clustered(doc[order[part]], points, size)
        counts[k] = block_of[part].max() + 1
    list_ends = np.cumsum(counts)
    block = block_of + np.repeat(list_ends - counts, ends - first)
    by_block = np.argsort(block, kind="stable")
    member_ends = np.cumsum(np.bincount(block, minlength=list_ends[-1]))

    after = bounds[1:][doc[order]] - order
    found = []
    for a, b in row_slices(np.concatenate(([0], np.cumsum(np.add.reduceat(after, first)))), CELLS):
        part = slice(first[a], ends[b - 1])
        entry = _ranges(order[part], after[part])
        base = block[first[a]]
        held = _maxima(np.repeat(block[part] - base, after[part]), terms[entry], impacts[entry], len(weight))
        found.append(tuple(c.astype(np.int32) for c in (held[0] + base, *held[1:])))
    place, coordinates, maxima = (np.concatenate(c) for c in zip(*found, strict=True))
    summary_ends = np.cumsum(np.bincount(place, minlength=list_ends[-1]))
    return Shard(bounds[1:], terms, impacts, list_terms, list_ends, member_ends, doc[order][by_block],
                 summary_ends, coordinates, maxima)


def index(
    documents: DataFrame, weighed: Weights, size: int = BLOCK, shard_docs: int = SHARD_DOCS
) -> DataFrame:
    """Shards of documents that are neighbours by their signs; one row per shard."""
    shared = documents.sparkSession.sparkContext.broadcast(weighed)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value.weight
        directions = _directions(len(weight))
        held: list[pa.RecordBatch] = []
        rows = entries = 0

        def shard() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            columns = [whole.column(k).combine_chunks() for k in range(3)]
            bounds, terms = _flat(columns[1])
            made = built(bounds, terms, _flat(columns[2])[1], weight, directions, size)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(columns[0])], pa.int32()), columns[0])]
            for field in fields(Shard):
                values = getattr(made, field.name)
                lists.append(_lists(np.array([0, len(values)]), values))
            return pa.RecordBatch.from_arrays(lists, ["doc_ids", *(f.name for f in fields(Shard))])

        for batch in batches:
            ends = _flat(batch.column(1))[0][1:]
            first = 0
            while first < batch.num_rows:
                done = ends[first - 1] if first else 0
                last = int(np.searchsorted(ends, done + SHARD_ENTRIES - entries, "right"))
                last = max(first + 1, min(last, first + shard_docs - rows))
                held.append(batch.slice(first, last - first))
                rows, entries = rows + last - first, entries + ends[last - 1] - done
                first = last
                if rows >= shard_docs or entries >= SHARD_ENTRIES or first < batch.num_rows:
                    yield shard()
                    held, rows, entries = [], 0, 0
        if held:
            yield shard()

    parts = max(1, -(-documents.count() // shard_docs))
    near = documents.repartitionByRange(parts, "sign", F.xxhash64("doc_id", "terms", "impacts"))
    return near.sortWithinPartitions("sign").select("doc_id", "terms", "impacts").mapInArrow(each, SHARDS)


class Searcher:
    """Answers queries from one shard."""

    def __init__(self, shard: Shard, terms: int):
        self.shard = shard
        self.query = np.zeros(terms, dtype=np.int64)
        self.doc_starts, self.list_starts, self.member_starts, self.summary_starts = (
            np.concatenate(([0], ends[:-1])).astype(np.int64)
            for ends in (shard.doc_ends, shard.list_ends, shard.member_ends, shard.summary_ends))
        #: Blocks whose documents were scored, of how many.
        self.opened = self.blocks = 0

    def _summed(self, starts: np.ndarray, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        at = _ranges(starts, sizes)
        return np.add.reduceat(self.query[terms[at]] * values[at], np.cumsum(sizes) - sizes)

    def bounds(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of the lists of some terms, and what no document found through them exceeds."""
        s = self.shard
        lists = np.minimum(np.searchsorted(s.list_terms, terms), len(s.list_terms) - 1)
        lists = lists[s.list_terms[lists] == terms]
        blocks = _ranges(self.list_starts[lists], s.list_ends[lists] - self.list_starts[lists])
        if not len(blocks):
            return blocks, blocks
        starts = self.summary_starts[blocks]
        return blocks, self._summed(starts, s.summary_ends[blocks] - starts, s.coordinates, s.maxima)

    def best(self, terms: np.ndarray, weight: np.ndarray, top: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of at least `floor`: the best `top`, and all that equal the last."""
        s = self.shard
        self.query[terms] = weight
        blocks, bounds = self.bounds(terms)
        order = np.argsort(-bounds, kind="stable")
        blocks, bounds = blocks[order], bounds[order]
        seen = np.zeros(len(s.doc_ends), dtype=bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done, step = 0, 2
        while done < len(blocks) and bounds[done] >= floor:
            last = min(done + step, int(np.searchsorted(-bounds, -floor, "right")))
            part = blocks[done:last]
            starts = self.member_starts[part]
            fresh = np.unique(s.members[_ranges(starts, s.member_ends[part] - starts)])
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            if len(fresh):
                begins = self.doc_starts[fresh]
                score = self._summed(begins, s.doc_ends[fresh] - begins, s.terms, s.impacts)
                kept = score >= floor
                docs, scores = np.append(docs, fresh[kept]), np.append(scores, score[kept])
                if len(scores) >= top:
                    floor = max(floor, int(np.partition(scores, -top)[-top]))
                    kept = scores >= floor
                    docs, scores = docs[kept], scores[kept]
            self.opened += last - done
            done, step = last, 2 * step
        self.blocks += len(blocks)
        self.query[terms] = 0
        return docs, scores


@dataclass(frozen=True)
class Queries:
    """Items as weighted terms: `ends` closes each item's part of terms and weight."""

    ends: np.ndarray
    terms: np.ndarray
    weight: np.ndarray


def queries(texts: pa.Array, own: Vocabulary, weighed: Weights) -> Queries:
    data, offsets = text_bytes(texts)
    _, bounds, terms, times = _counted(own, data, offsets)
    terms = weighed.rank[terms]
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.argsort(row * len(own) + terms)
    return Queries(bounds[1:], terms[order], (weighed.weight[terms] * times)[order])


def _answers(shards: DataFrame, asked: Queries, terms: int, top: int, floors: np.ndarray) -> DataFrame:
    """(item, doc_id, score): each shard's best documents that reach the item's floor."""
    shared = shards.sparkSession.sparkContext.broadcast((asked, floors))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, floors = shared.value
        starts = np.concatenate(([0], asked.ends[:-1])).astype(np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column(0).slice(row, 1).flatten()
                names = [f.name for f in fields(Shard)]
                shard = Shard(*(
                    batch.column(1 + k).slice(row, 1).flatten().to_numpy()
                    for k in range(len(names))))
                searcher = Searcher(shard, terms)
                number = ids.fill_null(0).to_numpy()
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                found = []
                for item, (a, b) in enumerate(zip(starts.tolist(), asked.ends.tolist(), strict=True)):
                    docs, scores = searcher.best(asked.terms[a:b], asked.weight[a:b], top, int(floors[item]))
                    order = np.lexsort((number[docs], missing[docs], -scores))[:top]
                    found.append((np.full(len(order), item), docs[order], scores[order]))
                item, docs, scores = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.int64()), ids.take(pa.array(docs, pa.int64())), pa.array(scores, pa.int64())],
                    ["item", "doc_id", "score"])

    return shards.mapInArrow(each, "item long, doc_id long, score long")


@contextmanager
def _row_by_row(spark: SparkSession) -> Iterator[None]:
    """Hand rows to Python one at a time: a shard is as large as a whole batch of other rows."""
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, "1")
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def _best(answers: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _floors(answers: DataFrame, items: int, top: int) -> np.ndarray:
    """For each item the score that `top` documents are known to reach, or one."""
    held = _best(answers, top).where(F.col("rank") == top).select("item", "score").toArrow()
    floors = np.ones(items, dtype=np.int64)
    floors[held["item"].to_numpy()] = held["score"].to_numpy()
    return floors


def _answered(docs: DataFrame, items: pa.Table, top: int, size: int, shard_docs: int) -> DataFrame:
    """(item, doc_id, score, rank) of some items that fit in memory."""
    texts = items["text"].combine_chunks()
    own = vocabulary(texts)
    spark = docs.sparkSession
    if not len(own):
        return spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    staged = stage(forward(docs, own))
    weighed = weights(staged, own)
    shards = stage(index(stage(signed(staged, weighed)), weighed, size, shard_docs))
    asked = queries(texts, own, weighed)
    seeds = shards.where(F.pmod(F.xxhash64("doc_ids"), F.lit(SEED_SHARDS)) == 0)
    ones = np.ones(len(texts), dtype=np.int64)
    with _row_by_row(spark):
        first = stage(_answers(seeds, asked, len(own), top, ones))
        found = stage(_answers(shards, asked, len(own), top, _floors(first, len(texts), top)))
    return _best(found, top)


def ranked(
    docs: DataFrame, items: DataFrame, top: int = TOP, size: int = BLOCK, shard_docs: int = SHARD_DOCS
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's best documents with a score above 0.

    Terms are runs of ASCII letters and digits and of all that isn't ASCII, A-Z lower-cased.
    Every row of `docs` (doc_id, text) is a document; rows without a term count for nothing.
    Equal scores go by ascending doc_id, a null id last; rows of equal id each have a rank.
    `items` has item_id and text: rows equal in both are one item, others with one id are
    answered each for itself. Items without a term, empty tables and null texts give no
    rows. Other columns are ignored.

    Items are answered in blocks of about ITEM_BYTES of text (one longer item is a block of
    its own), which come to the driver; the index of a block has the terms of its items.
    """
    spark: SparkSession = docs.sparkSession
    asked = stage(items.select(
        F.col("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct())
    size_of = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size_of // ITEM_BYTES))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    answers = None
    for block in range(blocks):
        held = dealt.where(F.col("block") == block).select("item_id", "text").toArrow()
        found = _answered(docs, held, top, size, shard_docs)
        names = spark.createDataFrame(
            [(k, i) for k, i in enumerate(held["item_id"].to_pylist())],
            f"item long, item_id {asked.schema['item_id'].dataType.simpleString()}")
        named = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        answers = named if answers is None else answers.unionByName(named)
    return answers
