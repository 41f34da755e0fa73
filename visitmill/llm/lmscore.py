"""Language-model scoring by cross-entropy difference.

Two bigram models, of the target and of all documents as the background, have the same
vocabulary, order and smoothing: every word of the corpus is in it, and
p(word | before) = (count of the pair + PRIOR) / (count of the word before + PRIOR * words).
So a word's loss is a term of its pair and a term of the word before it, and each term needs
the counts of one n-gram. Those never come together anywhere: every block of documents sends
its n-grams, with the places of the documents that hold them, to where the n-gram's counts
are summed, and from there each document gets its terms back as sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.llm.words import ALPHANUMERIC, STEP, mixed, row_slices, text_bytes, word_hashes, word_spans
from visitmill.sinks.staging import stage

# Count that every pair of words has besides its own.
PRIOR = 0.05
# Bytes of text, and documents, of a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 24
BLOCK_DOCS = 1 << 16
# Words whose n-grams are summed by one task, about.
TASK_WORDS = 1 << 21
# Buckets of ids by which most documents are told from those with a label; they are broadcast.
BUCKETS = 1 << 20

#: Stands before the first word of a text.
BEGIN = np.uint64(0x5851F42D4C957F2D)
_HISTORY = np.uint64(0x2545F4914F6CDD1D)
# The block number of the target's n-grams, which no block of documents has.
TARGET = 0

GRAMS = "part int, block long, grams binary, counts binary, docs binary"
PLACES = "block long, place int, doc_id long"
PACKED = "block long, places binary, target binary, background binary, n binary"
SUMS = "block long, place int, target double, background double, n long"


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each word of some texts.

    Words are runs of ASCII letters and digits and of what isn't ASCII, A-Z lower-cased.
    """
    starts, ends, row = word_spans(data, offsets, ALPHANUMERIC)
    return row.astype(np.int32), word_hashes(data, starts, ends)


def slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """`words_of` some texts at a time."""
    data, offsets = text_bytes(texts)
    for first, last in row_slices(offsets):
        yield words_of(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])


def grams(row: np.ndarray, word: np.ndarray) -> Iterator[np.ndarray]:
    """The pair that ends at each word, then the word before each, as hashes; the last bit says which."""
    before = np.concatenate(([BEGIN], word[:-1]))[:len(word)]
    if len(row):
        before[np.concatenate(([True], row[1:] != row[:-1]))] = BEGIN
    with np.errstate(over="ignore"):
        yield mixed(before * np.uint64(STEP) + word) & ~np.uint64(1)
    yield mixed(before ^ _HISTORY) | np.uint64(1)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word, by its hash, occurs in all texts."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.zeros(0, np.uint64), *(word for _, word in slices(batch.column(0)))]
            words, counts = np.unique(np.concatenate(hashes), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])

    return (
        docs.select(F.col("text").cast("string")).mapInArrow(each, "word long, n long")
        .groupBy("word").agg(F.sum("n").alias("n")))


def _blocks(
    batches: Iterator[pa.RecordBatch], offsets_of: Callable[[pa.RecordBatch], np.ndarray], take: Callable
) -> Iterator[tuple[int, list]]:
    """The documents (doc_id, ...) of a task in blocks: a number, and what `take` made of each slice.

    Blocks go by the lengths of the texts alone. The number is a hash of the task's partition,
    the block's place there, the ids and the lengths, so other documents have other numbers.
    """
    partition, made, held, seen, docs, size = TaskContext.get().partitionId(), 0, [], [], 0, 0

    def number() -> int:
        named = np.concatenate([[partition, made], *seen]).astype("<i8").tobytes()
        return xxhash.xxh64_intdigest(named) >> 1 | 1

    for batch in batches:
        offsets, ids = offsets_of(batch), batch.column(0).fill_null(-1).to_numpy()
        for begin, end in row_slices(offsets):
            for first in range(begin, end, BLOCK_DOCS):
                last = min(end, first + BLOCK_DOCS)
                length = int(offsets[last] - offsets[first])
                if held and (size + length > BLOCK_BYTES or docs + last - first > BLOCK_DOCS):
                    yield number(), held
                    made, held, seen, docs, size = made + 1, [], [], 0, 0
                held.append(take(batch, first, last, docs))
                seen += [np.diff(offsets[first:last + 1]), ids[first:last]]
                docs, size = docs + last - first, size + length
    if held:
        yield number(), held


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Values with their first bytes together, then their second bytes and so on.

    The first bytes of sorted hashes and of small counts are alike, so the shuffle packs them.
    """
    return values.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes()


def _values(planes: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind)[:, 0]


def part_of(gram: np.ndarray, parts: int) -> np.ndarray:
    """The task that sums an n-gram, in the order of the hashes."""
    return ((gram >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _sent(gram: np.ndarray, counts: np.ndarray, docs: np.ndarray, block: int, parts: int) -> pa.RecordBatch:
    """Distinct n-grams in order, dealt by the task that sums them: a row for each task.

    `docs` are the places of the words that have the n-grams, one n-gram's after another, or
    none where only counts are sent.
    """
    part = part_of(gram, parts)
    firsts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))[:len(part)])
    lasts = np.append(firsts[1:], len(gram))[:len(firsts)].astype(np.int64)
    ends = np.append(0, np.cumsum(counts))
    rows: list[tuple] = []
    for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True):
        held = docs[ends[a]:ends[b]] if len(docs) else docs
        rows.append((int(part[a]), block, _planes(gram[a:b], ">u8"), _planes(counts[a:b], ">u4"), _planes(held, ">u2")))
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    columns = zip(*rows, strict=True) if rows else [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "block", "grams", "counts", "docs"])


def block_grams(texts: DataFrame, parts: int) -> DataFrame:
    """The n-grams of each block of documents, with the places of the documents that have them."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def offsets_of(batch: pa.RecordBatch) -> np.ndarray:
            held["data"], held["offsets"] = text_bytes(batch.column(1))
            return held["offsets"]

        def take(_, first: int, last: int, docs: int) -> tuple[np.ndarray, np.ndarray]:
            offsets = held["offsets"][first:last + 1]
            row, word = words_of(held["data"][offsets[0]:offsets[-1]], offsets - offsets[0])
            return row + np.int32(docs), word

        for number, pieces in _blocks(batches, offsets_of, take):
            row, word = (np.concatenate(c) for c in zip(*pieces, strict=True))
            for gram in grams(row, word):
                order = np.argsort(gram, kind="stable")
                gram = gram[order]
                first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1]))[:len(gram)])
                yield _sent(gram[first], np.diff(first, append=len(gram)), row[order].astype("<u2"), number, parts)

    return texts.select("doc_id", "text").mapInArrow(each, GRAMS)


def places(texts: DataFrame) -> DataFrame:
    """(block, place, doc_id) of each row, as `block_grams` names them; no text is handed to Python."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def offsets_of(batch: pa.RecordBatch) -> np.ndarray:
            return np.concatenate(([0], np.cumsum(batch.column(1).to_numpy())))

        def take(batch: pa.RecordBatch, first: int, last: int, _) -> pa.Array:
            return batch.column(0).slice(first, last - first)

        for number, parts in _blocks(batches, offsets_of, take):
            ids = pa.concat_arrays(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), number)), pa.array(np.arange(len(ids), dtype=np.int32)), ids],
                ["block", "place", "doc_id"])

    length = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return texts.select("doc_id", length).mapInArrow(each, PLACES)


def target_grams(target: DataFrame, parts: int) -> DataFrame:
    """The n-grams of the target's texts with their counts alone."""
    none = np.zeros(0, "<u2")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, word in slices(batch.column(0)):
                for gram in grams(row, word):
                    found, counts = np.unique(gram, return_counts=True)
                    yield _sent(found, counts, none, TARGET, parts)

    return target.mapInArrow(each, GRAMS)


def summed(sent: DataFrame, vocabulary: int, scale: float, prior: float, parts: int) -> DataFrame:
    """(block, place, target, background, n): the terms of the losses of documents, summed.

    All n-grams of one hash meet in one task, at most once from each block and each slice of
    the target; a task holds the n-grams of about TASK_WORDS words. It sends each block one
    row, with a sum (in single precision) for each document that has some of its n-grams: a
    document gets as many sums as tasks hold n-grams of it, so at most as many as it has
    words. `n` counts the words.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, gram, counts, docs = [], [], [], []
        for batch in batches:
            for block, g, c, d in zip(*(batch.column(k) for k in (1, 2, 3, 4)), strict=True):
                blocks.append(block.as_py())
                gram.append(_values(g.as_py(), ">u8").astype(np.uint64))
                counts.append(_values(c.as_py(), ">u4").astype(np.int64))
                docs.append(_values(d.as_py(), ">u2"))
        if not blocks:
            return
        sizes = [len(g) for g in gram]
        whole = np.concatenate(gram)
        n = np.concatenate(counts)
        order = np.argsort(whole, kind="stable")
        fresh = np.concatenate(([False], whole[order][1:] != whole[order][:-1]))
        group = np.empty(len(whole), dtype=np.int64)
        group[order] = np.cumsum(fresh)
        groups = int(group[order[-1]]) + 1
        mine = np.repeat(np.array(blocks) == TARGET, sizes)
        in_target = np.bincount(group[mine], weights=n[mine], minlength=groups)
        in_all = np.bincount(group[~mine], weights=n[~mine], minlength=groups)
        history = np.zeros(groups, dtype=bool)
        history[group] = whole & np.uint64(1) == 1
        terms = [np.where(history, np.log(total + prior * vocabulary), -np.log(total + prior))
                 for total in (in_target, in_all * scale)]
        # Each place of a document gets its n-gram's terms, block by block.
        ends = np.cumsum(sizes).tolist()
        of_block: dict[int, list[int]] = {}
        for k, block in enumerate(blocks):
            if block != TARGET:
                of_block.setdefault(block, []).append(k)
        for block, rows in of_block.items():
            place = np.concatenate([docs[k] for k in rows])
            of = np.concatenate([np.repeat(group[ends[k] - sizes[k]:ends[k]], counts[k]) for k in rows])
            sums = [np.bincount(place, weights=t[of]) for t in terms]
            words = np.bincount(place, weights=~history[of])
            held = np.flatnonzero(np.bincount(place))
            packed = [_planes(c[held], kind) for c, kind in zip((*sums, words), (">f4", ">f4", ">u4"), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), *(pa.array([c], pa.binary()) for c in (_planes(held, ">u2"), *packed))],
                ["block", "places", "target", "background", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros((0, 3))

        def done() -> pa.RecordBatch:
            held = np.flatnonzero(total[:, 2])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(held), now)), pa.array(held.astype(np.int32)), pa.array(total[held, 0]),
                 pa.array(total[held, 1]), pa.array(total[held, 2].astype(np.int64))],
                ["block", "place", "target", "background", "n"])

        for batch in batches:
            for block, places, *packed in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if block != now:
                    if now is not None:
                        yield done()
                    now, total = block, np.zeros((BLOCK_DOCS, 3))
                place = _values(places, ">u2").astype(np.int64)
                for k, kind in enumerate((">f4", ">f4", ">u4")):
                    total[place, k] += _values(packed[k], kind)
        if now is not None:
            yield done()

    sums = sent.repartitionById(parts, F.col("part")).mapInArrow(each, PACKED)
    return sums.repartition("block").sortWithinPartitions("block").mapInArrow(add, SUMS)


def scored(docs: DataFrame, target: DataFrame, prior: float = PRIOR) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, difference) of each row of documents.

    The background model is that of all `docs` (doc_id, text), the target's that of all texts
    of `target` (text). Counts of the background are scaled to the target's number of words,
    so that the smoothing, which goes by counts, treats both alike. Losses are means over the
    words of a text in nats; difference is the target's minus the background's, so the lowest
    are most like the target. A text without a word, null or empty, has null losses. Repeated
    rows each give a row; other columns are ignored. Without a target all n-grams have the
    smoothing alone.

    The documents are read twice, and must come in the same partitions and order both times,
    as files do; if they don't, the query stops.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Read twice, and it may come from a join.
    target = stage(target.select(F.col("text").cast("string").alias("text")))
    total = F.coalesce(F.sum("n"), F.lit(0))
    vocabulary, n_all = word_counts(texts).agg(F.count(F.lit(1)), total).first()
    n_target = word_counts(target).agg(total).first()[0]
    parts = max(1, -(-n_all // TASK_WORDS))
    sums = summed(
        block_grams(texts, parts).unionByName(target_grams(target, parts)), max(1, vocabulary),
        n_target / max(1, n_all), prior, parts)
    lost = F.raise_error(F.lit("the documents came in another order the second time")).cast("long")
    # Sums whose documents aren't there have no name.
    named = places(texts).withColumn("named", F.lit(True))
    joined = named.join(sums, ["block", "place"], "full")
    words = F.when(F.col("named"), F.coalesce("n", F.lit(0))).otherwise(lost)
    mean = {c: F.col(c) / F.col("n") for c in ("target", "background")}
    return joined.select(
        "doc_id", words.alias("n_words"), mean["target"].alias("target_loss"),
        mean["background"].alias("background_loss"), (mean["target"] - mean["background"]).alias("difference"))


def labelled_target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that some label calls good; all of them, each row once.

    Labels grow with the documents, so the two meet in a shuffle. Only documents that fall
    into a bucket of some good id are shuffled; the buckets, at most BUCKETS numbers, are
    broadcast.
    """
    good = labels.where("quality > 0 and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id")).distinct()

    def bucket(column: str) -> F.Column:
        return F.pmod(F.xxhash64(column), F.lit(BUCKETS))

    buckets = good.select(bucket("doc_id").alias("_bucket")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    near = texts.join(F.broadcast(buckets), bucket("doc_id") == F.col("_bucket"), "left_semi")
    return near.join(good.hint("shuffle_merge"), "doc_id", "left_semi")
