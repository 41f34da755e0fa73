"""Phrase collocations by sampling, an exact pass with a negative border, and expansion.

A sample of the documents proposes frequent words and pairs. A pass over all documents then
counts the proposed phrases and their negative border: every phrase that wasn't proposed
although all its shorter parts were. Wherever the border turns out to hold frequent phrases,
the phrases that these make possible are counted by another pass, until none is left. So the
counts of all frequent phrases are exact, whatever the sample held.

Phrases travel as 64-bit hashes of (language, word), one per word. The words' table carries
the words beside their hashes, and two words of one hash stop the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitmill.llm.words import gram_hashes, mixed, row_slices, text_bytes, word_hashes, word_spans
from visitmill.sinks.staging import stage

SUPPORT = 10
LONGEST = 3
TOP = 2000
# A candidate goes when a longer one holds it and has this share of its count, in per cent.
SHARE = 50
UNKNOWN = "und"
# One document of so many is in the sample, by a hash of its text.
SAMPLE = 8
# Bits of the filters that hold the frequent words and pairs: 4 MB each, at any size. Two
# phrases of one bit only make a pass count more phrases than it must.
FILTER_BITS = 25
# Bytes of text that are counted together before rows leave a task.
SLICE = 1 << 21

# What ends a word, and which of it ends a piece.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(BREAKS)] = True
_WORD = ~_BREAK
_WORD[[9, 32]] = False

# The first byte of a key is the size of the phrase, 0 for the count of a language's words.
TOTAL, WORD, PAIR, TRIPLE = (bytes([k]) for k in range(LONGEST + 1))


@dataclass(frozen=True)
class Known:
    """Filters of the words and of the pairs that count as frequent, as packed bits."""

    words: bytes
    pairs: bytes

    @staticmethod
    def none() -> Known:
        return Known(bytes(1 << (FILTER_BITS - 3)), bytes(1 << (FILTER_BITS - 3)))

    def joined(self, other: Known) -> Known:
        return Known(*(
            np.bitwise_or(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)).tobytes()
            for a, b in ((self.words, other.words), (self.pairs, other.pairs))))


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _has(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    place = _bit(hashes)
    return (np.frombuffer(bits, np.uint8)[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _language_hash(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def _keys(size: bytes, *hashes: np.ndarray) -> pa.BinaryArray:
    """Keys of one size from the hashes of their words."""
    rows, width = len(hashes[0]), 1 + 8 * len(hashes)
    held = np.empty((rows, width), dtype=np.uint8)
    held[:, 0] = size[0]
    for k, h in enumerate(hashes):
        held[:, 1 + 8 * k:9 + 8 * k] = np.ascontiguousarray(h).astype(">u8").view(np.uint8).reshape(-1, 8)
    bounds = np.arange(0, (rows + 1) * width, width, dtype=np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), rows, [None, pa.py_buffer(bounds), pa.py_buffer(held.reshape(-1))])


def _counted(hashes: list[np.ndarray], gram: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct phrases, by the hashes of their words, and how often each occurs."""
    order = np.argsort(gram)
    gram = gram[order]
    fresh = np.ones(len(gram), dtype=bool)
    np.not_equal(gram[1:], gram[:-1], out=fresh[1:])
    first = np.flatnonzero(fresh)
    found = []
    for h in hashes:
        h = h[order]
        if not (fresh[1:] | (h[1:] == h[:-1])).all():
            # Different phrases have one hash here.
            found, n = np.unique(np.stack(hashes, axis=1), axis=0, return_counts=True)
            return list(found.T), n
        found.append(h[first])
    return found, np.diff(first, append=len(gram))


def _slice_counts(
    data: np.ndarray, offsets: np.ndarray, langs: list[str], now: Known | None, before: Known | None
) -> Iterator[tuple[pa.BinaryArray, np.ndarray]]:
    """Keys and counts of the phrases of some texts.

    Without `now`, all words and pairs. Otherwise phrases of which both parts that lack one
    word are in `now`, unless both were in `before`; words only in the first pass, which has
    no `before`.
    """
    starts, ends, text = word_spans(data, offsets, _WORD)
    if not len(starts):
        return
    names, code = np.unique(np.array(langs, dtype=object), return_inverse=True)
    seeds = np.array([_language_hash(name) for name in names], dtype=np.uint64)
    words = mixed(word_hashes(data, starts, ends) ^ seeds[code][text])
    breaks = np.concatenate(([0], np.cumsum(_BREAK[data])))
    linked = (text[1:] == text[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1]])

    if before is None:
        _, first, n = np.unique(words, return_index=True, return_counts=True)
        raw = data.tobytes()
        held = []
        for h, a, b, t in zip(
            words[first].tolist(), starts[first].tolist(), ends[first].tolist(), text[first].tolist(),
            strict=True):
            lang = langs[t].encode()
            held.append(WORD + h.to_bytes(8, "big") + len(lang).to_bytes(4, "big") + lang + raw[a:b].lower())
        yield pa.array(held, pa.binary()), n
        totals = np.bincount(code[text], minlength=len(names))
        yield pa.array([TOTAL + name.encode() for name in names], pa.binary()), totals

    pair = linked
    pair_hash = gram_hashes(words, 2)
    if now is not None:
        pair = _fresh(linked, words, now.words, before and before.words)
    at = np.flatnonzero(pair)
    if len(at):
        hashes, n = _counted([words[at], words[at + 1]], pair_hash[at])
        yield _keys(PAIR, *hashes), n
    if now is None or len(words) < LONGEST:
        return
    at = np.flatnonzero(_fresh(linked[:-1] & linked[1:], pair_hash, now.pairs, before and before.pairs))
    if len(at):
        hashes, n = _counted([words[at + k] for k in range(LONGEST)], gram_hashes(words, LONGEST)[at])
        yield _keys(TRIPLE, *hashes), n


def _fresh(linked: np.ndarray, parts: np.ndarray, now: bytes, before: bytes | None) -> np.ndarray:
    """Where two neighbouring parts are known now, and weren't both known before."""
    known = _has(now, parts)
    fresh = linked & known[:-1] & known[1:]
    if before is not None:
        known = _has(before, parts)
        fresh &= ~(known[:-1] & known[1:])
    return fresh


def _pass(texts: DataFrame, now: Known | None = None, before: Known | None = None) -> DataFrame:
    """(key, n) of the phrases of one pass over (lang, text)."""
    filters: Broadcast = texts.sparkSession.sparkContext.broadcast((now, before))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = filters.value
        for batch in batches:
            langs = batch.column(0).to_pylist()
            data, offsets = text_bytes(batch.column(1))
            for first, last in row_slices(offsets, SLICE):
                begin = offsets[first]
                for keys, n in _slice_counts(
                    data[begin:offsets[last]], offsets[first:last + 1] - begin, langs[first:last], now, before):
                    yield pa.RecordBatch.from_arrays([keys, pa.array(n.astype(np.int64))], ["key", "n"])

    return texts.mapInArrow(each, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _size(size: bytes) -> F.Column:
    return F.substring("key", 1, 1) == F.lit(size)


def _known(counts: DataFrame) -> Known:
    """Filters of the words and pairs of a table of counts.

    Gathered as at most 2^FILTER_BITS / 64 rows for each of the two.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, kind in ((1, WORD), (2, PAIR)):
                keys = [k[1:1 + 8 * size] for k in batch.column(0).to_pylist() if k[:1] == kind]
                hashes = np.frombuffer(b"".join(keys), ">u8").astype(np.uint64).reshape(-1, size)
                part = hashes[:, 0] if size == 1 else gram_hashes(hashes.reshape(-1), 2)[::2]
                places = np.unique(_bit(part))
                slots, first = np.unique(places >> 6, return_index=True)
                bits = np.left_shift(np.uint64(1), (places & 63).astype(np.uint64))
                merged = np.bitwise_or.reduceat(bits, first) if len(first) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slots), size, np.int32)), pa.array(slots),
                     pa.array(merged.view(np.int64))], ["size", "slot", "bits"])

    gathered = (
        counts.where(_size(WORD) | _size(PAIR)).select("key").mapInArrow(each, "size int, slot long, bits long")
        .groupBy("size", "slot").agg(F.bit_or("bits").alias("bits")).toArrow())
    size, slot, bits = (gathered.column(k).to_numpy() for k in range(3))
    held = []
    for k in (1, 2):
        packed = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
        packed[slot[size == k]] = bits[size == k]
        held.append(packed.tobytes())
    return Known(*held)


def phrase_counts(docs: DataFrame, support: int = SUPPORT, sample: int = SAMPLE) -> tuple[DataFrame, int]:
    """(key, n) of all words, pairs and triples with n >= support, and of each language's words.

    Also returns how many passes read all documents. A phrase lies within one piece, and
    belongs to its document's `lang`; a null text is empty, a null lang is `und`.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    proposed = _pass(texts.where(F.pmod(F.xxhash64("text"), F.lit(sample)) == 0))
    now = _known(stage(proposed.where(F.col("n") >= -(-support // sample))))
    before, found, passes = None, None, 0
    while True:
        counted = stage(_pass(texts, now, before).where((F.col("n") >= support) | _size(TOTAL)))
        found = counted if found is None else found.unionByName(counted)
        passes += 1
        grown = now.joined(_known(counted))
        if grown == now:
            return found, passes
        before, now = now, grown


def _words(counts: DataFrame) -> DataFrame:
    """(w, lang, word, f) of the frequent words; a hash that two of them have stops the job."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            cuts = [13 + int.from_bytes(k[9:13], "big") for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[1:9] for k in keys], pa.binary()),
                 pa.array([k[13:c].decode() for k, c in zip(keys, cuts, strict=True)], pa.string()),
                 pa.array([k[c:].decode() for k, c in zip(keys, cuts, strict=True)], pa.string()),
                 batch.column(1)], ["w", "lang", "word", "f"])

    words = counts.where(_size(WORD)).select("key", "n").mapInArrow(
        each, "w binary, lang string, word string, f long")
    alone = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two words have one hash"))).otherwise(F.lit(1))
    return (
        words.groupBy("w").agg(
            alone.alias("alone"), F.first("lang").alias("lang"), F.first("word").alias("word"),
            F.first("f").alias("f"))
        .where("alone = 1").select("w", "lang", "word", "f"))


# Decimals of 38 digits, since the products of counts may pass 64 bits.
_SCORE = "cast(1000000 as decimal(7,0)) * cast({a} as decimal(15,0)) * cast({a} as decimal(15,0)) " \
         "div (cast({l} as decimal(18,0)) * cast({r} as decimal(18,0)))"


def _score(a: str, left: str, right: str) -> str:
    return "(" + _SCORE.format(a=a, l=left, r=right) + ")"


def candidates(counts: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of all phrases of two or three words that stay.

    The cut with the lowest score counts, the first of several. A pair goes when a triple
    that holds it has at least SHARE per cent of its count.
    """
    words = stage(_words(counts))
    pair_keys = counts.where(_size(PAIR)).select(F.expr("substring(key, 2, 16)").alias("p"), F.col("n").alias("a"))
    pairs = stage(
        pair_keys
        .join(words.selectExpr("w as w1", "lang", "word as first", "f as l"),
              F.expr("substring(p, 1, 8)") == F.col("w1"))
        .join(words.selectExpr("w as w2", "word as last", "f as r"), F.expr("substring(p, 9, 8)") == F.col("w2"))
        .selectExpr("p", "lang", "first || ' ' || last as phrase", "last", "a", "l", "r"))
    triples = stage(counts.where(_size(TRIPLE)).select(
        F.expr("substring(key, 2, 16)").alias("p1"), F.expr("substring(key, 10, 16)").alias("p2"),
        F.col("n").alias("a")))
    longer = (
        triples.select(F.col("p1").alias("p"), "a").unionByName(triples.select(F.col("p2").alias("p"), "a"))
        .groupBy("p").agg(F.max("a").alias("longer")))
    two = (
        pairs.join(longer, "p", "left")
        .where(f"longer is null or 100 * longer < {SHARE} * a")
        .selectExpr("lang", "phrase", "2 as size", "a", "l", "r", f"{_score('a', 'l', 'r')} as score"))
    three = (
        triples
        .join(pairs.selectExpr("p as p1", "lang", "phrase as head", "a as l2", "l as l1"), "p1")
        .join(pairs.selectExpr("p as p2", "last", "a as r1", "r as r2"), "p2")
        .selectExpr("lang", "head || ' ' || last as phrase", "a", "l1", "r1", "l2", "r2",
                    f"{_score('a', 'l1', 'r1')} as s1", f"{_score('a', 'l2', 'r2')} as s2")
        .selectExpr("lang", "phrase", "3 as size", "a", "if(s1 <= s2, l1, l2) as l", "if(s1 <= s2, r1, r2) as r",
                    "least(s1, s2) as score"))
    return two.unionByName(three)


def collocations(
    docs: DataFrame, support: int = SUPPORT, top: int = TOP, sample: int = SAMPLE
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases.

    By score and count, both descending, then by phrase in byte order. `docs` has text and
    lang, other columns are ignored; a null text is empty, a null lang is `und`. Rows count
    as often as they occur. An empty table, or one without a phrase of `support`
    occurrences, gives no rows. The best of a language are found among the best of as many
    parts as a shuffle has, so no task gets all phrases of a language.
    """
    counts, _ = phrase_counts(docs, support, sample)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    scored = candidates(counts).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = best.where(F.col("rank") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = counts.where(_size(TOTAL)).select(
        F.expr("cast(substring(key, 2) as string)").alias("lang"), "n")
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
