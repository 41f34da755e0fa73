"""Benchmark decontamination by winnowing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.llm.rows import keyed, with_found
from visitmill.llm.words import ALPHANUMERIC, gram_hashes, row_slices, text_bytes, word_hashes, word_spans
from visitmill.sinks.staging import stage

# Words of a window, and of the grams whose least hash in a window is its fingerprint.
WINDOW = 10
GRAM = 5
# Bits of the filter that documents' fingerprints pass first: 2 MB whatever the benchmark's size.
FILTER_BITS = 24

SIGNED = ("row_id long, text_key long, n_words long, "
          "prints array<struct<span: int, print: long, context: string, at: int, places: array<int>>>")


def winnowed(grams: np.ndarray, text: np.ndarray, gram: int, window: int) -> np.ndarray:
    """Places of the grams that are least in some window of `window` words; ties: the last."""
    count = len(text) - window + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    place = np.arange(window - gram, window - gram + count)
    least = grams[place]
    for j in range(window - gram - 1, -1, -1):
        other = grams[j:j + count]
        less = other < least
        least = np.where(less, other, least)
        place = np.where(less, np.arange(j, j + count), place)
    return np.unique(place[text[:count] == text[window - 1:]])


def signed(
    frame: DataFrame, spans: list[int] | None, passing: Broadcast | None = None,
    window: int = WINDOW, gram: int = GRAM,
) -> DataFrame:
    """Fingerprints of each row of (row_id, text_key, text), with the words around them.

    A fingerprint has the span of its matches: `window` for winnowed grams, or n for a whole
    run of n words. Documents get the runs of all `spans` below `window`; with None, for
    benchmark items, a text shorter than `window` gets itself as its one run. The context
    holds all words of windows over the fingerprint. With `passing`, only fingerprints of
    which the filter has the bit are returned.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(passing.value, np.uint8)) if passing else None
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for first, last in row_slices(offsets):
                part = data[offsets[first]:offsets[last]]
                yield _signed_slice(
                    batch.slice(first, last - first), part, offsets[first:last + 1] - offsets[first],
                    spans, bits, window, gram)

    return frame.mapInArrow(each, SIGNED)


def _signed_slice(batch, data, offsets, spans, bits, window, gram):
    rows = batch.num_rows
    starts, ends, text = word_spans(data, offsets, ALPHANUMERIC)
    hashes = word_hashes(data, starts, ends)
    bounds = np.searchsorted(text, np.arange(rows + 1))
    counts = np.diff(bounds)
    found: list[list[dict]] = [[] for _ in range(rows)]
    raw = data.tobytes().lower()

    def emit(span: int, size: int, places: np.ndarray, prints: np.ndarray) -> None:
        prints = prints ^ np.uint64(span)
        if bits is not None:
            passed = bits[prints >> np.uint64(64 - FILTER_BITS)] == 1
            places, prints = places[passed], prints[passed]
        seen: dict = {}
        for place, value in zip(places.tolist(), prints.view(np.int64).tolist(), strict=True):
            row = int(text[place])
            begin = max(int(bounds[row]), place + size - span)
            end = min(int(bounds[row + 1]), place + span)
            context = b" ".join([raw[starts[k]:ends[k]] for k in range(begin, end)])
            key = (row, value, context, place - begin)
            if key in seen:
                seen[key].append(place - int(bounds[row]))
            else:
                seen[key] = [place - int(bounds[row])]
        for (row, value, context, at), where in seen.items():
            found[row].append({"span": span, "print": value, "context": context.decode(), "at": at,
                               "places": where})

    grams = gram_hashes(hashes, gram)
    places = winnowed(grams, text, gram, window)
    emit(window, gram, places, grams[places])
    for n in range(1, window) if spans is None else spans:
        grams = gram_hashes(hashes, n)
        places = np.flatnonzero(text[:len(grams)] == text[n - 1:])
        if spans is None:
            places = places[counts[text[places]] == n]
        emit(n, n, places, grams[places])
    kind = pa.list_(pa.struct([
        ("span", pa.int32()), ("print", pa.int64()), ("context", pa.string()), ("at", pa.int32()),
        ("places", pa.list_(pa.int32()))]))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(counts.astype(np.int64)), pa.array(found, kind)],
        ["row_id", "text_key", "n_words", "prints"])


def extended(mine: list[str], at: int, theirs: list[str], there: int, size: int) -> tuple[int, int]:
    """The run of equal words around two fingerprints of `size` words: (first, end) in `mine`."""
    if mine[at:at + size] != theirs[there:there + size]:
        return at, at
    first, end = at, at + size
    while first > 0 and there + first - at > 0 and mine[first - 1] == theirs[there + first - at - 1]:
        first -= 1
    while end < len(mine) and there + end - at < len(theirs) and mine[end] == theirs[there + end - at]:
        end += 1
    return first, end


def benchmark_hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All runs of words that documents share with benchmark items, and the documents' counts.

    Returns (doc_id, text_key, n_words) of each row, (doc_id, text_key, passage, first, end)
    with word numbers of each run of at least one window, and (passage, item_id): the
    items that hold a passage. A passage that many items have is compared with a document
    once. Every span of `window` shared
    words has a fingerprint that both sides choose, so none is missed; hits are extended over
    the words themselves, so none is a chance equality of hashes. A benchmark item shorter
    than a window, but not empty, is searched for as a whole.

    The documents pass a filter of fixed size first, and then meet the items' fingerprints
    in a shuffle join. So neither side needs to fit anywhere.
    """
    bench = stage(
        signed(items.select(F.col("item_id").cast("long").alias("row_id"),
                            F.lit(0).cast("long").alias("text_key"), "text"), None, None, window, gram)
        .select(F.col("row_id").alias("item_id"), F.explode("prints").alias("p"))
        .select("item_id", "p.span", "p.print", F.col("p.context").alias("item_context"),
                F.col("p.at").alias("item_at")).distinct())
    passing, spans = _filter(bench, window)
    # Fingerprints with all words around them; the hash names what is compared below.
    named = bench.withColumn("passage", F.xxhash64("span", "print", "item_at", "item_context"))
    owners = named.select("passage", "item_id").distinct()
    passages = named.drop("item_id").distinct()
    marked = stage(signed(
        keyed(docs, "text").withColumnRenamed("doc_id", "row_id"), spans,
        docs.sparkSession.sparkContext.broadcast(passing), window, gram))
    counts = marked.select(F.col("row_id").alias("doc_id"), "text_key", "n_words")
    prints = (
        marked.select(F.col("row_id").alias("doc_id"), "text_key", F.explode("prints").alias("p"))
        .select("doc_id", "text_key", "p.*"))
    met = prints.join(passages, ["span", "print"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                mine, theirs = row["context"].split(" "), row["item_context"].split(" ")
                size = gram if row["span"] == window else row["span"]
                first, end = extended(mine, row["at"], theirs, row["item_at"], size)
                if end - first >= row["span"]:
                    out += [(row["doc_id"], row["text_key"], row["passage"], place + first - row["at"],
                             place + end - row["at"]) for place in row["places"]]
            names, kinds = ("doc_id", "text_key", "passage", "first", "end"), [pa.int64()] * 5
            columns = zip(*out, strict=True) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))

    hits = met.select(
        "doc_id", "text_key", "passage", "span", "at", "context", "places", "item_at", "item_context"
    ).mapInArrow(each, "doc_id long, text_key long, passage long, first long, end long")
    return counts, hits, owners


def _filter(bench: DataFrame, window: int) -> tuple[bytes, list[int]]:
    """A bit for each leading FILTER_BITS bits that a fingerprint has, and the short spans.

    Gathered as at most 2^FILTER_BITS / 32 words of 32 bits.
    """
    words = (
        bench.select(F.shiftrightunsigned("print", 64 - FILTER_BITS).alias("b"))
        .groupBy(F.shiftright("b", 5).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, int(31 - (b & 31))))").alias("bits")).collect())
    held = np.zeros(1 << (FILTER_BITS - 5), dtype=">u4")
    for row in words:
        held[row["word"]] = row["bits"]
    spans = [r[0] for r in bench.where(F.col("span") < window).select("span").distinct().collect()]
    return held.tobytes(), sorted(spans)


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, item_ids) of each row of documents.

    n_hit counts the words inside any shared run. item_ids holds the ids of the items as
    sorted strings (a null id: empty). Null and empty texts have no words, and neither a null
    item nor an empty benchmark hits. Rows with equal id and text are counted alike.
    """
    counts, hits, owners = benchmark_hits(docs, items, window, gram)
    hits = stage(hits)
    merged = F.aggregate(
        F.sort_array("runs"), F.expr("struct(0L as n, -1L as until)"),
        lambda done, run: F.struct(
            (done["n"] + F.greatest(F.lit(0), run["end"] - F.greatest(run["first"], done["until"]))).alias("n"),
            F.greatest(done["until"], run["end"]).alias("until")),
        lambda done: done["n"])
    runs = hits.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "end")).alias("runs"))
    ids = (
        hits.select("doc_id", "text_key", "passage").distinct().join(owners, "passage")
        .groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
        .agg(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("ids")))
    found = runs.join(ids, runs["doc_id"].eqNullSafe(ids["id"]) & (runs["text_key"] == ids["key"])).select(
        F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), merged.alias("n_hit"),
        F.sort_array("ids").alias("ids"))
    joined = counts.join(
        found, counts["doc_id"].eqNullSafe(found["hit_id"]) & (counts["text_key"] == found["hit_key"]), "left")
    return joined.select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("ids", F.array().cast("array<string>")).alias("item_ids"))


def uncontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that share no window with the benchmark, with all their columns.

    Null and empty texts stay. Rows of equal id and text go or stay together; a null id is an
    id. An empty benchmark, or one of null texts, keeps all rows.
    """
    hit = (
        benchmark_hits(docs, items, **options)[1].select("doc_id", "text_key").distinct()
        .withColumn("hit", F.lit(True)))
    return with_found(docs, hit, "hit", "left_anti")[0].select(*docs.columns)
