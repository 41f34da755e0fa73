"""Line dedup by pairwise alignment of documents that share rare lines."""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Hashable, Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.llm.rows import keyed, with_found
from visitmill.sinks.staging import stage

# Words of the least common block that is deleted.
MIN_WORDS = 20
# Levels of unique lines between unique lines that an alignment follows.
LEVELS = 32

LINES = "doc_id long, text_key long, hashes array<long>, words array<int>, runs array<long>, begins array<int>"


def least_runs(hashes: Sequence[int], words: Sequence[int], min_words: int) -> list[tuple[int, int, int]]:
    """The least runs of lines with `min_words` words, as (hash, begin, end) in order.

    One from each line with words onwards, and one from each backwards. A line that has as
    many words is a run of its own, under its own hash. Whatever surrounds it, every line
    with words of a block of at least `min_words` words is in such a run within the block.
    """
    packed = array("q", hashes).tobytes()
    found = set()

    def add(begin: int, end: int) -> None:
        name = hashes[begin] if end == begin + 1 else xxhash.xxh3_64_intdigest(packed[8 * begin:8 * end]) - 2**63
        found.add((name, begin, end))

    end = total = 0
    for begin, count in enumerate(words):
        while total < min_words and end < len(words):
            total += words[end]
            end += 1
        if total < min_words:
            break
        if count:
            add(begin, end)
        total -= count
    begin, total = len(words), 0
    for last in range(len(words) - 1, -1, -1):
        while total < min_words and begin > 0:
            begin -= 1
            total += words[begin]
        if total < min_words:
            break
        if words[last]:
            add(begin, last + 1)
        total -= words[last]
    return sorted(found, key=lambda run: run[1:])


def line_hashes(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, hashes, words, runs, begins): each line's 64-bit hash and number of words.

    Lines are split at \\n and compared without white space at their ends; a line without a
    word has hash zero. `runs` are the distinct hashes of `least_runs`, `begins` the lines at
    which each first begins. A null text has no lines.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            hashes, words, runs, begins = [], [], [], []
            for text in batch.column(2).cast(pa.large_binary()):
                lines = (text.as_py() or b"").split(b"\n")
                counts = [len(line.split()) for line in lines]
                words.append(counts)
                hashes.append([
                    digest(line.strip()) - 2**63 if n else 0
                    for line, n in zip(lines, counts, strict=True)])
                first = {name: begin for name, begin, _ in reversed(least_runs(hashes[-1], counts, min_words))}
                runs.append(list(first))
                begins.append(list(first.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hashes, pa.list_(pa.int64())),
                 pa.array(words, pa.list_(pa.int32())), pa.array(runs, pa.list_(pa.int64())),
                 pa.array(begins, pa.list_(pa.int32()))],
                ["doc_id", "text_key", "hashes", "words", "runs", "begins"])

    return keyed(docs, "text").where("text is not null").mapInArrow(each, LINES)


def shared_runs(lines: DataFrame) -> DataFrame:
    """(doc_id, text_key, run, first, begin): the runs of each document that an earlier one has.

    Documents meet through the hashes of `least_runs`: a line, or as many short ones as are
    rare only together. Each holder of a run is paired with the run's first holder, of which
    `begin` is the line where it begins there. So rows grow with the lines, never with the
    square of a group, and no run is too frequent to be followed to its first holder. Nothing
    else of the first holder travels, as the lines of a run are those of the later document.
    The first holder is an aggregate that combines before its shuffle, and the join back to
    the holders may split.
    """
    held = lines.select(
        "doc_id", "text_key", F.explode(F.arrays_zip("runs", "begins")).alias("r")
    ).select("doc_id", "text_key", F.col("r.runs").alias("run"), F.col("r.begins").alias("at"))
    first = (
        held.groupBy("run").agg(
            F.count(F.lit(1)).alias("holders"), F.min(F.struct("doc_id", "text_key", "at")).alias("first"))
        .where("holders > 1"))
    other = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")))
    return held.join(first, "run").where(other).select(
        "doc_id", "text_key", "run", F.struct("first.doc_id", "first.text_key").alias("first"),
        F.col("first.at").alias("begin"))


def common_blocks(a: Sequence, b: Sequence) -> list[tuple[int, int, int]]:
    """Patience alignment of two lists of lines: (start in a, start in b, length) of each block.

    Equal lines at both ends are matched; between them, lines that occur once in either are
    anchors where their order agrees, and the same goes on between the anchors. Parts in
    which no line occurs once in either are left out, as are those below LEVELS levels, so
    the work is at most LEVELS times the lines and their sorting. None is no line.
    """
    matched: list[tuple[int, int]] = []
    ranges = [(0, len(a), 0, len(b), 0)]
    while ranges:
        a0, a1, b0, b1, level = ranges.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0] and a[a0] is not None:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1] and a[a1 - 1] is not None:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1 or level == LEVELS:
            continue
        anchors = _in_order(_anchors(a, a0, a1, b, b0, b1))
        if anchors:
            starts = [(a0, b0), *anchors]
            ends = [*anchors, (a1, b1)]
            ranges += [(p, r, q, s, level + 1) for (p, q), (r, s) in zip(starts, ends, strict=True)]
    blocks: list[tuple[int, int, int]] = []
    for i, j in sorted(matched):
        if blocks and (i, j) == (blocks[-1][0] + blocks[-1][2], blocks[-1][1] + blocks[-1][2]):
            blocks[-1] = (*blocks[-1][:2], blocks[-1][2] + 1)
        else:
            blocks.append((i, j, 1))
    return blocks


def repeated_in(
    mine: Sequence[int], words: Sequence[int], shared: Sequence[tuple[Hashable, int, int]], min_words: int
) -> list[int]:
    """Numbers of the lines of `mine` that are in blocks of at least `min_words` words of earlier documents.

    `shared` names the least runs that an earlier document has: (document, line where the run
    begins there, run). The lines of each such document that lie in shared runs are put in
    their order, others between them are unknown, and `mine` is aligned with them. Blocks
    that the order of the alignment excludes, second copies of a block and blocks among lines
    that none tells apart are taken from the shared runs themselves, so every line with words
    of a common block is found.
    """
    places: dict[int, list[tuple[int, int]]] = {}
    for name, begin, end in least_runs(mine, words, min_words):
        places.setdefault(name, []).append((begin, end))
    documents: dict[Hashable, dict[int, int]] = {}
    for document, at, run in shared:
        begin, end = places[run][0]
        documents.setdefault(document, {}).update(zip(range(at, at + end - begin), mine[begin:end], strict=True))
    out: set[int] = set()
    for known in documents.values():
        theirs: list[int | None] = []
        last = None
        for at in sorted(known):
            if last is not None and at != last + 1:
                theirs.append(None)
            theirs.append(known[at])
            last = at
        for start, _, length in common_blocks(mine, theirs):
            if sum(words[start:start + length]) >= min_words:
                out.update(range(start, start + length))
    for _, _, run in shared:
        for begin, end in places[run]:
            out.update(range(begin, end))
    return sorted(out)


def _anchors(a, a0, a1, b, b0, b1) -> list[tuple[int, int]]:
    """Places of the lines that occur once in either part."""
    once: list[dict] = []
    for lines, begin, end in ((a, a0, a1), (b, b0, b1)):
        seen: dict = {}
        for k in range(begin, end):
            seen[lines[k]] = -1 if lines[k] in seen else k
        once.append(seen)
    return [(i, once[1][line]) for line, i in once[0].items()
            if i >= 0 and line is not None and once[1].get(line, -1) >= 0]


def _in_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs that rises on both sides (patience piles)."""
    pairs.sort()
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back[k] = piles[pile - 1] if pile else -1
        tops[pile:pile + 1] = [j]
        piles[pile:pile + 1] = [k]
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, lines): numbers of the lines, from 0, that repeat an earlier document.

    A document is earlier by its doc_id (null first), with equal ids by a hash of its text.
    All lines with words go that are in a block of lines, of at least `min_words` words,
    which any earlier document has as well; lines without words go where an alignment has
    them in such a block. The earliest holder of a block keeps it. Rows with the same id and
    text are one document and are treated alike.
    """
    lines = stage(line_hashes(docs, min_words))
    one = lines.dropDuplicates(["doc_id", "text_key"])
    # As many as the document has runs.
    gathered = shared_runs(one).groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("first", "begin", "run")).alias("shared"))
    later = gathered.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "shared")
    matched = one.join(
        later, one["doc_id"].eqNullSafe(later["id"]) & (one["text_key"] == later["key"])
    ).select("doc_id", "text_key", "hashes", "words", "shared")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for mine, words, shared in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                runs = [((r["first"]["doc_id"], r["first"]["text_key"]), r["begin"], r["run"]) for r in shared]
                found.append(repeated_in(mine, words, runs, min_words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))],
                ["doc_id", "text_key", "lines"])

    return matched.mapInArrow(each, "doc_id long, text_key long, lines array<int>")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with the repeated lines cut out of `text`; all rows and other columns stay.

    A document of which every line goes keeps an empty text. Null texts stay null.
    """
    joined, cut = with_found(docs, repeated_lines(docs, min_words), "lines")
    kept = F.array_join(
        F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(cut, i)), "\n")
    return joined.withColumn("text", F.when(F.col(cut).isNull(), F.col("text")).otherwise(kept)).select(
        *docs.columns)
