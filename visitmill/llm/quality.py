"""Quality rules judged by an isolation forest over rule statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from visitmill.llm.rows import near_ids
from visitmill.llm.words import row_slices, text_bytes
from visitmill.sinks.staging import stage

TREES = 150
# What all rows of a tree weigh together, and the share of it that low-quality rows have: little,
# so that they are alone after few splits.
SUBSAMPLE = 256
ANOMALIES = 0.05
# Splits on a path, at most, and the weight up to which a node isn't split.
DEPTH = 8
ALONE = 1.0
# Share of the good labelled rows that the threshold may reject, at most.
GOOD_LOST = 0.02
# Ranges of scores that are summed apart on the way to the threshold.
CELLS = 1 << 16
SEED = 17
# Base rules: the least number of words, and the largest percentage of words in repeats.
LEAST_WORDS = 50
REPEATED_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = tuple(f"f{k}" for k in range(8))
_SPACES, _SYMBOLS, _CRIES, _STOPS = (
    bytes([9, 10, 11, 12, 13, 32]), b"#*$%&|<>", b"!?", b",.;:")


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words in 3-word windows that occur at least twice."""
    if len(ids) < 3:
        return 0
    if distinct < 2_000_000:
        keys = (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)[1]
        keys = pairs[:-1] * distinct + ids[2:]
    _, group, counts = np.unique(keys, return_inverse=True, return_counts=True)
    often = counts[group] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        covered[k:len(ids) - 2 + k] |= often
    return int(covered.sum())


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The five counts (rows by COUNTS) and the forest's features of each text.

    Features are rates: characters, symbols, cries (!?), stops (,.;:) and repeated words per
    word, upper case among ASCII letters, repeated lines per line with a word, distinct
    words per word. A text without a word has zeros.
    """
    data, offsets = text_bytes(texts)
    rows = len(offsets) - 1
    counts, sums = np.zeros((rows, 5), np.int64), np.zeros((rows, 8), np.int64)
    classes = np.zeros((256, 6), dtype=bool)
    for k, chars in enumerate((_SYMBOLS, _CRIES, _STOPS)):
        classes[list(chars), k] = True
    classes[65:91, 3] = classes[97:123, 4] = True
    classes[:, 5] = [b & 0xC0 != 0x80 and b not in _SPACES for b in range(256)]
    for first, last in row_slices(offsets):
        part = data[offsets[first]:offsets[last]]
        cuts = offsets[first:last + 1] - offsets[first]
        for k in range(6):
            running = np.concatenate(([0], np.cumsum(classes[:, k][part])))
            sums[first:last, k] = np.diff(running[cuts])
    held = data.tobytes()
    for row in range(rows):
        text = held[offsets[row]:offsets[row + 1]]
        seen: dict[bytes, int] = {}
        words = text.split()
        ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
        lines = [line for line in text.split(b"\n") if line.strip()]
        counts[row] = (len(words), 0, 0, len(lines) - len(set(lines)), repeated_words(ids, len(seen)))
        sums[row, 6:] = len(seen), len(lines)
    counts[:, 1], counts[:, 2] = sums[:, 5], sums[:, 0]
    words = np.maximum(counts[:, 0], 1)
    features = np.stack([
        counts[:, 1] / words, sums[:, 0] / words, sums[:, 1] / words, sums[:, 2] / words,
        counts[:, 4] / words, sums[:, 3] / np.maximum(sums[:, 3] + sums[:, 4], 1),
        counts[:, 3] / np.maximum(sums[:, 7], 1), sums[:, 6] / words], axis=1)
    return counts, features


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > REPEATED_PERCENT * counts[:, 0])


def mean_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n points."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """Trees as arrays of nodes; a leaf points to itself and holds its path length."""

    feature: np.ndarray
    split: np.ndarray
    below: np.ndarray
    above: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    depth: int
    threshold: float

    def places(self, features: np.ndarray, steps: int) -> Iterator[np.ndarray]:
        """The node of each row after so many steps, tree by tree."""
        rows = np.arange(len(features))
        for root in self.roots:
            node = np.full(len(features), root)
            for _ in range(steps):
                low = features[rows, self.feature[node]] < self.split[node]
                node = np.where(low, self.below[node], self.above[node])
            yield node

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1: 2^(-mean path / mean path of a random tree)."""
        total = np.zeros(len(features))
        for node in self.places(features, self.depth):
            total += self.path[node]
        return 2.0 ** (-total / max(len(self.roots), 1) / mean_path(SUBSAMPLE))

    def kept(self, counts: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scores = self.scores(features)
        return ~base_failed(counts) & (scores <= self.threshold), scores


def fit(docs: DataFrame, labels: DataFrame) -> Forest:
    """Fit on the documents of all labels (doc_id, quality); no row is left out or sampled.

    A null id or quality is left out; of contradicting labels the lowest counts. Only rows
    that pass the base rules are used, since the forest judges no others. A hash of the id
    halves them: on one half the trees grow, on the other the threshold is calibrated.
    Without both kinds of rows in either half nothing can be calibrated, and no row is an
    anomaly. What comes to the driver is as large as the forest, not as the labels.
    """
    points = _points(docs, labels)
    rows = {(r["held"], r["good"]): r["count"] for r in points.groupBy("held", "good").count().collect()}
    if len(rows) < 4:
        return _forest([], 0, 1.0)
    forest = grow(points.where("not held"), rows[False, True], rows[False, False])
    scored = _scored(points.where("held"), forest)
    return replace(forest, threshold=best_threshold(scored, rows[True, True], rows[True, False]))


def _points(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(held, good, features) of each labelled document that passes the base rules.

    Texts stay where they are: only their features meet the labels.
    """
    chosen = stage(
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")))
    texts = near_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), chosen)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(features.tolist(), pa.list_(pa.float64()))],
                ["doc_id", "features"]).filter(pa.array(~base_failed(counts)))

    return stage(
        texts.mapInArrow(each, "doc_id long, features array<double>").join(chosen, "doc_id")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("features").alias("features"))
        .select((F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(2)) == 1).alias("held"),
                (F.col("quality") > 0).alias("good"),
                *[F.col("features")[k].alias(name) for k, name in enumerate(FEATURES)]))


def grow(points: DataFrame, n_good: int, n_bad: int) -> Forest:
    """A forest of which every tree holds all the points (good, features), level by level.

    A node is split at random: a random feature, at a random place between its ends. Instead
    of drawing few low-quality rows into a subsample, they weigh little: all rows of a tree
    weigh SUBSAMPLE, the low-quality ones ANOMALIES of it, and a node of weight ALONE or less
    ends a path. A pass over the points finds the ends and the weight of all nodes of a level.
    """
    random = np.random.default_rng(SEED)
    by_weight = [mean_path(n) for n in range(SUBSAMPLE + 1)]
    good_weight, bad_weight = SUBSAMPLE * (1 - ANOMALIES) / n_good, SUBSAMPLE * ANOMALIES / n_bad
    nodes: list[tuple] = [(0, 0.0, k, k, 0.0) for k in range(TREES)]
    first = 0
    for level in range(DEPTH + 1):
        ends, first = _ends(points, _forest(nodes, level, 1.0), first), len(nodes)
        for r in ends:
            weight = good_weight * r["good"] + bad_weight * r["bad"]
            low, high = r[3:11], r[11:]
            nodes[r["node"]] = (0, 0.0, r["node"], r["node"], level + np.interp(weight, range(SUBSAMPLE + 1), by_weight))
            wide = [k for k in range(len(low)) if high[k] > low[k]]
            if level < DEPTH and weight > ALONE and wide:
                k = int(random.choice(wide))
                at = random.uniform(low[k], high[k])
                if low[k] < at <= high[k]:
                    below, above = len(nodes), len(nodes) + 1
                    nodes += [(0, 0.0, n, n, 0.0) for n in (below, above)]
                    nodes[r["node"]] = (k, at, below, above, 0.0)
        if first == len(nodes):
            break
    return _forest(nodes, DEPTH, 1.0)


def _forest(nodes: list[tuple], depth: int, threshold: float) -> Forest:
    """A forest of nodes (feature, split, below, above, path), of which the first are the roots."""
    columns = [np.array(c) for c in zip(*nodes, strict=True)] if nodes else [np.zeros(1)] * 5
    feature, below, above = (columns[k].astype(np.int64) for k in (0, 2, 3))
    roots = np.arange(TREES if nodes else 0)
    return Forest(feature, columns[1], below, above, columns[4], roots, depth, threshold)


def _ends(points: DataFrame, forest: Forest, first: int) -> list[Row]:
    """(node, good, bad, least features, largest features) of the last level, from node `first` on.

    A task sends a row for each node that it met, at most TREES * 2^level.
    """
    sent = points.sparkSession.sparkContext.broadcast(forest)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        n = len(trees.path) - first
        rows = np.zeros((2, n), np.int64)
        low, high = np.full((n, len(FEATURES)), np.inf), np.full((n, len(FEATURES)), -np.inf)
        for batch in batches:
            good, features = _arrays(batch)
            for node in trees.places(features, trees.depth):
                order = np.argsort(node, kind="stable")
                order = order[np.searchsorted(node[order], first):]
                if not len(order):
                    continue
                starts = np.flatnonzero(np.diff(node[order], prepend=-1))
                at, part = node[order[starts]] - first, features[order]
                rows[0, at] += np.add.reduceat(good[order], starts)
                rows[1, at] += np.add.reduceat(1 - good[order], starts)
                low[at] = np.minimum(low[at], np.minimum.reduceat(part, starts))
                high[at] = np.maximum(high[at], np.maximum.reduceat(part, starts))
        met = np.flatnonzero(rows.sum(axis=0))
        columns = [met + first, *rows[:, met], *low[met].T.copy(), *high[met].T.copy()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    lows, highs = [f"low_{f}" for f in FEATURES], [f"high_{f}" for f in FEATURES]
    names = ["node", "good", "bad", *lows, *highs]
    kinds = ", ".join([*[f"{c} long" for c in names[:3]], *[f"{c} double" for c in names[3:]]])
    return points.select("good", *FEATURES).mapInArrow(each, kinds).groupBy("node").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad"),
        *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs]).orderBy("node").collect()


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Whether each point is good, 0 or 1, and its features."""
    good, *features = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
    return good.astype(np.int64), np.stack(features, axis=1)


def _scored(points: DataFrame, forest: Forest) -> DataFrame:
    """(score, good) of each point."""
    sent = points.sparkSession.sparkContext.broadcast(forest)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, features = _arrays(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sent.value.scores(features)), pa.array(good == 1)], ["score", "good"])

    return points.select("good", *FEATURES).mapInArrow(each, "score double, good boolean")


def best_threshold(scored: DataFrame, n_good: int, n_bad: int) -> float:
    """The score up to which rows (score 0 to 1, good) are best kept.

    It has the best sum of good rows kept and bad rows rejected, among those that lose at
    most GOOD_LOST of the good ones; of equals the least. Every score counts: rows are summed
    within CELLS ranges of scores, and the ranges, which are few, one after the other.
    """
    places = stage(scored.groupBy("score").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
        .withColumn("cell", F.floor(F.col("score") * CELLS)))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("cell").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    cells = places.groupBy("cell").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).select(
        "cell", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("good", "bad")])
    kept, let = (
        (F.col(f"{c}_before") + F.sum(c).over(within)) / F.lit(n) for c, n in (("good", n_good), ("bad", n_bad)))
    best = places.join(F.broadcast(cells), "cell").select("score", kept.alias("kept"), let.alias("let")).select(
        "score", F.when(F.col("kept") >= 1 - GOOD_LOST, F.col("kept") + (1 - F.col("let"))).otherwise(-1.0).alias("gain"))
    return best.orderBy(F.desc("gain"), "score").first()["score"]


def _sent(docs: DataFrame, forest: Forest) -> Broadcast:
    """The forest has a bounded size: TREES trees of less than 2^(DEPTH + 1) nodes."""
    return docs.sparkSession.sparkContext.broadcast(forest)


def judged(docs: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, counts, base_failed, kept, anomaly) of each row of documents.

    A null or empty text has no words and fails the base rules. Repeated rows each give a
    row. Other columns of `docs` are ignored.
    """
    sent = _sent(docs, forest)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features = statistics(batch.column(1))
            kept, scores = sent.value.kept(counts, features)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, counts.T.copy()), pa.array(base_failed(counts)),
                 pa.array(kept), pa.array(scores)],
                ["doc_id", *COUNTS, "base_failed", "kept", "anomaly"])

    kinds = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        each, f"doc_id long, {kinds}, base_failed boolean, kept boolean, anomaly double")


def accepted(docs: DataFrame, forest: Forest) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns; nothing is shuffled.

    Null and empty texts go. Repeated rows are judged alike, and an empty table stays empty.
    """
    sent, place = _sent(docs, forest), docs.columns.index("text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, _ = sent.value.kept(*statistics(batch.column(place)))
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(each, docs.schema)
