"""Packing of token sequences by a swap-based local search that picks the best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.llm.tokens import encoder
from visitmill.sinks.staging import stage

CAPACITY = 2048
SEPARATOR = 0
# Pieces that are packed together; the search sees no further. Bounds a task's memory.
SHARD_PIECES = 16_384

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long, moves long"


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR
) -> DataFrame:
    """Pieces of at most `capacity` ids of each row's text and the separator behind it.

    Only longer documents are cut; their last piece may be shorter. A null text is empty and
    makes one piece of one id. Rows that repeat a doc_id are documents of their own.
    """
    end = int(separator).to_bytes(4, "little")

    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = encoder(vocabulary)
        for batch in batches:
            names = iter(batch.column(0).to_pylist())
            for texts in vocab.encode(batch.column(1)):
                out: tuple[list, ...] = ([], [], [], [], [])
                for ids in texts:
                    doc_id, packed = next(names), ids.tobytes() + end
                    for k, at in enumerate(range(0, len(packed), 4 * capacity)):
                        part = packed[at:at + 4 * capacity]
                        row = (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, PIECES)


def plain_fill(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each document when bins are filled one after another, in the order given."""
    bins = np.zeros(len(lengths), dtype=np.int64)
    number = fill = 0
    for item, length in enumerate(lengths.tolist()):
        if fill + length > capacity:
            number, fill = number + 1, 0
        bins[item], fill = number, fill + length
    return bins


@dataclass
class Search:
    """Local search over bins: documents leave the emptiest bins for fuller ones.

    An exchange takes one document, or two, from a bin into one that is at least as full,
    against nothing or against a shorter one of its documents. That raises the sum of
    squared fills, so the search ends by itself. Of all exchanges of the giver the one that
    raises the sum most is made; moves come before swaps, and swaps of one before those of
    two. The emptiest bin gives until it is empty or nothing helps, then the next one; the
    search is over when no bin can give, or when the free room is less than a bin, so that
    no fewer bins could do.
    """

    lengths: np.ndarray
    bins: np.ndarray
    capacity: int = CAPACITY

    def __post_init__(self) -> None:
        self.fill = np.bincount(self.bins, weights=self.lengths).astype(np.int64)
        #: Exchanges by the number of documents given and taken back, and changes of bin by document.
        self.exchanges = {(1, 0): 0, (1, 1): 0, (2, 1): 0}
        self.moves = np.zeros(len(self.lengths), dtype=np.int64)

    def run(self) -> np.ndarray:
        """The bin of each document at the end."""
        stuck = np.zeros(len(self.fill), dtype=bool)
        changed = False
        while self.capacity * np.count_nonzero(self.fill) - self.fill.sum() >= self.capacity:
            givers = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity) & ~stuck)
            if len(givers):
                giver = int(givers[np.argmin(self.fill[givers])])
                while self.fill[giver] and self._exchange(giver):
                    changed = True
                stuck[giver] = True
            elif changed:
                stuck[:], changed = False, False
            else:
                break
        return self.bins

    def _exchange(self, giver: int) -> bool:
        mine = np.flatnonzero(self.bins == giver)
        own = np.unique(self.lengths[mine])
        room = np.where(self.fill >= self.fill[giver], self.capacity - self.fill, 0)
        room[giver] = 0
        room[self.fill == 0] = 0
        one = self._greatest(own)
        gain = one[room]
        taker = self._best(gain, self.fill, giver)
        if taker is not None:
            return self._moved(giver, mine, [int(gain[taker])], taker, [])
        others = np.flatnonzero(room[self.bins] > 0)
        held, limit = self.lengths[others], (self.lengths + room[self.bins])[others]
        fill = self.fill[self.bins[others]]
        pairs = (own[:, None] + own[None, :])[np.triu_indices(len(own), 1)]
        twice = own[np.array([(self.lengths[mine] == n).sum() > 1 for n in own])]
        for taken, greatest in ((1, one), (2, self._greatest(np.concatenate((pairs, 2 * twice))))):
            total = greatest[np.minimum(limit, self.capacity)]
            back = self._best(total - held, fill, giver)
            if back is not None:
                total = int(total[back])
                lengths = [total] if taken == 1 else self._pair(own, twice, total)
                return self._moved(giver, mine, lengths, int(self.bins[others[back]]), [int(others[back])])
        return False

    def _greatest(self, sums: np.ndarray) -> np.ndarray:
        """For every room the greatest of some lengths that fits, or 0."""
        out = np.zeros(self.capacity + 1, dtype=np.int64)
        sums = sums[sums <= self.capacity]
        out[sums] = sums
        return np.maximum.accumulate(out)

    def _best(self, gain: np.ndarray, fill: np.ndarray, giver: int) -> int | None:
        """The exchange that raises the sum of squared fills most, if any raises it."""
        if not len(gain):
            return None
        raised = np.where(gain > 0, gain * (fill - self.fill[giver] + gain), 0)
        best = int(np.argmax(raised))
        return best if raised[best] > 0 else None

    def _pair(self, own: np.ndarray, twice: np.ndarray, total: int) -> list[int]:
        held, again = set(own.tolist()), set(twice.tolist())
        return next([a, total - a] for a in held if total - a in held and (2 * a != total or a in again))

    def _moved(self, giver: int, mine: np.ndarray, lengths: list[int], taker: int, back: list[int]) -> bool:
        """Make an exchange: documents of some lengths for those numbered in `back`."""
        given: list[int] = []
        for length in lengths:
            given.append(next(int(i) for i in mine if self.lengths[i] == length and i not in given))
        self.bins[given] = taker
        self.bins[back] = giver
        gain = sum(lengths) - int(self.lengths[back].sum())
        self.fill[taker] += gain
        self.fill[giver] -= gain
        self.moves[given + back] += 1
        self.exchanges[len(given), len(back)] += 1
        return True


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Every piece of `docs` (doc_id, text) with its sequence and its place there.

    Pieces are written once, then dealt evenly, whatever their ids or lengths, into as many
    shards as their number asks for. Each shard is packed alone: filled in the order of its
    pieces, then searched until no exchange helps. So a task holds about `shard_pieces` small
    rows at any input size, and at most about one sequence a shard is not full. `moves` says
    how often the search gave the piece to another sequence. Equal pieces, ties and a null
    doc_id need no care: a piece is a row. An empty table gives an empty result. Other
    columns of `docs` are ignored.
    """
    cut = stage(pieces(docs, vocabulary, capacity, separator))
    shards = max(1, -(-cut.count() // shard_pieces))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        lengths = rows["length"].to_numpy()
        search = Search(lengths, plain_fill(lengths, capacity), capacity)
        order = np.argsort(search.run(), kind="stable")
        ends = np.cumsum(lengths[order])
        bins = search.bins[order]
        fresh = np.concatenate(([True], bins[1:] != bins[:-1]))
        begins = ends - lengths[order]
        offset = np.empty(len(rows), dtype=np.int64)
        offset[order] = begins - begins[fresh][np.cumsum(fresh) - 1]
        first = int(rows["shard"].iloc[0]) << 32
        yield rows.drop(columns="shard").assign(
            sequence_id=first + search.bins, offset=offset, moves=search.moves)

    dealt = cut.repartition(shards).withColumn("shard", F.spark_partition_id().cast("long"))
    return dealt.mapInPandas(each, PACKED)
