"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill.llm.words import row_slices, text_bytes

# Hash buckets of n-grams of 2 to 4 bytes; the size of a classifier.
BUCKETS = 1 << 13
GRAMS = (2, 3, 4)
# Count that every bucket has besides its own, and nats by which a mean log-odds is scaled.
PRIOR = 0.5
SCALE = 4.0
# A prediction is ambiguous if its share of the decoded weight is less.
CLEAR = 0.6
# Bits of a codeword for each bit of a language's number.
BITS = 10
UNKNOWN = "und"
# Rows whose histograms are held at once.
ROWS = 128

_FOLDED = np.full(256, 32, dtype=np.uint8)
_FOLDED[97:123] = _FOLDED[65:91] = np.arange(97, 123)
_FOLDED[128:] = np.arange(128, 256)


def histograms(texts: pa.Array) -> Iterator[np.ndarray]:
    """Bucket counts of the n-grams of each text (rows by BUCKETS), some texts at a time.

    Letters are lower-cased (ASCII and Latin-1); other ASCII counts as space, and n-grams
    that begin with two spaces are left out.
    """
    data, offsets = text_bytes(texts)
    for begin, end in row_slices(offsets):
        for first in range(begin, end, ROWS):
            last = min(first + ROWS, end)
            part = _FOLDED[data[offsets[first]:offsets[last]]]
            lead = np.flatnonzero(part[:-1] == 0xC3)
            capital = lead[(part[lead + 1] >= 0x80) & (part[lead + 1] <= 0x9E)] + 1
            part[capital] += 0x20
            row = np.repeat(np.arange(last - first), np.diff(offsets[first:last + 1]))
            total = np.zeros((last - first) * BUCKETS, dtype=np.int64)
            value = part.astype(np.uint32)
            for n in range(2, max(GRAMS) + 1):
                count = len(part) - n + 1
                if count <= 0:
                    break
                value = (value[:count] << np.uint32(8)) | part[n - 1:]
                if n in GRAMS:
                    whole = (row[:count] == row[n - 1:]) & ~((part[:count] == 32) & (part[1:count + 1] == 32))
                    place = (value[whole] * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(19)
                    total += np.bincount(row[:count][whole] * BUCKETS + place, minlength=len(total))
            yield total.reshape(-1, BUCKETS)


@dataclass(frozen=True)
class Model:
    """Languages, their codewords of 1 and -1, and a weight for each bucket and bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest codeword's number and its share of the decoded weight, per row.

        Each bit's margin is the mean log-odds of the n-grams. The distance to a codeword is
        the logistic loss of its bits, weighted by how well each classifier parts the
        languages that it was made for.
        """
        margins = SCALE * (counts @ self.weights) / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        losses = np.logaddexp(0, -margins[:, None, :] * self.code[None]) @ self.trust
        share = np.exp(losses.min(axis=1, keepdims=True) - losses)
        share /= share.sum(axis=1, keepdims=True)
        best = losses.argmin(axis=1)
        return best, share[np.arange(len(best)), best]


def codewords(languages: int) -> np.ndarray:
    """A codeword of 1 and -1 for each language; every bit has both values.

    A bit for each way to part the languages in two, as far as there are no more ways than
    bits; otherwise the best of some random codes by its least distance.
    """
    if languages < 2:
        return np.ones((languages, 1))
    bits = BITS * int(np.ceil(np.log2(languages)))
    if 2 ** (languages - 1) - 1 <= bits:
        columns = np.arange(1, 2 ** (languages - 1))
        return np.stack([np.where(columns >> k & 1, 1.0, -1.0) for k in range(languages)])
    random = np.random.default_rng(languages)
    best, distance = np.zeros((0, 0)), -1
    for _ in range(200):
        code = random.choice((-1.0, 1.0), (languages, bits))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        apart = (code.shape[1] - code @ code.T) / 2
        least = apart[~np.eye(languages, dtype=bool)].min()
        if least > distance:
            best, distance = code, least
    return best


def fit(docs: DataFrame) -> Model:
    """Binary n-gram classifiers for the bits of the languages' codewords.

    `docs` has (text, lang); rows without either are left out. Every text is counted whole, by
    language and bucket; tasks add up their own texts before the shuffle, and the driver
    gets a row for each language and bucket. A bit's weights are the log-odds of an n-gram
    in the languages on its two sides, each language counting alike.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            first = 0
            for counts in histograms(batch.column(0)):
                here = langs[first:first + len(counts)]
                for lang in set(here):
                    sums[lang] = sums.get(lang, 0) + counts[here == lang].sum(axis=0)
                first += len(counts)
        for lang, total in sums.items():
            places = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(places), pa.string()), pa.array(places), pa.array(total[places])],
                ["lang", "bucket", "n"])

    rows = (
        docs.where("text is not null and lang is not null").select("text", "lang")
        .mapInArrow(each, "lang string, bucket long, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(rows["lang"].unique())
    counts = np.full((len(languages), BUCKETS), PRIOR)
    np.add.at(counts, (np.searchsorted(languages, rows["lang"]), rows["bucket"].to_numpy(dtype=np.int64)),
              rows["n"].to_numpy(dtype=float))
    rates = counts / counts.sum(axis=1, keepdims=True) if languages else counts
    code = codewords(len(languages))
    weights = np.zeros((BUCKETS, code.shape[1]))
    if len(languages) > 1:
        for bit in range(code.shape[1]):
            sides = [rates[code[:, bit] == side].mean(axis=0) for side in (1, -1)]
            weights[:, bit] = np.log(sides[0]) - np.log(sides[1])
    margins = (rates @ weights) * code
    trust = np.maximum(margins.min(axis=0, initial=np.inf), 0) if len(languages) > 1 else np.ones(code.shape[1])
    trust = trust / trust.mean() if trust.sum() > 0 else np.ones(code.shape[1])
    return Model(languages, code, weights, trust)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of each row's whole text.

    A null text or one without a letter is `und`, with score 0; so is any text if no language
    was learned. score is the decoded share of the chosen language, ambiguous whether it is
    below CLEAR. Other columns of `docs` are ignored; repeated rows each give a row.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            lettered = np.array(
                [any(map(str.isalpha, t.as_py() or "")) for t in batch.column(1)], dtype=bool)
            best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
            if model.languages:
                for counts in histograms(batch.column(1)):
                    found = model.predict(counts)
                    best.append(found[0])
                    score.append(found[1])
            else:
                lettered[:] = False
            known, share = iter(np.concatenate(best)), iter(np.concatenate(score))
            names = [model.languages[next(known)] if model.languages else UNKNOWN for _ in lettered]
            shares = np.array([next(share) if model.languages else 0.0 for _ in lettered])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 pa.array([n if ok else UNKNOWN for n, ok in zip(names, lettered, strict=True)], pa.string()),
                 pa.array(np.where(lettered, shares, 0.0), pa.float64()),
                 pa.array(np.where(lettered, shares, 0.0) < CLEAR)],
                ["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        each, "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: the CRC of its id's text leaves 2 by 4.

    A null id is not held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
