"""Vectorised words: spans and 64-bit hashes of the words of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text whose numpy intermediates are held at once.
SLICE_BYTES = 1 << 20

# An odd base of the polynomial word hash and the multipliers that mix it.
BASE = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9
STEP = 0x94D049BB133111EB

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]


def _powers(base: int) -> np.ndarray:
    factors = np.full(SLICE_BYTES + 1, base, dtype=np.uint64)
    factors[0] = 1
    return factors.cumprod(dtype=np.uint64)


_POWERS, _INVERSES = _powers(BASE), _powers(pow(BASE, -1, 2**64))

#: ASCII white space: space and \\t to \\r; every other byte belongs to a word.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: ASCII digits and letters, and all of what isn't ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(MIX)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(STEP)
    return h ^ (h >> np.uint64(32))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of texts, and where each text begins (one entry more at the end).

    A null is an empty text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    held = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return held[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a longer text makes a range of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def word_spans(
    data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and text number of each word; `word_bytes` says which bytes are words."""
    inside = word_bytes[data]
    fresh = np.ones(len(data) + 1, dtype=bool)
    fresh[1:-1] = ~inside[:-1]
    fresh[offsets] = True
    starts = np.flatnonzero(inside & fresh[:-1])
    last = np.ones(len(data), dtype=bool)
    last[:-1] = ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets <= len(data))] - 1
    last[cuts] = True
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased.

    Differences of prefix sums of byte * BASE^place, divided by BASE^start. The sums are
    made slice by slice, so the memory besides the words' own doesn't grow with the text.
    """
    at_start = np.empty(len(starts), dtype=np.uint64)
    at_end = np.empty(len(ends), dtype=np.uint64)
    carry, scale, inverse = np.uint64(0), np.uint64(1), np.uint64(1)
    by_start = np.empty(len(starts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for begin in range(0, len(data), SLICE_BYTES):
            part = data[begin:begin + SLICE_BYTES]
            sums = np.empty(len(part) + 1, dtype=np.uint64)
            sums[0] = 0
            np.cumsum(_VALUES[part] * _POWERS[:len(part)], out=sums[1:])
            sums *= scale
            sums += carry
            a, b = np.searchsorted(starts, (begin, begin + len(part)))
            places = starts[a:b] - begin
            at_start[a:b] = sums[places]
            by_start[a:b] = _INVERSES[places] * inverse
            a, b = np.searchsorted(ends, (begin + 1, begin + len(part) + 1))
            at_end[a:b] = sums[ends[a:b] - begin]
            carry = sums[-1]
            scale = scale * _POWERS[len(part)]
            inverse = inverse * _INVERSES[len(part)]
        return mixed((at_end - at_start) * by_start)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of n words; the caller leaves out runs that cross texts."""
    count = max(0, len(words) - n + 1)
    out = np.full(count, n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out *= np.uint64(STEP)
            out += words[j:j + count]
        return mixed(out)
