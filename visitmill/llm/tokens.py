"""Token ids of whole texts by a public word-level BPE vocabulary."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

from visitmill.llm.words import row_slices, text_bytes

# Entries of one generation of the memory of encoded pieces; two generations are held.
CACHED = 250_000
# New pieces that are encoded by one call.
JOINED = 256
# Bytes of text that are encoded together.
SLICE = 1 << 22
MARK = b"!"

# Kinds of bytes. ODD ones need the tokenizer's own rules for the run of text they are in.
SPACE, LETTER, DIGIT, SIGN, ODD = range(5)
_KIND = np.full(256, ODD, dtype=np.uint8)
_KIND[33:127] = SIGN
_KIND[48:58] = DIGIT
_KIND[65:91] = _KIND[97:123] = LETTER
_KIND[[9, 10, 11, 12, 13, 32]] = SPACE
_KIND[39] = ODD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
    """The pieces into which the vocabulary splits texts, lower-cased, and their text numbers.

    Letters of ASCII and Latin-1 have one lower case and one composition, so runs of them,
    single digits and runs of other printable ASCII are pieces. A run without white space
    that has any other byte is left as it is, as one piece.
    """
    kind, lower = _KIND[data], _LOWER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    capital = lead[data[lead + 1] < 0x9F] + 1
    lower[capital] = data[capital] + 0x20
    first = np.zeros(len(data), dtype=bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    if (kind == ODD).any():
        held = kind != SPACE
        run = np.cumsum(first | (held & np.concatenate(([True], ~held[:-1]))))
        odd = np.zeros(run[-1] + 1, dtype=bool)
        odd[run[kind == ODD]] = True
        odd = odd[run] & held
        kind[odd] = ODD
        lower[odd] = data[odd]
    first[0] = True
    first[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    kept = kind != SPACE
    starts = np.flatnonzero(first & kept)
    places = np.cumsum(kept) - kept
    bounds = np.concatenate((places[starts], [kept.sum()])).astype(np.int32)
    held = pa.BinaryArray.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(lower[kept])])
    return held, np.searchsorted(offsets, starts, "right") - 1


class Encoder:
    """Ids of many texts at once, each distinct piece encoded once and remembered.

    The vocabulary drops white space and ends every piece at it, so a text's ids are those of
    its pieces one after another. Texts that hold a special token's name go through the
    tokenizer as a whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.mark, = self.merges.encode(MARK.decode()).ids
        self.markers = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, texts: pa.Array) -> Iterator[list[np.ndarray]]:
        """Ids of each text (a null is empty), some texts at a time."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        data, offsets = text_bytes(texts)
        for first, last in row_slices(offsets, SLICE):
            begin = offsets[first]
            yield self._slice(data[begin:offsets[last]], offsets[first:last + 1] - begin)

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        rows = len(offsets) - 1
        if not len(data):
            return [np.zeros(0, "<u4")] * rows
        pieces, text = _pieces(data, offsets)
        coded = pieces.dictionary_encode()
        known = self._known(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy()
        pool = np.frombuffer(b"".join(known), "<u4")
        bounds = np.concatenate(([0], np.cumsum([len(k) // 4 for k in known]))).astype(np.int64)
        sizes = (bounds[1:] - bounds[:-1])[codes]
        ends = np.cumsum(sizes)
        places = np.repeat(bounds[:-1][codes] - ends + sizes, sizes)
        places += np.arange(len(places))
        ids = pool[places]
        cuts = np.concatenate(([0], ends))[np.searchsorted(text, np.arange(rows + 1))]
        out = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        held = data.tobytes()
        for marker in self.markers:
            at = held.find(marker.encode())
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                out[row] = self._alone(held[offsets[row]:offsets[row + 1]])
                at = held.find(marker.encode(), int(offsets[row + 1]))
        return out

    def _alone(self, text: bytes) -> np.ndarray:
        return np.array(self.whole.encode(text.decode(), add_special_tokens=False).ids, "<u4")

    def _known(self, pieces: list[bytes]) -> list[bytes]:
        found = {}
        for piece in pieces:
            if piece not in self.young and piece in self.old:
                found[piece] = self.old[piece]
        found |= self._encoded([p for p in pieces if p not in self.young and p not in found])
        if len(self.young) + len(found) > CACHED:
            before = self.young
            self.old, self.young = before, found
            return [found[p] if p in found else before[p] for p in pieces]
        self.young |= found
        return [self.young[p] for p in pieces]

    def _encoded(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """One call for many plain pieces, parted by a mark that is one id and in no other."""
        out, plain = {}, []
        for piece in pieces:
            if MARK in piece or not piece.isalpha() and _odd(piece):
                out[piece] = self._alone(piece).tobytes()
            else:
                plain.append(piece)
        for k in range(0, len(plain), JOINED):
            part = plain[k:k + JOINED]
            text = b" ! ".join(part).decode()
            ids = np.array(self.merges.encode_batch_fast([text])[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(ids == self.mark)).tolist()
            held = ids.tobytes()
            out |= {p: held[a:b] for p, a, b in zip(
                part, [0, *(c + 4 for c in cuts)], [*cuts, len(held)], strict=True)}
        return out


_SAFE = bytes(range(33, 39)) + bytes(range(40, 127))


def _odd(piece: bytes) -> bool:
    """Whether a piece is a run that was left as it is."""
    if not piece.translate(None, _SAFE):
        return False
    rest = piece.decode().translate(_DROP)
    return bool(rest)


_DROP = {c: None for c in [*range(33, 39), *range(40, 127), *range(0xDF, 0xF7), *range(0xF8, 0x100)]}


@cache
def encoder(path: str) -> Encoder:
    """One encoder for a Python worker."""
    return Encoder(path)
