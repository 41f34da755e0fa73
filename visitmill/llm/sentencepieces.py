"""SentencePiece ids of whole texts by an agenda of merges, and texts of ids.

A text becomes symbols, one per character, and the adjacent pair that is the best piece of the
vocabulary is merged, from an agenda ordered by score, until no pair is a piece. Two
characters that no piece has side by side are never merged into one piece. So a text is cut
between such characters, and each distinct part is encoded once and remembered.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.llm.words import row_slices, text_bytes

# Parts of one generation of the memory of encoded parts; two generations are held.
CACHED = 150_000
# Bytes of text that are encoded together.
SLICE = 1 << 21

#: How a vocabulary writes a space. Here both are the byte of a space.
SPACE_MARK = "▁"
# Kinds of models and pieces in a model file.
MERGES = 2
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

ENCODED = "doc_id long, n_tokens long, ids binary"
DECODED = "doc_id long, n_tokens long, ids binary, text string"


def merged(symbols: str, scores: dict[str, float]) -> list[str]:
    """The pieces into which an agenda merges a text's characters.

    The agenda holds adjacent pairs that are pieces, best score first and the leftmost of
    equal ones. An entry is stale once one of its symbols has grown or gone.
    """
    parts: list[str] = list(symbols)
    count = len(parts)
    after = list(range(1, count + 1))
    before = list(range(-1, count - 1))
    agenda = []
    for left in range(count - 1):
        score = scores.get(parts[left] + parts[left + 1])
        if score is not None:
            agenda.append((-score, left, 2))
    heapq.heapify(agenda)
    while agenda:
        _, left, size = heapq.heappop(agenda)
        right = after[left]
        if not parts[left] or right == count or len(parts[left]) + len(parts[right]) != size:
            continue
        whole = parts[left] = parts[left] + parts[right]
        parts[right] = ""
        right = after[left] = after[right]
        if right < count:
            before[right] = left
            score = scores.get(whole + parts[right])
            if score is not None:
                heapq.heappush(agenda, (-score, left, size + len(parts[right])))
        ahead = before[left]
        if ahead >= 0:
            score = scores.get(parts[ahead] + whole)
            if score is not None:
                heapq.heappush(agenda, (-score, ahead, size + len(parts[ahead])))
    return [p for p in parts if p]


class Pieces:
    """A merge-type vocabulary that leaves texts as they are and has a piece for every byte."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        kinds = {p.type for p in model.pieces}
        rules, training = model.normalizer_spec, model.trainer_spec
        if (training.model_type != MERGES or not training.byte_fallback or training.treat_whitespace_as_suffix
                or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or rules.precompiled_charsmap
                or rules.remove_extra_whitespaces or not rules.add_dummy_prefix or not rules.escape_whitespaces):
            raise ValueError("a merge-type vocabulary with byte pieces and without normalisation is needed")
        texts = [p.piece.replace(SPACE_MARK, " ") for p in model.pieces]
        self.ids = {t: i for i, t in enumerate(texts) if model.pieces[i].type == NORMAL}
        self.scores = {t: model.pieces[i].score for t, i in self.ids.items()}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        #: Whether two ASCII characters, or the last and first byte of others, may be in one piece.
        self.beside = np.ones((256, 256), dtype=bool)
        self.beside[:128, :128] = False
        self.beside[:, 32] = False
        for text in self.ids:
            held = text.encode()
            for a, b in zip(held, held[1:], strict=False):
                self.beside[a, b] = True
        # The unknown piece has no text of its own: a byte that no text has stands for it.
        shown = {CONTROL: b"", UNKNOWN: b"\xff"}
        surfaces = [shown.get(p.type, t.encode()) for p, t in zip(model.pieces, texts, strict=True)]
        for byte, i in enumerate(self.bytes):
            surfaces[i] = bytes([byte])
        self.surface_sizes = np.array([len(s) for s in surfaces], dtype=np.int64)
        self.surface_starts = np.cumsum(self.surface_sizes) - self.surface_sizes
        self.surfaces = np.frombuffer(b"".join(surfaces), np.uint8)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of texts with begin and end ids, one after another, and their bounds; a null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # A text that isn't empty gets a space in front, as the vocabulary has words begin.
        spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(
            pa.scalar("", pa.large_string()), pc.replace_substring(texts, SPACE_MARK, " "),
            pa.scalar(" ", pa.large_string())))
        data, offsets = text_bytes(spaced)
        for first, last in row_slices(offsets, SLICE):
            begin = offsets[first]
            yield self._slice(data[begin:offsets[last]], offsets[first:last + 1] - begin)

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        fresh = np.ones(len(data), dtype=bool)
        fresh[1:] = ~self.beside[data[:-1], data[1:]]
        fresh[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(fresh)
        bounds = np.append(starts, len(data)).astype(np.int32)
        parts = pa.BinaryArray.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = parts.dictionary_encode()
        known = self._known(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy()
        pool = np.frombuffer(b"".join(known), "<u4")
        sizes = np.array([len(k) // 4 for k in known], dtype=np.int64)
        begins = (np.cumsum(sizes) - sizes)[codes] if len(known) else codes
        sizes = sizes[codes]
        ends = np.cumsum(sizes)
        cuts = np.append(0, ends)[np.searchsorted(starts, offsets)]
        # Each text has room for its begin and end ids around those of its parts.
        out = np.empty((ends[-1] if len(ends) else 0) + 2 * rows, dtype="<u4")
        text = np.searchsorted(offsets, starts, "right") - 1
        shift = np.repeat(2 * text + 1, sizes)
        place = np.arange(len(shift))
        out[place + shift] = pool[np.repeat(begins - ends + sizes, sizes) + place]
        bounds = cuts + 2 * np.arange(rows + 1)
        out[bounds[:-1]], out[bounds[1:] - 1] = self.begin, self.end
        return out, bounds

    def _known(self, parts: list[bytes]) -> list[bytes]:
        found = {p: self.old[p] for p in parts if p not in self.young and p in self.old}
        found |= self._merged([p for p in parts if p not in self.young and p not in found])
        before = self.young
        if len(before) + len(found) > CACHED:
            self.old, self.young = before, found
        else:
            self.young = before | found if len(found) > len(before) else before
            self.young.update(found)
        return [found[p] if p in found else before[p] for p in parts]

    def _merged(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new parts. Those that begin with a space are encoded by the library as well."""
        made, asked = [], []
        for k, part in enumerate(parts):
            ids: list[int] = []
            for piece in merged(part.decode(), self.scores):
                if piece in self.ids:
                    ids.append(self.ids[piece])
                else:
                    ids += [self.bytes[b] for b in piece.encode()]
            made.append(ids)
            if part[0] == 32 and len(part) > 1:
                asked.append(k)
        # The library puts a space in front of what it is given.
        theirs = self.library.encode([parts[k][1:].decode() for k in asked], num_threads=1)
        for k, ids in zip(asked, theirs, strict=True):
            if ids != made[k]:
                raise ValueError(f"the library encodes {parts[k]!r} in another way")
        return {p: np.array(ids, "<u4").tobytes() for p, ids in zip(parts, made, strict=True)}

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """Texts of ids, put together from their pieces and compared with the library's."""
        sizes = self.surface_sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.surface_starts[ids] - ends + sizes, sizes)
        held = self.surfaces[at + np.arange(len(at))]
        cuts = np.append(0, ends)[bounds]
        theirs = self.library.decode([ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
                                     num_threads=1)
        raw = held.tobytes()
        for row, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            mine = raw[a + 1:b] if raw[a:a + 1] == b" " else raw[a:b]
            if mine != theirs[row].encode() and not _broken(mine):
                raise ValueError("the library decodes a text in another way")
        return pa.array(theirs, pa.string())


def _broken(text: bytes) -> bool:
    """Whether byte pieces make no characters, or one is unknown; the library chooses how these show."""
    try:
        text.decode()
    except UnicodeDecodeError:
        return True
    return False


@cache
def pieces(path: str) -> Pieces:
    """One vocabulary for a Python worker."""
    return Pieces(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row of `docs` (doc_id, text), begin and end ids included.

    `ids` are little-endian unsigned 32-bit numbers. A null or empty text has the begin and
    the end id alone. Other columns are ignored, and rows stay where they are, one for one.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        for batch in batches:
            done = 0
            for ids, bounds in own.encode(batch.column(1)):
                rows = len(bounds) - 1
                held = pa.BinaryArray.from_buffers(
                    pa.binary(), rows, [None, pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, rows), pa.array(np.diff(bounds)), held],
                    ["doc_id", "n_tokens", "ids"])
                done += rows

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(each, ENCODED)


def decoded(coded: DataFrame, path: str) -> DataFrame:
    """The rows of (doc_id, n_tokens, ids) with the text that the ids stand for; null ids: empty."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        for batch in batches:
            held = pc.fill_null(batch.column(2).cast(pa.large_binary()), b"")
            data, offsets = text_bytes(held.view(pa.large_string()))
            for first, last in row_slices(offsets, SLICE):
                part = np.frombuffer(data[offsets[first]:offsets[last]].tobytes(), "<u4")
                bounds = (offsets[first:last + 1] - offsets[first]) // 4
                rows = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, own.decode(part, bounds)], ["doc_id", "n_tokens", "ids", "text"])

    return coded.select("doc_id", "n_tokens", "ids").mapInArrow(each, DECODED)
