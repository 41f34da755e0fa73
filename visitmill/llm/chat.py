"""Chat formatting by token-level assembly."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The control strings of the template. Their ids follow the vocabulary's.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
BEGIN, END, ROLE, TEXT = range(4)
TRAINED = "assistant"

#: A control string with any number of backslashes behind its first character.
_CONTROL = re.compile(r"(<)(\\*/?s>)|(\[)(\\*/?INST\])")
_ESCAPED = re.compile(r"(<)\\(\\*/?s>)|(\[)\\(\\*/?INST\])")

TURNS = "conv_id long, turn long, role string, text string"
ASSEMBLED = "conv_id long, turn long, rank_role string, rank_text string, ids array<int>, loss array<boolean>"


def escaped(text: str) -> str:
    """The text with one more backslash in each control string, so that none is left bare."""
    return _CONTROL.sub(lambda m: f"{m[1] or m[3]}\\{m[2] or m[4]}", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"{m[1] or m[3]}{m[2] or m[4]}", text) if "\\" in text else text


class Codec:
    """A byte-level vocabulary from a file of ranks, with reserved ids for the control strings."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.reserved = max(ranks.values()) + 1
        shown = [b""] * self.reserved + [c.encode() for c in CONTROLS]
        for token, rank in ranks.items():
            shown[rank] = token
        #: The bytes of each id, and how many characters begin in them.
        self.sizes = np.array([len(t) for t in shown], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(shown), np.uint8)
        begun = np.concatenate(([0], np.cumsum((self.bytes & 0xC0) != 0x80)))
        self.chars = begun[self.starts + self.sizes] - begun[self.starts]

    def turn(self, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and loss mask of one turn: [INST] role [/INST] text </s>.

        Segments are encoded apart, so no merge reaches across a mark and no text can make a
        reserved id. The mask is the text's segment, placed by the prefix sums of lengths.
        """
        plain = self.encoding.encode_ordinary
        segments = [[self.reserved + ROLE], plain(escaped(role)), [self.reserved + TEXT],
                    plain(escaped(text)), [self.reserved + END]]
        ends = np.cumsum([len(s) for s in segments])
        place = np.arange(ends[-1])
        mask = (place >= ends[2]) & (place < ends[3]) & (role == TRAINED)
        return np.array([i for s in segments for i in s], dtype=np.int32), mask

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The formatted texts of spans of ids, decoded together."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - ends + sizes, sizes)
        raw = self.bytes[at + np.arange(len(at))].tobytes()
        cuts = np.append(0, ends)[bounds].tolist()
        return [raw[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def text(self, ids: list[int]) -> str:
        """The formatted text of ids."""
        return self.decoded(np.array(ids, dtype=np.int64), np.array([0, len(ids)]))[0]

    def read_all(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[list[str], list[str]]:
        """Roles and texts of the ids of turns, one turn after another."""
        marks = np.flatnonzero(ids >= self.reserved)
        places = marks.reshape(-1, 3) if len(marks) == 3 * (len(bounds) - 1) else np.zeros((0, 3), np.int64)
        kinds = ids[places] - self.reserved
        if len(places) != len(bounds) - 1 or (kinds != [ROLE, TEXT, END]).any() or (
                places[:, 0] != bounds[:-1]).any() or (places[:, 2] != bounds[1:] - 1).any():
            raise ValueError("these ids are not turns")
        # Spans from each mark to the next: mark and role, mark and text, mark alone.
        spans = np.append(places.reshape(-1), bounds[-1])
        shown = self.decoded(ids, spans)
        role, text = len(CONTROLS[ROLE]), len(CONTROLS[TEXT])
        return [unescaped(t[role:]) for t in shown[0::3]], [unescaped(t[text:]) for t in shown[1::3]]

    def read(self, ids: list[int]) -> tuple[str, str]:
        """Role and text of a turn's ids."""
        roles, texts = self.read_all(np.array(ids, dtype=np.int64), np.array([0, len(ids)]))
        return roles[0], texts[0]


@cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def assembled(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    """Ids and loss mask of each row of (conv_id, turn, role, text).

    A row is formatted where it lies; a conversation is its rows by turn, then role, then
    text, behind one <s>. Null roles and texts are empty. Equal rows stay separate turns.
    Other columns are ignored.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            made = [own.turn(r, t) for r, t in zip(*(batch.column(k).to_pylist() for k in (2, 3)), strict=True)]
            bounds = pa.array(np.cumsum([0, *(len(ids) for ids, _ in made)]), pa.int32())
            ids, loss = (np.concatenate(c) for c in zip(*made, strict=True)) if made else ([], [])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(4)), pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(bounds, pa.array(loss, pa.bool_()))],
                ["conv_id", "turn", "rank_role", "rank_text", "ids", "loss"])

    return turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(each, ASSEMBLED)


def digests(assembly: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per conversation, read back from ids and masks alone.

    Ids are decoded where they lie, a batch of rows at a time. Only the digests need a conversation's turns
    in order and one after another; its rows stream through one task sorted, and nothing but
    the running digests is held, however long it is. (SHA-256 of a whole can't be put
    together from parts.)
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            bounds = batch.column(4).offsets.to_numpy().astype(np.int64)
            bounds -= bounds[0]
            ids = batch.column(4).flatten().to_numpy()
            mask = batch.column(5).flatten().to_numpy(zero_copy_only=False).astype(bool)
            roles, texts = own.read_all(ids, bounds)
            kept = np.append(0, np.cumsum(mask))[bounds]
            trained = [unescaped(t) for t in own.decoded(ids[mask], kept)]
            chars = np.diff(np.append(0, np.cumsum(own.chars[ids]))[bounds])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(roles, pa.string()), pa.array(texts, pa.string()),
                 pa.array(trained, pa.string()), pa.array(chars, pa.int64())],
                ["conv_id", "turn", "role", "text", "trained", "chars"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, state, done = None, None, []

        def close() -> None:
            if state:
                done.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for conv, _, role, text, trained, chars in zip(
                *(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if state is None or conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), len(CONTROLS[BEGIN])]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(trained)
                state[3].update(trained.encode())
                state[4] += chars
            yield flush()
            done = []
        close()
        yield flush()

    turns = assembly.mapInArrow(
        read, "conv_id long, turn long, role string, text string, trained string, chars long")
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        fold, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")
