"""Ids and texts against the sentencepiece library, and the agenda against trying all pairs."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_help import prose

from visitmill.llm import queries, sentencepieces
from visitmill.llm.sentencepieces import Pieces, merged, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def want(text):
    return LIBRARY.encode(text or "", add_bos=True, add_eos=True)


def got(texts, own=None):
    own = own or pieces(PATH)
    out = []
    for ids, bounds in own.encode(pa.array(texts, pa.string())):
        back = own.decode(ids, bounds).to_pylist()
        out += [(ids[a:b].tolist(), t) for a, b, t in zip(bounds[:-1], bounds[1:], back, strict=True)]
    return out


ODD = ["", None, " ", "  ", "a", " a", "a ", "   a  b ", "\n", "\t\n x", "▁", "▁a ▁▁b", " ▁ ", "<s></s> <unk> <0x41>",
       "é́ 日本\0z", "🙂🙂 x", "x" * 3000, "ab" * 1000 + "é" * 300, "a.b,c;d", "⁇", "﻿", "  　"]


def test_odd_texts_equal_the_library():
    for text, (ids, back) in zip(ODD, got(ODD), strict=True):
        assert ids == want(text) and back == LIBRARY.decode(ids)
        assert back == (text or "").replace("▁", " ")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(
    st.sampled_from(" ▁\nabcdefgh.,'ABC019<>é日🙂\0"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=6))
def test_any_texts_equal_the_library(texts):
    assert [ids for ids, _ in got(texts)] == [want(t) for t in texts]


def test_agenda_equals_merging_the_best_pair_of_all():
    """The definition: of all adjacent pairs that are pieces, the best and leftmost, again and again."""
    def plain(symbols, scores):
        parts = list(symbols)
        while True:
            pairs = [(-scores[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores]
            if not pairs:
                return parts
            k = min(pairs)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    dice = random.Random(4)
    for _ in range(400):
        letters = "abc" if dice.random() < 0.5 else "ab"
        scores = {}
        for _ in range(dice.randint(0, 14)):
            scores["".join(dice.choices(letters, k=dice.randint(2, 5)))] = dice.randint(-4, 0)
        text = "".join(dice.choices(letters, k=dice.randint(0, 20)))
        assert merged(text, scores) == plain(text, scores)


def test_no_piece_reaches_over_a_cut():
    own = pieces(PATH)
    for text in own.ids:
        held = np.frombuffer(text.encode(), np.uint8)
        assert own.beside[held[:-1], held[1:]].all()
    assert not own.beside[:, 32][np.arange(256) != 32].any()


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(sentencepieces, "CACHED", 20)
    monkeypatch.setattr(sentencepieces, "SLICE", 200)
    texts = [prose(k % 9, 30) for k in range(40)]
    own = Pieces(PATH)
    assert [ids for ids, _ in got(texts, own)] == [want(t) for t in texts]
    assert len(own.young) + len(own.old) < 300


def test_a_difference_from_the_library_stops_the_job():
    own = Pieces(PATH)
    own.scores = {}
    with pytest.raises(ValueError, match="another way"):
        got(["hello"], own)
    ids, bounds = next(pieces(PATH).encode(pa.array(["hello there"])))
    own.surfaces = np.full_like(own.surfaces, ord("z"))
    with pytest.raises(ValueError, match="another way"):
        own.decode(ids, bounds)


def test_cut_byte_pieces_show_as_the_library_shows_them():
    own = pieces(PATH)
    ids = np.array([1, own.bytes[0xE6], own.bytes[0x97], 2, 1, 0, 2], "<u4")
    back = own.decode(ids, np.array([0, 4, 7])).to_pylist()
    assert back == [LIBRARY.decode(ids[:4].tolist()), LIBRARY.decode(ids[4:].tolist())]


def test_odd_rows_and_query(spark, odd, tmp_path):
    odd.docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_sentencepiece(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def digest(held):
        return hashlib.sha256(held).hexdigest()
    expected = []
    for doc_id, text in odd.rows:
        ids = want(text)
        expected.append((doc_id, len(ids), digest(np.array(ids, "<u4").tobytes()), digest(LIBRARY.decode(ids).encode())))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(expected, key=repr)
    assert sentencepieces.decoded(sentencepieces.encoded(odd.none, PATH), PATH).count() == 0
    nothing = spark.createDataFrame([(1, None, None)], "doc_id long, n_tokens long, ids binary")
    assert sentencepieces.decoded(nothing, PATH).first().text == ""
