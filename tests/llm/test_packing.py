"""Packing: gapless, whole, and few sequences."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_help import VOCABULARY, documents, prose
from tokenizers import Tokenizer

from visitmill.llm import packing
from visitmill.llm.tokens import encoder

TOKENIZER = Tokenizer.from_file(VOCABULARY)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.sampled_from(
    ["Don't 'S", "É×÷ß A!b ! !!", "İ ẞ x̊", "a\0b \0", "<|startoftext|> a", "ﬁ ½ 3²", "\x85\xa0\x1c"])), max_size=8))
def test_ids_equal_the_tokenizers(texts):
    got = [ids.tolist() for part in encoder(VOCABULARY).encode(pa.array(texts, pa.string())) for ids in part]
    assert got == [plain_ids(t) for t in texts]


def check(rows, docs, capacity):
    """All pieces of all documents, each once, without gaps."""
    want = defaultdict(int)
    for doc_id, text in docs:
        ids = [*plain_ids(text), 0]
        for k in range(0, len(ids), capacity):
            part = ids[k:k + capacity]
            want[doc_id, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got, places = defaultdict(int), defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_pieces_and_places(spark):
    docs = [(i, prose(i, 20 + 37 * i % 300)) for i in range(60)]
    rows = packing.pack(documents(spark, docs), VOCABULARY, capacity=256).collect()
    used = check(rows, docs, 256)
    assert used <= sum(r["length"] for r in rows) / 256 * 1.03 + 1


def test_many_shards(spark):
    docs = [(i, prose(i, 40)) for i in range(80)]
    rows = packing.pack(documents(spark, docs), VOCABULARY, capacity=512, shard_pieces=20).collect()
    check(rows, docs, 512)


def test_odd_rows(odd):
    rows = packing.pack(odd.docs, VOCABULARY).collect()
    check(rows, odd.rows, packing.CAPACITY)
    assert packing.pack(odd.none, VOCABULARY).count() == 0


def bins_of(numbers):
    found = defaultdict(list)
    for item, number in enumerate(numbers.tolist()):
        found[number].append(item)
    return sorted(found.values())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=40))
def test_search_keeps_items_and_never_uses_more_bins(lengths):
    lengths = np.array(lengths)
    start = packing.plain_fill(lengths, 50)
    search = packing.Search(lengths, start.copy(), 50)
    squares = int((search.fill**2).sum())
    bins = bins_of(search.run())
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(lengths[b].sum() <= 50 for b in bins) and len(bins) <= len(set(start.tolist()))
    assert np.bincount(search.bins, weights=lengths, minlength=len(search.fill)).tolist() == search.fill.tolist()
    made = sum(search.exchanges.values())
    assert int((search.fill**2).sum()) >= squares + 2 * made
    assert search.moves.sum() == sum(n * (given + back) for (given, back), n in search.exchanges.items())


def helpful(lengths, bins, capacity):
    """Every exchange by which a bin gives length to one that is at least as full: try all."""
    for giver in bins:
        for taker in bins:
            if giver is taker or lengths[taker].sum() < lengths[giver].sum():
                continue
            room = capacity - lengths[taker].sum()
            outs = [[a] for a in giver] + [[a, b] for a in giver for b in giver if a < b]
            for out in outs:
                for back in [[], *[[b] for b in taker]]:
                    if (len(out), len(back)) != (2, 0) and 0 < lengths[out].sum() - lengths[back].sum() <= room:
                        yield giver, out, taker, back


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=12))
def test_at_the_end_no_exchange_helps(lengths):
    """Against all exchanges, unless the free room is less than a bin."""
    lengths = np.array(lengths)
    search = packing.Search(lengths, packing.plain_fill(lengths, 20), 20)
    bins = bins_of(search.run())
    if 20 * len(bins) - lengths.sum() >= 20:
        assert not list(helpful(lengths, bins, 20))


@pytest.mark.parametrize("seed", range(4))
def test_search_ends_near_the_bound(seed):
    """Shards of lengths like those of the documents, filled in the order they come."""
    dice = np.random.default_rng(seed)
    lengths = np.minimum(2048, dice.lognormal(6.2, 1.1, 12_000).astype(np.int64) + 1)
    lengths[::3] = 2048
    start = packing.plain_fill(lengths)
    search = packing.Search(lengths, start.copy())
    search.run()
    used, bound = np.count_nonzero(search.fill), -(-int(lengths.sum()) // packing.CAPACITY)
    assert used <= 1.005 * bound < 1.1 * bound < start.max() + 1
    assert all(n > 50 for n in search.exchanges.values()) and sum(search.exchanges.values()) > 2000


def placed(lengths, bins, capacity):
    numbers = np.zeros(len(lengths), np.int64)
    for k, b in enumerate(bins):
        numbers[b] = k
    return packing.Search(np.array(lengths), numbers, capacity)


def test_swaps_empty_a_bin():
    search = placed([6, 6, 4, 4, 5, 5, 5, 5], [[0, 2], [1, 3], [4, 5], [6, 7]], 10)
    assert len(bins_of(search.run())) == 4
    search = placed([6, 3, 6, 3, 4, 4, 4], [[0, 1], [2, 3], [4, 5], [6]], 10)
    assert len(bins_of(search.run())) == 3 and search.exchanges[1, 1]


def test_two_for_one():
    """No move and no swap of one document fits, but two go for one."""
    search = placed([3, 3, 5, 3], [[0, 1], [2, 3]], 9)
    assert search._exchange(0) and search.exchanges == {(1, 0): 0, (1, 1): 0, (2, 1): 1}
    assert bins_of(search.bins) == [[0, 1, 3], [2]]


def test_moves_of_the_search_are_reported(spark):
    docs = [(i, prose(i, 20 + 37 * i % 300)) for i in range(60)]
    rows = packing.pack(documents(spark, docs), VOCABULARY, capacity=256).collect()
    assert sum(r["moves"] for r in rows) > 10
