"""Phrases against counting every phrase of every text."""

import random
import re
from collections import Counter

import pytest
from llm_help import documents

from visitmill.llm import collocations
from visitmill.llm.collocations import _counted, _words


def brute(rows, support, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        held = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                held.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, held in counts.items():
        found = []
        for phrase, a in held.items():
            if len(phrase) == 1 or a < support:
                continue
            if len(phrase) == 2 and any(
                100 * held[t] >= 50 * a for t in held
                if len(t) == 3 and held[t] >= support and phrase in (t[:2], t[1:])):
                continue
            cuts = [(1000000 * a * a // (held[phrase[:k]] * held[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), a, held[phrase[:k]], held[phrase[k:]]))
        for rank, (score, _, phrase, a, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, l, r, totals[lang], -score))
    return sorted(out)


def corpus():
    dice = random.Random(5)
    words = ["red", "Green", "blue", "sky", "of", "the", "é́t", "日本", "a" * 40, "x"]
    out = []
    for i in range(150):
        text = "".join(
            dice.choices(words, [9, 8, 7, 6, 5, 5, 3, 2, 1, 1])[0]
            + dice.choice([" ", " ", "\t", "  ", " ", ". ", ", ", "\n", ";", "!?", "\x0b", "\x00 "])
            for _ in range(dice.randint(0, 60)))
        out.append((dice.choice(["en", "de", None]), text))
    # Copies, a hot word, a long text, phrases that only just are or aren't frequent.
    out += [("en", "the same copied Passage here")] * 30 + [("de", "the " * 3000), ("fr", None), ("fr", "")]
    out += [("es", "uno dos tres")] * 10 + [("es", "dos tres")] * 9 + [("es", "cuatro cinco")] * 9
    return out


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, lang, "key", 1, "phrase") for i, (lang, t) in enumerate(rows)],
        "doc_id long, text string, lang string, `key` string, n int, phrase string")


# A sample of everything, of an eighth, and of nothing, where expansion must find it all.
@pytest.mark.parametrize(("sample", "passes"), [(1, 1), (8, 3), (10 ** 9, 3)])
def test_equals_counting_every_phrase(spark, sample, passes):
    rows = corpus()
    docs = frame(spark, rows).repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(docs, support=10, top=2000, sample=sample).collect())
    assert got == brute(rows, 10, 2000)
    assert collocations.phrase_counts(docs, 10, sample)[1] <= passes


def test_top_of_each_language(spark):
    rows = corpus()
    got = sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), support=4, top=5).collect())
    assert got == brute(rows, 4, 5) and max(r[1] for r in got) == 5


def test_counts_beyond_64_bits(spark):
    row = spark.sql("select 3000000000000L as a, 4000000000000L as l, 5000000000000L as r")
    assert row.selectExpr(collocations._score("a", "l", "r") + " as s").first().s == 450000


def test_equal_grams_of_different_words_are_counted_apart():
    import numpy as np

    hashes = [np.array([1, 2, 1], np.uint64), np.array([5, 6, 5], np.uint64)]
    found, n = _counted(hashes, np.array([9, 9, 9], np.uint64))
    assert sorted(zip(*(h.tolist() for h in found), n.tolist(), strict=True)) == [(1, 5, 2), (2, 6, 1)]


def test_two_words_of_one_hash_stop_the_job(spark):
    def key(word):
        return bytes([1]) + bytes(8) + (2).to_bytes(4, "big") + b"en" + word

    counts = spark.createDataFrame([(key(b"a"), 10), (key(b"b"), 10)], "key binary, n long")
    with pytest.raises(Exception, match="two words have one hash"):
        _words(counts).collect()


def test_odd_rows(spark, odd):
    found = collocations.collocations(odd.docs, support=2)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(tuple(r) for r in found.collect())
    assert got == brute([("en", t) for _, t in odd.rows], 2, 2000) and got
    assert collocations.collocations(odd.none).count() == 0
    assert collocations.collocations(documents(spark, [(1, None), (2, "")])).count() == 0
