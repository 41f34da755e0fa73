"""Language codes, and accuracy on held-out documents."""

import math

import numpy as np
import pyarrow as pa
import pytest

from visitmill.llm import language

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6, 9, 40])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1.0, 1.0}
    if n > 1:
        apart = (code.shape[1] - code @ code.T) / 2
        assert apart[~np.eye(n, dtype=bool)].min() >= min(2 ** (n - 2), 2)
        assert (np.abs(code.sum(axis=0)) < n).all()


def test_histograms_do_not_cross_texts():
    texts = pa.array(["ab", None, "cd", "", "É"])
    whole = np.concatenate(list(language.histograms(texts)))
    alone = np.concatenate([h for t in texts for h in language.histograms(pa.array([t.as_py()], pa.string()))])
    assert (whole == alone).all() and whole[0].sum() == 1 and whole[1].sum() == 0
    assert (whole[4] == np.concatenate(list(language.histograms(pa.array(["é"])))))[0].all()


def test_decoding_equals_a_plain_version():
    """Every codeword's loss, bit by bit, and the least of them."""
    random = np.random.default_rng(3)
    for n in (2, 3, 5, 9):
        code = language.codewords(n)
        bits = code.shape[1]
        model = language.Model([str(k) for k in range(n)], code, random.normal(size=(language.BUCKETS, bits)) / 5,
                               random.uniform(0.2, 2, bits))
        counts = random.integers(0, 2, (6, language.BUCKETS)) * (random.random((6, language.BUCKETS)) < 0.01)
        counts[0] = 0
        best, share = model.predict(counts)
        for row in range(6):
            grams = np.flatnonzero(counts[row])
            losses = []
            for word in code:
                loss = 0.0
                for bit in range(bits):
                    margin = language.SCALE * sum(
                        counts[row, g] * model.weights[g, bit] for g in grams) / max(counts[row].sum(), 1)
                    loss += model.trust[bit] * math.log1p(math.exp(-margin * word[bit]))
                losses.append(loss)
            assert best[row] == int(np.argmin(losses))
            assert share[row] == pytest.approx(math.exp(-min(losses)) / sum(math.exp(-x) for x in losses))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = language.held_out(docs["doc_id"])
    model = language.fit(docs.where(~held))
    got = language.identified(docs.where(held), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 150 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(spark, odd):
    known = spark.createDataFrame([("the house is", "en"), ("das haus ist", "de"), (None, "fr"), ("le", None)],
                                  "text string, lang string")
    model = language.fit(known)
    assert model.languages == ["de", "en"]
    got = language.identified(odd.docs, model).collect()
    assert len(got) == len(odd.rows)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    nothing = language.fit(known.where("false"))
    assert {r["lang_pred"] for r in language.identified(odd.docs, nothing).collect()} == {"und"}
    one = language.fit(known.where("lang = 'en'"))
    assert {r["lang_pred"] for r in language.identified(odd.docs, one).collect()} == {"und", "en"}
    assert language.identified(odd.none, model).count() == 0


def test_ambiguous_text_is_flagged(spark):
    known = spark.createDataFrame([("abc abc abc", "x"), ("xyz xyz xyz", "y")], "text string, lang string")
    texts = spark.createDataFrame([(1, "abc abc"), (2, "xyz"), (3, "abc xyz"), (4, "mno")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.identified(texts, language.fit(known)).collect()}
    assert (got[1]["lang_pred"], got[2]["lang_pred"]) == ("x", "y")
    assert not got[1]["ambiguous"] and got[3]["ambiguous"] and got[4]["ambiguous"]
