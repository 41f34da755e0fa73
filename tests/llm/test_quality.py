"""Rule statistics against a plain version; the forest on planted anomalies."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm_help import documents, prose

from visitmill.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), st.text("ab \n#|é\t\x0b")), max_size=6))
def test_counts(texts):
    counts, features = quality.statistics(pa.array(texts, pa.string()))
    assert counts.tolist() == [plain(t) for t in texts]
    assert np.isfinite(features).all()


def plain_features(text):
    """The forest's features of a text, one by one."""
    text = text or ""
    n, chars, symbols, again, repeated = plain(text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    upper, lower = len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text))
    n = max(n, 1)
    return [chars / n, symbols / n, len(re.findall("[!?]", text)) / n, len(re.findall("[,.;:]", text)) / n, repeated / n,
            upper / max(upper + lower, 1), again / max(len(lines), 1), len(set(words)) / n]


def plain_score(forest, text):
    """The anomaly of a text: its path through every tree, followed node by node."""
    features, paths = plain_features(text), []
    for root in forest.roots.tolist():
        node = root
        while forest.below[node] != node:
            node = int((forest.below if features[forest.feature[node]] < forest.split[node] else forest.above)[node])
        paths.append(forest.path[node])
    n = quality.SUBSAMPLE
    usual = 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n
    return 2 ** (-(sum(paths) / max(len(paths), 1)) / usual)


def plain_kept(forest, text):
    n, _, _, _, repeated = plain(text)
    return n >= 50 and 100 * repeated <= 50 * n and plain_score(forest, text) <= forest.threshold + 1e-12


def corpus(n=400):
    rows = [(i, prose(i, 90)) for i in range(n)]
    for i in range(0, n, 8):
        rows[i] = (i, " ".join(w + "###" for w in prose(i, 90).split()))
    for i in range(4, n, 16):
        rows[i] = (i, " ".join(w.upper() + "!!" for w in prose(i, 90).split()))
    bad = {i for i in range(0, n, 8)} | {i for i in range(4, n, 16)}
    return rows, bad


def test_anomalies_are_rejected(spark):
    rows, bad = corpus()
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i not in bad), 0) for i in range(0, 400)],
                                   "doc_id long, quality int, toxic int")
    forest = quality.fit(docs, labels)
    got = {r["doc_id"]: r for r in quality.judged(docs, forest).collect()}
    kept = {i for i, r in got.items() if r["kept"]}
    assert len(bad - kept) > 0.9 * len(bad) and len(kept - bad) > 0.95 * (400 - len(bad))
    out = quality.accepted(docs, forest)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == kept
    again = quality.fit(docs.repartition(7), labels.repartition(3))
    assert again.threshold == forest.threshold


def test_scores_equal_a_plain_walk(spark):
    rows, bad = corpus(200)
    labels = spark.createDataFrame([(i, int(i not in bad), 0) for i in range(200)],
                                   "doc_id long, quality int, toxic int")
    forest = quality.fit(documents(spark, rows), labels)
    assert len(forest.roots) == quality.TREES
    for r in quality.judged(documents(spark, rows), forest).collect():
        text = dict(rows)[r["doc_id"]]
        assert abs(r["anomaly"] - plain_score(forest, text)) < 1e-9
    # Leaves hold their level and what a random tree of their points adds.
    levels = {int(root): 0 for root in forest.roots}
    for node in range(len(forest.path)):
        for child in {int(forest.below[node]), int(forest.above[node])} - {node}:
            levels[child] = levels[node] + 1
    leaves = [k for k in range(len(forest.path)) if forest.below[k] == k]
    assert all(forest.path[k] >= levels[k] and levels[k] <= forest.depth for k in leaves)


def test_every_labelled_row_counts(spark):
    """Weights, ends and the threshold from all labelled rows, however many and however dealt."""
    rows, bad = corpus(300)
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i not in bad)) for i in range(300)], "doc_id long, quality int")
    points = quality._points(docs, labels)
    got = points.collect()
    want = {i: plain_features(t) for i, t in rows if plain(t)[0] >= 50 and 2 * plain(t)[4] <= plain(t)[0]}
    assert len(got) == len(want) and sum(r["good"] for r in got) == len(set(want) - bad)
    grown = [r for r in got if not r["held"]]
    forest = quality.grow(points.where("not held"), sum(r["good"] for r in grown), sum(not r["good"] for r in grown))
    # Every point is in every tree: each split lies between the ends of the points that reach it,
    # and leaves hold the weight of theirs.
    share = {kind: sum(r["good"] == kind for r in grown) for kind in (True, False)}
    weights = {True: 256 * 0.95 / share[True], False: 256 * 0.05 / share[False]}
    for root in forest.roots[::30]:
        met, level = {int(root): grown}, 0
        while met:
            below = {}
            for node, here in met.items():
                if forest.below[node] == node:
                    adds = np.interp(sum(weights[r["good"]] for r in here), range(257), [quality.mean_path(n) for n in range(257)])
                    assert here and abs(forest.path[node] - level - adds) < 1e-9
                    continue
                k, at = f"f{forest.feature[node]}", forest.split[node]
                assert min(r[k] for r in here) < at <= max(r[k] for r in here)
                below[int(forest.below[node])] = [r for r in here if r[k] < at]
                below[int(forest.above[node])] = [r for r in here if r[k] >= at]
            met, level = below, level + 1


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([0.1, 0.1 + 1e-9, 0.4, 0.41, 0.5, 0.7, 1.0]), st.booleans()), min_size=1, max_size=60))
def test_threshold_is_the_best_of_all_scores(spark, scored):
    scored = [*scored, (0.3, True), (0.6, False)]
    good, bad = ([s for s, g in scored if g == kind] for kind in (True, False))

    def gain(at):
        kept = sum(s <= at for s in good) / len(good)
        return kept + (1 - sum(s <= at for s in bad) / len(bad)) if kept >= 0.98 else -1
    want = max(sorted({s for s, _ in scored}), key=gain)
    frame = spark.createDataFrame(scored, "score double, good boolean")
    assert quality.best_threshold(frame, len(good), len(bad)) == want


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (None, 1, 0), (7, None, 0)],
                                   "doc_id long, quality int, toxic int")
    forest = quality.fit(odd.docs, labels)
    got = quality.judged(odd.docs, forest).collect()
    assert len(got) == len(odd.rows)
    assert all(r["kept"] != r["base_failed"] for r in got)
    assert [r["base_failed"] for r in got if r["doc_id"] in (1, 2, 3, 8)] == [True] * 4
    assert quality.judged(odd.none, quality.fit(odd.none, labels.where("false"))).count() == 0
    assert quality.accepted(odd.none, forest).columns == odd.none.columns
