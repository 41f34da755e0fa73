"""The corpus pipeline, each stage against a plain version on what it was given."""

import random

import pytest
from llm_help import CLASHING, SCHEMA, documents, line_of, prose
from test_decontaminate import brute as contaminated
from test_linededup import plain_dedup
from test_packing import check
from test_quality import plain_kept
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline as pipeline
from visitmill.llm import packing, quality
from visitmill.llm.queries import table


def corpus(odd):
    """Good, bad, copied, contaminated and odd documents, in which blocks of lines recur."""
    dice = random.Random(12)
    block = "\n".join(line_of(700 + k, 8) for k in range(4))
    items = [(i, prose(4000 + i, 18)) for i in range(5)] + [(7, None), (None, "")]
    rows = list(odd.rows)
    for i in range(20, 140):
        text = "\n".join(line_of(10_000 + 50 * i + k, dice.randint(3, 14)) for k in range(14))
        if i % 9 == 0:
            text = " ".join(w + "###!!" for w in text.split(" "))
        if i % 5 == 0:
            text = f"{text}\n{block}\n{line_of(9000 + i, 9)}"
        if i % 13 == 0:
            text = f"{text}\n{items[i % 5][1]}"
        rows.append((i, text))
        if i % 11 == 0:
            # A copy, and one with a word more.
            rows += [(1000 + i, text), (2000 + i, text + " more")]
    bad = {i for i in range(20, 140) if i % 9 == 0}
    labels = [(i, int(i not in bad), 0) for i in range(20, 140)] + [(None, 1, 0), (25, None, 0)]
    return rows, labels, items


@pytest.fixture(scope="module")
def folder(spark, odd, tmp_path_factory):
    at = tmp_path_factory.mktemp("corpus")
    rows, labels, items = corpus(odd)
    documents(spark, rows).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def pairs(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=repr)


def lines(text):
    return [x.strip() for x in text.split("\n") if x.strip()]


def test_every_stage_equals_a_plain_version(spark, odd, folder):
    _, labels, items = corpus(odd)
    docs = table(spark, folder, "documents")
    given = pairs(docs)
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        at = f"{folder}/{name.replace(' ', '-')}"
        out.write.parquet(at)
        out = spark.read.parquet(at)
        got = pairs(out)
        # Columns that only sound like the operators' own stay as they are.
        assert all(tuple(r[c] for c in CLASHING) == CLASHING for r in out.collect())
        if name == "quality rules":
            forest = quality.fit(docs, table(spark, folder, "labels"))
            assert got == [r for r in given if plain_kept(forest, r[1])]
            assert 0 < len(got) < len(given) - 5
        elif name == "line dedup":
            assert [i for i, _ in got] == [i for i, _ in given] or sorted(
                (repr(i) for i, _ in got)) == sorted(repr(i) for i, _ in given)
            named = {i: t for i, t in got if i is not None}
            want = plain_dedup([r for r in given if r[0] is not None], 20)
            assert {i: lines(t) for i, t in named.items()} == want
            assert got != given
            held = out.select("text", "n_chars").collect()
            assert all(r["n_chars"] == len(r["text"]) for r in held if r["text"] is not None)
        elif name == "SimHash near-dedup":
            prints = {i: brute_fingerprint(t) for i, t in given if i is not None}
            label = brute_components(prints)
            assert got == [r for r in given if r[0] is None or label[r[0]] == r[0]]
            assert len(got) < len(given)
        else:
            clean = [(i, t) for (i, t), hit in zip(given, contaminated(given, items), strict=True) if not hit[2]]
            assert got == sorted(clean, key=repr) and len(got) < len(given)
        docs, given = out, got
    name, stage = pipeline.STAGES[-1]
    rows = stage(spark, docs, folder).collect()
    used = check(rows, given, packing.CAPACITY)
    assert used <= 1 + sum(r["length"] for r in rows) / packing.CAPACITY * 1.01


def test_the_whole_run_is_its_stages(spark, folder):
    docs = table(spark, folder, "documents")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
    places = ("doc_id", "piece", "start", "length", "ids_crc32")
    found = pipeline.run(spark, folder)
    assert sorted((tuple(r[c] for c in places) for r in found.collect()), key=repr) == sorted(
        (tuple(r[c] for c in places) for r in docs.collect()), key=repr)
    assert [name for name, _ in pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]


def test_empty_tables(spark, folder, tmp_path):
    """No documents; then documents without labels and items."""
    empty = {"documents": SCHEMA, "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for name, schema in empty.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/{name}.parquet")
        if name != "documents":
            spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/some/{name}.parquet")
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, f"{tmp_path}/none")
        assert out.columns == docs.columns and out.count() == 0
    assert pipeline.run(spark, f"{tmp_path}/none").count() == 0
    documents(spark, [(1, prose(1, 90)), (2, prose(2, 90)), (3, None)]).write.parquet(f"{tmp_path}/some/documents.parquet")
    assert {r["doc_id"] for r in pipeline.run(spark, f"{tmp_path}/some").collect()} == {1, 2}
