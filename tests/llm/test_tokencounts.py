"""Separator scans against plain counts, with blocks of every size."""

import numpy as np
import pytest
from llm_help import VOCABULARY, documents, prose
from tokenizers import Tokenizer

from visitmill.llm import tokencounts
from visitmill.sinks import staging


def plain(ids, end):
    out, first = [], 0
    for k, i in enumerate(ids):
        if i == end:
            out.append((first, k - first, True))
            first = k + 1
    return [*out, (first, len(ids) - first, False)] if first < len(ids) else out


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_scan(spark, tmp_path, block):
    random = np.random.default_rng(block)
    files = {"a": random.integers(0, 4, 500), "b": np.zeros(0), "c": np.full(7, 3), "d": np.full(90, 1),
             "e": np.concatenate((np.full(40, 2), [3]))}
    for name, ids in files.items():
        (tmp_path / name).write_bytes(ids.astype("<u2").tobytes())
    frame = spark.createDataFrame([(str(tmp_path / name),) for name in files], "file string")
    got = sorted((r["file"][-1], r["ordinal"], r["first"], r["n_tokens"], r["closed"])
                 for r in tokencounts.counted(spark, frame, end=3, block=block).collect())
    assert got == [(name, k, *row) for name, ids in files.items() for k, row in enumerate(plain(ids.tolist(), 3))]


def test_group_boundaries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokencounts, "GROUP", 3)
    test_scan(spark, tmp_path, 6)


def test_a_torn_file_is_refused(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"123")
    with pytest.raises(Exception, match="ends within a token"):
        tokencounts.counted(spark, spark.createDataFrame([(str(tmp_path / "x"),)], "file string")).collect()


def test_documents(spark, odd):
    whole = Tokenizer.from_file(VOCABULARY)
    want = [(i, len(whole.encode(t or "", add_special_tokens=False).ids)) for i, t in odd.rows]
    for block in (1 << 10, 1 << 22):
        got = tokencounts.document_counts(odd.docs, VOCABULARY, block=block).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert tokencounts.document_counts(odd.none, VOCABULARY).count() == 0
    docs = [(i, prose(i, 50)) for i in range(50)]
    got = dict(map(tuple, tokencounts.document_counts(documents(spark, docs), VOCABULARY, block=100).collect()))
    assert got == {i: len(whole.encode(t, add_special_tokens=False).ids) for i, t in docs}


def test_ids_of_four_bytes(spark, tmp_path):
    ids = np.random.default_rng(2).integers(0, 200_000, 900)
    ids[::7] = 150_000
    (tmp_path / "wide").write_bytes(ids.astype("<u4").tobytes())
    frame = spark.createDataFrame([(str(tmp_path / "wide"),)], "file string")
    got = sorted((r["ordinal"], r["first"], r["n_tokens"], r["closed"])
                 for r in tokencounts.counted(spark, frame, end=150_000, block=64, width=4).collect())
    assert got == [(k, *row) for k, row in enumerate(plain(ids.tolist(), 150_000))]
    docs = documents(spark, [(1, prose(1)), (2, None)])
    wide = tokencounts.document_counts(docs, VOCABULARY, end=1_000_000, width=4).collect()
    assert sorted(map(tuple, wide)) == sorted(map(tuple, tokencounts.document_counts(docs, VOCABULARY).collect()))


def test_ids_that_do_not_fit_stop_the_job(spark):
    docs = documents(spark, [(1, prose(1))])
    with pytest.raises(ValueError, match="don't hold the end mark"):
        tokencounts.document_counts(docs, VOCABULARY, end=70_000)
    with pytest.raises(Exception, match="that 1 bytes don't hold"):
        tokencounts.document_counts(docs, VOCABULARY, end=255, width=1).collect()
    first = Tokenizer.from_file(VOCABULARY).encode(prose(1), add_special_tokens=False).ids[0]
    with pytest.raises(Exception, match=f"or the end mark {first}"):
        tokencounts.document_counts(docs, VOCABULARY, end=first).collect()


def test_folders_are_those_that_spark_means(spark, tmp_path):
    assert tokencounts.qualified(spark, f"file:{tmp_path}/a") == f"{tmp_path}/a" == tokencounts.qualified(
        spark, f"{tmp_path}/a")
    before = spark._jsc.hadoopConfiguration().get("fs.defaultFS")
    spark._jsc.hadoopConfiguration().set("fs.defaultFS", "viewfs://elsewhere/")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.elsewhere.link./x", f"file:{tmp_path}")
    try:
        with pytest.raises(ValueError, match="can't be kept at viewfs://elsewhere/x/a"):
            tokencounts.qualified(spark, "/x/a")
    finally:
        spark._jsc.hadoopConfiguration().set("fs.defaultFS", before)


def test_files_go_with_the_job(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    with staging.staged_files(spark):
        assert tokencounts.document_counts(documents(spark, [(1, "a b")]), VOCABULARY).count() == 1
        assert list((tmp_path / "visitmill").glob("tokens-*/*.u16"))
    assert not list((tmp_path / "visitmill").iterdir())
