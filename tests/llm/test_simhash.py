"""SimHash near-dedup against all pairs."""

import re

import pytest
import xxhash
from llm_help import documents, prose
from pyspark.sql import functions as F

from visitmill.llm import simhash
from visitmill.llm.components import connected_components


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Least id reachable, by ids that differ in at most two bits."""
    label = {i: i for i in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 2:
                    label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("text", ["", " ", "One", "one Two", "One two THREE", "É b c d", prose(1), "a a a a a " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_components_equal_brute_force(spark):
    texts = {i: prose(i, 1500) for i in range(10)}
    for i in range(10, 50):
        words = texts[i % 10].split(" ")
        words[i % len(words)] = f"w{i}"
        texts[i] = " ".join(words)
    texts |= {50: "", 51: None, 52: texts[3], 53: texts[3]}
    got = {r["doc_id"]: (r["fp"] % 2**64, r["component_id"])
           for r in simhash.near_duplicates(documents(spark, texts.items())).collect()}
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    want = brute_components(prints)
    assert got == {i: (prints[i], want[i]) for i in texts}
    assert len({c for _, c in got.values()}) < 45


def signed(value):
    return value if value < 2**63 else value - 2**64


def test_links_of_fingerprints_at_each_distance(spark):
    base = 0x0123456789ABCDEF
    prints = [base, base ^ 1, base ^ 0x8000000000000001, base ^ 0b111, base ^ 0b11110000]
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = {tuple(sorted(r)) for r in simhash.links(frame).collect()}
    close = {tuple(sorted((signed(a), signed(b)))) for a in prints for b in prints if 0 < (a ^ b).bit_count() <= 2}
    assert found <= close
    joined = connected_components(spark.createDataFrame(list(found), "a long, b long")).collect()
    assert {r["node"] for r in joined} == {signed(p) for p in prints[:4]}
    assert len({r["component"] for r in joined}) == 1
    with pytest.raises(ValueError, match="even"):
        simhash.links(frame, 3)


def test_null_ids_link_what_lies_on_both_sides(spark, monkeypatch):
    """Against all pairs of rows, of which some have no id and some repeat one."""
    base = 0x00FF00FF00FF00FF
    rows = [(9, base), (None, base ^ 0b11), (1, base ^ 0b1111), (None, base ^ 0b111111), (5, base ^ 0xFF0000),
            (None, ~base % 2**64), (None, ~base % 2**64 ^ 1), (7, 5), (7, 0xFFFFFF), (3, 0xFFFFFE), (8, 0xF00000000000)]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, _: docs)
    frame = spark.createDataFrame([(i, signed(p)) for i, p in rows], "doc_id long, fp long")
    label = list(range(len(rows)))
    for _ in rows:
        for a, (i, p) in enumerate(rows):
            for b, (j, q) in enumerate(rows):
                if (p ^ q).bit_count() <= 2 or i is not None and i == j:
                    label[a] = label[b] = min(label[a], label[b])
    want = [(i, signed(p), min((j for (j, _), m in zip(rows, label, strict=True) if m == n and j is not None), default=None))
            for (i, p), n in zip(rows, label, strict=True)]
    got = [tuple(r) for r in simhash.near_duplicates(frame).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {c for i, p, c in want if p in (signed(base), signed(base ^ 0b1111))} == {1}


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select((F.col("id") * 7 % 307).alias("a"), ((F.col("id") + 1) * 7 % 307).alias("b"))
    got = connected_components(edges).collect()
    assert {r["component"] for r in got} == {0} and len(got) == 301


def test_odd_rows(odd):
    got = simhash.near_duplicates(odd.docs).collect()
    assert len(got) == len(odd.rows)
    by_id = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert by_id[4] == by_id[5] and by_id[1] == by_id[2] == by_id[3] == 1
    assert simhash.near_duplicates(odd.none).count() == 0
    firsts = simhash.first_of_each(odd.docs)
    assert firsts.columns == odd.docs.columns
    ids = [r["doc_id"] for r in firsts.collect()]
    assert ids.count(None) == 2 and ids.count(1) == 1 and 2 not in ids and 5 not in ids
    assert simhash.first_of_each(odd.none).count() == 0
