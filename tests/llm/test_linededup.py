"""Line dedup against a plain version over all pairs of documents."""

import difflib
import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_help import documents, prose
from pyspark.sql import functions as F

from visitmill.llm import linededup
from visitmill.llm.linededup import common_blocks

LINES = [prose(1000 + k, 25) for k in range(9)]


def line(k, words=25):
    return prose(1000 + k, words).replace("\n", " ")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=14), st.lists(st.integers(0, 9), max_size=14))
def test_blocks_are_common_ordered_and_maximal(a, b):
    blocks = common_blocks(a, b)
    before = (0, 0)
    for i, j, n in blocks:
        assert a[i:i + n] == b[j:j + n] and n > 0 and i >= before[0] and j >= before[1]
        before = (i + n, j + n)
    if len(set(a)) == len(a) and len(set(b)) == len(b):  # all are anchors
        longest = sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
        assert sum(n for *_, n in blocks) >= longest


def texts(spark, rows, **options):
    frame = documents(spark, rows)
    out = linededup.without_repeats(frame, **options)
    assert out.columns == frame.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)


def test_a_shared_passage_stays_in_the_first_document(spark):
    passage = "\n".join(line(k) for k in range(3))
    rows = [(i, f"{line(100 + i)}\n{passage}\n{line(200 + i)}") for i in range(60)]
    got = texts(spark, rows)
    assert got[0] in rows and got[0][0] == 0
    assert sorted(got) == sorted([rows[0], *[(i, f"{line(100 + i)}\n{line(200 + i)}") for i in range(1, 60)]])


def test_short_common_lines_stay(spark):
    rows = [(i, f"{line(300 + i)}\nAll rights reserved.\n{line(400 + i)}") for i in range(40)]
    assert texts(spark, rows) == sorted(rows, key=repr)


def test_short_lines_of_an_aligned_block_go(spark):
    block = "\n".join(line(500 + k, 6) for k in range(5))
    rows = [(1, f"{line(1)}\n{block}"), (2, f"{block}\n{line(2)}"), (3, f"{line(500, 6)}\n{line(3)}")]
    assert texts(spark, rows) == [rows[0], (2, line(2)), rows[2]]


def test_blocks_of_lines_that_are_frequent_apart(spark):
    """Two short lines, each in many documents; their first holders aren't the block's."""
    a, b = line(800, 12), line(801, 12)
    rows = [(i, f"{line(900 + i)}\n{(a, b)[i % 2]}\n{line(1000 + i)}") for i in range(50)]
    rows += [(50 + i, f"{line(950 + i)}\n{a}\n{b}\n{line(1050 + i)}") for i in range(30)]
    got = dict(texts(spark, rows))
    assert [i for i, text in rows if got[i] != text] == list(range(51, 80))
    assert all(a not in got[i] and b not in got[i] for i in range(51, 80))


def test_blocks_in_another_order_and_second_copies(spark):
    p, q = ("\n".join(line(k + j) for j in range(2)) for k in (1200, 1300))
    rows = [(1, f"{p}\n{line(1)}\n{p}\n{q}"), (2, f"{line(2)}\n{q}\n{line(3)}\n{p}\n{line(4)}\n{q}")]
    assert texts(spark, rows) == [rows[0], (2, "\n".join(line(k) for k in (2, 3, 4)))]


def common_lines(mine, theirs, words, least):
    """Numbers of the lines in runs of at least `least` words that both have: all runs are tried."""
    common = set()
    for i in range(len(mine)):
        for j in range(i + 1, len(mine) + 1):
            if sum(words(x) for x in mine[i:j]) >= least and any(
                theirs[k:k + j - i] == mine[i:j] for k in range(len(theirs))):
                common |= set(range(i, j))
    return common


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=9), st.lists(st.integers(0, 4), max_size=9))
def test_every_common_run_is_met_and_deleted(mine, theirs):
    """Against all runs of lines, line k having k words; 0 is an empty line."""
    common = common_lines(mine, theirs, int, 5)
    first = {}
    for name, begin, _ in linededup.least_runs(theirs, theirs, 5):
        first.setdefault(name, begin)
    shared = [("d", first[name], name) for name in {r[0] for r in linededup.least_runs(mine, mine, 5)} if name in first]
    assert bool(shared) == bool(common)
    gone = set(linededup.repeated_in(mine, mine, shared, 5))
    assert gone <= common and {i for i in common if mine[i]} <= gone


def plain_dedup(rows, least):
    """(kept lines with words, lines that may stay or go) of each document, over all pairs."""
    def words(line):
        return len(line.split())
    documents = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: r[0])
    out = {}
    for place, (doc_id, text) in enumerate(documents):
        mine, common = [x.strip() for x in text.split("\n")], set()
        for _, other in documents[:place]:
            common |= common_lines(mine, [x.strip() for x in other.split("\n")], words, least)
        out[doc_id] = [x for k, x in enumerate(mine) if x and k not in common]
    return out


def test_deletion_equals_all_pairs(spark):
    """Documents of few kinds of lines, short and long, with blank ones and blocks of many holders."""
    dice = random.Random(8)
    short = [line(2000 + k, 1 + k % 7) for k in range(12)]
    long = [line(2100 + k, 22) for k in range(6)]
    blocks = [[dice.choice(short + [""]) for _ in range(8)] + [dice.choice(long)] + short[k:k + 3] for k in range(4)]
    rows = []
    for i in range(60):
        mine = []
        for _ in range(dice.randint(1, 4)):
            kind = dice.random()
            mine += (dice.choice(blocks)[dice.randint(0, 5):dice.randint(6, 12)] if kind < 0.6
                     else [dice.choice(short + long + ["", "  "])] if kind < 0.9 else [line(3000 + i, 25)])
        rows.append((i, "\n".join(mine)))
    want = plain_dedup(rows, linededup.MIN_WORDS)
    got = dict(texts(spark, rows))
    assert {i: [x.strip() for x in t.split("\n") if x.strip()] for i, t in got.items()} == want
    assert sum(len(v) for v in want.values()) < 0.7 * sum(len([x for x in t.split("\n") if x.strip()]) for _, t in rows)


def test_a_long_first_holder_is_not_sent(spark):
    """Many later documents share a line each with one of very many lines: only that travels."""
    whole = [line(5000 + k % 40, 3) + f" {k}" for k in range(4000)] + [line(9000 + k, 25) for k in range(50)]
    rows = [(0, "\n".join(whole))] + [(1 + k, line(9000 + k, 25) + f"\nown {k}") for k in range(50)]
    runs = linededup.shared_runs(linededup.line_hashes(documents(spark, rows)))
    assert runs.count() == 50
    got = dict(texts(spark, rows))
    assert got[0] == rows[0][1] and all(got[1 + k] == f"own {k}" for k in range(50))


def test_alignment_of_lines_of_few_kinds_is_not_a_square():
    dice = random.Random(1)
    seconds = []
    for n in (4_000, 32_000):
        mine, theirs = ([dice.randint(1, 4) for _ in range(n)] for _ in range(2))
        first = {}
        for name, begin, _ in linededup.least_runs(theirs, theirs, 5):
            first.setdefault(name, begin)
        shared = [("d", first[r], r) for r in {r[0] for r in linededup.least_runs(mine, mine, 5)} if r in first]
        begun = time.perf_counter()
        assert linededup.repeated_in(mine, mine, shared, 5)
        common_blocks(mine, theirs)
        seconds.append(time.perf_counter() - begun)
    assert seconds[1] < 30 * seconds[0]


def test_copies_keep_an_empty_text(spark):
    whole = "\n".join(line(600 + k) for k in range(4))
    assert texts(spark, [(5, whole), (6, whole), (9, whole)]) == [(5, whole), (6, ""), (9, "")]


def test_every_line_kept_somewhere(spark):
    """Chains of documents that each share a block with the next one."""
    rows = [(i, "\n".join(line(700 + k) for k in range(i, i + 6))) for i in range(30)]
    got = texts(spark, rows)
    assert {x for _, t in got for x in t.split("\n") if x} == {x for _, t in rows for x in t.split("\n")}
    assert sum(len(t.split("\n")) for _, t in got if t) == 35


def test_odd_rows(odd):
    got = linededup.without_repeats(odd.docs).collect()
    assert len(got) == len(odd.rows)
    by_id = {r["doc_id"]: r["text"] for r in got}
    assert by_id[1] is None and by_id[2] == "" and by_id[3] == " \n \t " and by_id[-3] == prose(4) + " end"
    assert [r["text"] for r in got if r["doc_id"] == 4].count("") == 0 and by_id[5] != prose(4)
    assert linededup.without_repeats(odd.none).count() == 0


def test_rows_that_are_not_found_are_not_shuffled(spark, capsys):
    """Found rows, rows of their buckets, null ids and repeated rows; texts of others stay where they are."""
    rows = [(i, f"t{i % 50}") for i in range(100)] + [(None, "n"), (None, None), (3, "t3"), (3, "other")]
    docs = documents(spark, rows)
    found = linededup.keyed(docs.where("doc_id % 10 = 3 or doc_id is null"), "text").dropDuplicates(
        ["doc_id", "text_key"]).select("doc_id", "text_key", F.concat("text", F.lit("!")).alias("lines"))
    joined, name = linededup.with_found(docs, found, "lines")
    got = [(r["doc_id"], r["text"], r[name]) for r in joined.collect()]
    hit = {(i, t) for i, t in rows if i is None or i % 10 == 3}
    assert sorted(got, key=repr) == sorted(
        [(i, t, t + "!" if (i, t) in hit and t is not None else None) for i, t in rows], key=repr)
    kept, _ = linededup.with_found(docs, found, "lines", "left_anti")
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(
        [r for r in rows if r not in hit], key=repr)
    assert kept.drop(name).columns == docs.columns
    joined.explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out
