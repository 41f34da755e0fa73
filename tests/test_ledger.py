"""Loading raw files once, however often the job runs."""

import uuid

import pytest
from log_help import raw_line, rows

from visitmill.plans import jobs, ledger

DAYS = {9: "2024-01-09", 10: "2024-01-10", 11: "2024-01-11"}


@pytest.fixture
def tables(spark):
    names = jobs.Tables(*[f"l{uuid.uuid4().hex}_{n}" for n in ("source", "platform", "area", "session")])
    jobs.create_tables(spark, names)
    return names


def line(serial, day=10, hour=11):
    return raw_line(reqSerial=serial, serverTime=f"Wed Jan {day:02d} {hour:02d}:05:09 CST 2024") + "\n"


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(lines))


def held(spark, tables):
    return rows(spark.table(tables.source).select("reqSerial", "day", "hour"))


def entries(spark, tables):
    return {r["path"].split("/")[-1]: (r["loaded"], r["hours"]) for r in spark.table(f"{tables.source}_files").collect()}


def test_each_file_is_loaded_once(spark, tables, tmp_path):
    raw = tmp_path / "raw files"
    write(raw, "a.txt", line("a1", 9, 23), line("a2", 10, 0))
    write(raw, "b.txt", line("b1", 10, 0), line("b1", 10, 0))
    want = [("a1", DAYS[9], "23"), ("a2", DAYS[10], "00"), ("b1", DAYS[10], "00"), ("b1", DAYS[10], "00")]
    for _ in range(2):
        jobs.clean_job(spark, str(raw), tables)
        assert held(spark, tables) == want
    assert entries(spark, tables) == {
        "a.txt": (True, [f"{DAYS[10]}/00", f"{DAYS[9]}/23"][::-1]), "b.txt": (True, [f"{DAYS[10]}/00"])}
    write(raw, "c.txt", line("c1", 10, 0))
    write(raw, "empty.txt")
    write(raw, "rejected.txt", "short\tline\n")
    jobs.clean_job(spark, str(raw / "*.txt"), tables, export=str(tmp_path / "out"))
    assert held(spark, tables) == sorted([*want, ("c1", DAYS[10], "00")])
    assert spark.read.text(str(tmp_path / "out")).count() == 1
    assert entries(spark, tables)["rejected.txt"] == (True, [])
    jobs.clean_job(spark, str(raw), tables, export=str(tmp_path / "none"))
    assert not (tmp_path / "none").exists() and len(held(spark, tables)) == 5


def test_a_changed_file_replaces_its_own_rows(spark, tables, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "a.txt", line("a1", 9, 23), line("a2", 10, 0), line("a3", 11, 5))
    write(raw, "b.txt", line("b1", 10, 0), line("b2", 10, 7))
    jobs.clean_job(spark, str(raw), tables)
    # Leaves two hours, of which one had no other file's rows, and comes to a new one.
    write(raw, "a.txt", line("a2 again", 10, 0), line("a4", 10, 7))
    for _ in range(2):
        jobs.clean_job(spark, str(raw), tables)
        assert held(spark, tables) == [("a2 again", DAYS[10], "00"), ("a4", DAYS[10], "07"),
                                       ("b1", DAYS[10], "00"), ("b2", DAYS[10], "07")]
    hours = {tuple(p[0].split("/")) for p in spark.sql(f"SHOW PARTITIONS {tables.source}").collect()}
    assert hours == {(f"day={DAYS[10]}", "hour=00"), (f"day={DAYS[10]}", "hour=07")}
    # All its rows go.
    write(raw, "a.txt", "short\n")
    jobs.clean_job(spark, str(raw), tables)
    assert [r[0] for r in held(spark, tables)] == ["b1", "b2"]


@pytest.mark.parametrize("when", ["before the rows", "after the rows"])
def test_a_run_that_is_cut_off_is_made_good(spark, tables, tmp_path, monkeypatch, when):
    raw = tmp_path / "raw"
    write(raw, "a.txt", line("a1", 10, 0))
    jobs.clean_job(spark, str(raw), tables)
    write(raw, "b.txt", line("b1", 10, 0), line("b2", 10, 1))
    insert = ledger.insert_partitions

    def broken(*args, **kwargs):
        if when == "after the rows":
            insert(*args, **kwargs)
        raise RuntimeError("lost")
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "insert_partitions", broken)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.clean_job(spark, str(raw), tables)
    assert entries(spark, tables)["b.txt"] == (False, [])
    for _ in range(2):
        jobs.clean_job(spark, str(raw), tables)
        assert [r[0] for r in held(spark, tables)] == ["a1", "b1", "b2"]


def test_days_loaded_as_a_whole_belong_to_no_file(spark, tables, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "a.txt", line("a1", 9, 1), line("a2", 10, 2))
    jobs.clean_job(spark, str(raw), tables)
    write(tmp_path / "day", "d.txt", line("d1", 10, 2), line("d2", 11, 2))
    for _ in range(2):
        jobs.clean_job(spark, str(tmp_path / "day"), tables, day=DAYS[10])
        assert [r[0] for r in held(spark, tables)] == ["a1", "d1"]
    jobs.clean_job(spark, str(raw), tables)
    assert [r[0] for r in held(spark, tables)] == ["a1", "d1"]
    # A file that changed beside that day is replaced, one within it is refused and nothing changes.
    write(raw, "a.txt", line("a1 again", 9, 1))
    jobs.clean_job(spark, str(raw), tables)
    assert [r[0] for r in held(spark, tables)] == ["a1 again", "d1"]
    write(raw, "a.txt", line("a1 third", 9, 1), line("a2 third", 10, 2))
    with pytest.raises(ValueError, match="loaded as a whole day"):
        jobs.clean_job(spark, str(raw), tables)
    assert [r[0] for r in held(spark, tables)] == ["a1 again", "d1"]


def test_the_reference_reading_appends(spark, tmp_path):
    names = jobs.Tables(*[f"l{uuid.uuid4().hex}_{n}" for n in ("source", "platform", "area", "session")])
    jobs.create_tables(spark, names, "reference")
    write(tmp_path / "raw", "a.txt", line("a1"))
    for times in (1, 2):
        jobs.clean_job(spark, str(tmp_path / "raw"), names, "reference")
        assert len(held(spark, names)) == times
