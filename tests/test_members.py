"""The table of known members against scans of all days."""

import contextlib
import io
import random
import uuid

import pytest
from log_help import plan, rows

from visitmill.operators.metrics import METRICS, identity_facts, metric_from_facts, roll_up, set_keys
from visitmill.plans import members
from visitmill.schema import strings
from visitmill.sinks.tables import create_table, replace_day

KEYS = set_keys([n for n, m in METRICS.items() if m.source == "platform"])
COLUMNS = ("deviceNum", "customerId", "eventId", *KEYS, "day")
DAYS = ["2023-12-30", "2023-12-31", "2024-01-01", "2024-01-31", "2024-02-29"]


def log(spark, day, seed, people=30):
    dice = random.Random(seed)
    found = [(f"d{dice.randint(0, 9)}", dice.choice(["-1", f"c{dice.randint(0, people)}", None]),
              dice.choice(["e_l", "v"]), *[dice.choice(["a", "b", None]) for _ in KEYS], day) for _ in range(60)]
    return spark.createDataFrame(found, strings(*COLUMNS))


@pytest.fixture(params=["static", "dynamic"])
def history(spark, request):
    """A table of days, under both overwrite modes of the session."""
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", request.param)
    name = f"h_{uuid.uuid4().hex}"
    create_table(spark, name, strings(*COLUMNS), ("day",))
    for k, day in enumerate(DAYS):
        replace_day(log(spark, day, k), name, day, ("day",))
    yield name
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def known(spark, history, table, day, as_of=None):
    facts = members.facts_with_known_members(spark, history, "platform", table, day, as_of)
    return tables(facts, day)


def tables(facts, day):
    return {n: rows(metric_from_facts(roll_up(facts, METRICS[n].inputs), n, day))
            for n, m in METRICS.items() if m.source == "platform"}


def scanned(spark, history, day, as_of=None):
    facts = identity_facts(spark.table(history), KEYS, day, "eventId", ("visitor", "member"), as_of)
    return tables(facts, day)


def test_days_in_any_order_again_replaced_and_lost(spark, history):
    table = f"m_{uuid.uuid4().hex}"
    for day in (DAYS[3], DAYS[0], DAYS[3]):
        assert known(spark, history, table, day) == scanned(spark, history, day)
    # An earlier day comes with other rows, and one loses members that no other day has.
    replace_day(log(spark, DAYS[1], 99, people=500), history, DAYS[1], ("day",))
    assert known(spark, history, table, DAYS[1]) == scanned(spark, history, DAYS[1])
    replace_day(log(spark, DAYS[1], 98, people=3), history, DAYS[1], ("day",))
    assert known(spark, history, table, DAYS[1]) == scanned(spark, history, DAYS[1])
    for as_of in DAYS:
        assert known(spark, history, table, DAYS[2], as_of) == scanned(spark, history, DAYS[2], as_of)
    # A day without members, then without rows.
    replace_day(log(spark, DAYS[4], 1).where("customerId = '-1'"), history, DAYS[4], ("day",))
    assert known(spark, history, table, DAYS[4]) == scanned(spark, history, DAYS[4])
    spark.sql(f"ALTER TABLE {history} DROP PARTITION (day = '{DAYS[0]}')")
    assert known(spark, history, table, DAYS[2]) == scanned(spark, history, DAYS[2])
    months = {r[0] for r in spark.table(table).select("month").distinct().collect()}
    assert months == {"2023-12", "2024-01"}


def test_a_rerun_reads_no_other_day(spark, history, monkeypatch):
    """Once all days are covered, nothing but the day itself is read from the history."""
    table = f"m_{uuid.uuid4().hex}"
    members.facts_with_known_members(spark, history, "platform", table, DAYS[0])
    staged = []

    def kept(frame, stage=members.stage):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            frame.explain("formatted")
        staged.append(out.getvalue())
        return stage(frame)
    monkeypatch.setattr(members, "stage", kept)
    replace_day(log(spark, DAYS[1], 77), history, DAYS[1], ("day",))
    members.facts_with_known_members(spark, history, "platform", table, DAYS[1])
    scans = [line for text in staged for line in text.split("\n") if "PartitionFilters" in line]
    of_history = [s for s in scans if "day#" in s.split("PartitionFilters")[1]]
    assert len(of_history) == 1 and f"= {DAYS[1]}" in of_history[0]
    # Of the members, only the month is rewritten.
    of_members = [s for s in scans if "month#" in s.split("PartitionFilters")[1]]
    assert len(of_members) == 1 and "2023-12" in of_members[0]
    assert plan(members.known_members(spark, table, "2023-12-31")).count("PartitionFilters") >= 1


def test_a_failed_run_is_made_good(spark, history, monkeypatch):
    table = f"m_{uuid.uuid4().hex}"
    known(spark, history, table, DAYS[0])

    def broken(*_, **__):
        raise RuntimeError("lost")
    replace_day(log(spark, DAYS[1], 55), history, DAYS[1], ("day",))
    with monkeypatch.context() as patch:
        patch.setattr(members, "replace_slices", broken)
        with pytest.raises(RuntimeError, match="lost"):
            known(spark, history, table, DAYS[1])
    # The day isn't covered now, so a run of another day reads it.
    assert known(spark, history, table, DAYS[4]) == scanned(spark, history, DAYS[4])


def test_an_empty_history(spark):
    name, table = f"h_{uuid.uuid4().hex}", f"m_{uuid.uuid4().hex}"
    create_table(spark, name, strings(*COLUMNS), ("day",))
    assert known(spark, name, table, DAYS[0]) == scanned(spark, name, DAYS[0])
