import random

import pytest
from log_help import plan, rows
from pyspark.sql import functions as F

from visitmill.functions.ip import ip_number, ip_parts
from visitmill.operators.channel import platform_table, with_channel
from visitmill.operators.lookup import lookup_join, measure, staged_with_hot_keys
from visitmill.operators.region import (
    area_table, overlapping_rules, region_counts, region_index, with_region,
)
from visitmill.schema import AREA_COLUMNS, PLATFORM_COLUMNS
from visitmill.sources.rules import read_channel_rules, read_ip_rules

IP_SCHEMA = ("startNum bigint, endNum bigint, province string, city string, area string, "
             "operator string")


@pytest.fixture(scope="module")
def channels(spark):
    return spark.createDataFrame(
        [(1, "A", "app1", "ios", "t1"), (2, "B", "app2", "web", "t2"), (3, "A", "x", "x", "x")],
        "line_no bigint, channelFrom string, app_channel string, platform string, traffic string")


def codes(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, channelForm string")


def test_channel_first_rule_wins_and_misses_differ(spark, channels):
    got = rows(with_channel(codes(spark, "A", "B", "Z", "-1"), channels))
    assert got == [(0, "A", "ios", "app1", "t1"), (1, "B", "web", "app2", "t2"),
                   (2, "Z", "", "", ""), (3, "-1", "-1", "-1", "-1")]


def test_channel_sentinel_is_not_looked_up(spark, channels):
    extra = channels.union(spark.createDataFrame([(9, "-1", "y", "y", "y")], channels.schema))
    assert rows(with_channel(codes(spark, "-1"), extra)) == [(0, "-1", "-1", "-1", "-1")]


def test_channel_same_without_broadcast_and_with_a_hot_code(spark, channels):
    frame = codes(spark, *["A"] * 300, *["B", "Z", "-1", None] * 20)
    small = with_channel(frame, channels)
    large = with_channel(frame, channels, broadcast_bytes=0)
    assert "BroadcastHashJoin" in plan(small)
    assert "SortMergeJoin" in plan(large) and "_salt" in plan(large)
    assert rows(small) == rows(large)


def test_measure_grows_with_text(spark):
    small = measure(spark.range(10).selectExpr("'ab' as a", "id"))
    large = measure(spark.range(10).selectExpr("repeat('ab', 100) as a", "id"))
    assert small.rows == large.rows == 10 and large.bytes == small.bytes + 10 * 198
    assert measure(spark.range(0)).bytes == 0


def test_salted_join_spreads_a_hot_key(spark):
    left = spark.range(1000).selectExpr("1 as k", "id")
    right = spark.createDataFrame([(1, "v")], "k int, v string")
    joined = lookup_join(left, right, "k", fits=False)
    assert joined.count() == 1000 and joined.where("v = 'v'").count() == 1000
    salts = left.selectExpr("pmod(xxhash64(k, id), 8) as s").groupBy("s").count().collect()
    assert len(salts) == 8 and max(r["count"] for r in salts) < 250


def test_hot_keys_come_from_the_pass_that_writes(spark):
    """A third of the rows on one key, many keys, a null key; the left side is computed once."""
    runs = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(i):
        runs.add(1)
        return i
    left = spark.range(3000).select(
        counted("id").alias("i"),
        F.expr("case when id % 3 = 0 then 'hot' when id % 100 = 1 then null else 'k' || id end as k"))
    staged, hot = staged_with_hot_keys(left, "k")
    assert hot == ["hot"] and runs.value == 3000
    right = spark.createDataFrame([("hot", 1), ("k4", 2)], "k string, v int")
    joined = lookup_join(staged, right, "k", fits=False, hot=hot)
    got = {(r.i, r.k, r.v) for r in joined.collect()}
    want = {(i, "hot" if i % 3 == 0 else None if i % 100 == 1 else f"k{i}",
             1 if i % 3 == 0 else 2 if i == 4 else None) for i in range(3000)}
    assert got == want and runs.value == 3000
    assert staged_with_hot_keys(left.limit(0), "k")[1] == []


def numbers(spark, *ips, strict=False):
    frame = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "i int, ip string")
    split = frame.selectExpr("*", f"{ip_parts('ip')} as p")
    return [r.n for r in split.selectExpr("i", f"{ip_number('p', 'ip', strict)} as n")
            .orderBy("i").collect()]


def fold(ip):
    number = 0
    for part in ip.rstrip(". ").replace(" ", ".").split("."):
        number = (int(part) | (number << 8)) & (2 ** 64 - 1)
    return number - 2 ** 64 if number >= 2 ** 63 else number


def test_ip_number(spark):
    good = ["10.0.0.1", "255.255.255.255", "-1", "1.2.3.999", "10.0.0.1.", "7",
            "1.2.3.4 5.6.7.8", "1.2.3.4 5.6.7.8 9.10.11.12", "1.2.3.4 5.6.7.8 250.1.1.1"]
    assert numbers(spark, *good) == [fold(ip) for ip in good]
    assert numbers(spark, "10.0.0.1", "-1")[1] == -1
    bad = ["a.b.c.d", "1..2.3", "", None, "x.2.3.4 5.6.7.8 9.10.11.12"]
    assert numbers(spark, *bad) == [None] * len(bad)
    assert numbers(spark, "10.0.0.1", strict=True) == [167772161]
    with pytest.raises(Exception, match="unreadable ip"):
        numbers(spark, "1.2.3.x", strict=True)


def random_rules(seed):
    """Disjoint rules of very different widths, with gaps, some beyond IPv4."""
    chance, at, found = random.Random(seed), -(2 ** 50), []
    for _ in range(120):
        at += chance.choice([1, 1, 1, 3, 2 ** 9, 2 ** 20])
        width = chance.choice([1, 2, 100, 256, 257, 2 ** 13, 2 ** 16 + 5, 2 ** 24, 2 ** 33])
        found.append((at, at + width - 1, f"p{len(found)}", f"c{len(found)}", "a", "o"))
        at += width
        if at > -(2 ** 40) and found[-1][0] < 0 and chance.random() < 0.2:
            at = 0
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("broadcast_bytes", [10 ** 9, 0])
def test_region_equals_brute_force(spark, seed, broadcast_bytes):
    rules = random_rules(seed)
    chance = random.Random(seed)
    probes = [b + d for r in rules for b in r[:2] for d in (-1, 0, 1)]
    probes += [chance.randint(r[0], r[1]) for r in rules]
    frame = spark.createDataFrame([(str(p),) for p in probes] * 2, "ip string")
    index = region_index(spark.createDataFrame(rules, IP_SCHEMA), broadcast_bytes=broadcast_bytes)
    found = with_region(frame, index)
    expected = []
    for p in probes * 2:
        hit = [r for r in rules if r[0] <= p <= r[1]]
        assert len(hit) <= 1
        expected.append((str(p), *(hit[0][2:] if hit else ("-1",) * 4)))
    assert rows(found) == sorted(expected, key=repr)
    assert len(index.shifts) >= 3
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert ("BroadcastHashJoin" in text) == (broadcast_bytes > 0)


def test_wide_rules_are_broadcast_when_narrow_ones_do_not_fit(spark):
    rules = [(i * 2, i * 2, "n", "n", "n", "n") for i in range(3000)]
    rules += [(10 ** 6, 10 ** 12, "w", "w", "w", "w")]
    frame = spark.createDataFrame(rules, IP_SCHEMA)
    index = region_index(frame, broadcast_bytes=10_000)
    assert index.shifts == (8, 40) and index.small == {40} and not index.fits
    assert region_index(frame).fits
    probes = spark.createDataFrame([("4",), ("5",), ("5000000000",)], "ip string")
    assert [r[1] for r in rows(with_region(probes, index))] == ["n", "-1", "w"]


def test_no_rules(spark):
    index = region_index(spark.createDataFrame([], IP_SCHEMA))
    assert rows(with_region(spark.createDataFrame([("1.1.1.1",)], "ip string"), index)) == [
        ("1.1.1.1", "-1", "-1", "-1", "-1")]


def test_city_fallback_only_when_intended(spark):
    index = region_index(spark.createDataFrame([(1, 9, "P", "", "AREA", "o")], IP_SCHEMA))
    frame = spark.createDataFrame([("5",), ("99",)], "ip string")
    assert rows(with_region(frame, index)) == [
        ("5", "P", "AREA", "AREA", "o"), ("99", "-1", "-1", "-1", "-1")]
    assert rows(with_region(frame, index, semantics="reference"))[0] == ("5", "P", "", "AREA", "o")


@pytest.mark.parametrize("rules", [
    [(1, 10), (10, 20)], [(1, 100), (40, 50)], [(1, 2 ** 30), (500, 600)], [(5, 9), (5, 9)],
    [(9, 5)], [(None, 5)],
])
def test_bad_rules_are_refused(spark, rules):
    frame = spark.createDataFrame([(*r, "p", "c", "a", "o") for r in rules], IP_SCHEMA)
    with pytest.raises(ValueError):
        region_index(frame)


def test_adjacent_rules_are_fine(spark):
    frame = spark.createDataFrame(
        [(i * 10, i * 10 + 9, "p", "c", "a", "o") for i in range(200)], IP_SCHEMA)
    assert overlapping_rules(frame, region_index(frame)).count() == 0


def test_tables_in_order(spark, channels):
    source = spark.createDataFrame(
        [("e_l", "d", "c", "s", "2024-01-10-09:00:00", "5", "A", "other")],
        "eventName string, deviceNum string, customerId string, sessionId string, "
        "serverTime string, ip string, channelForm string, title string")
    platform = platform_table(source, channels)
    assert tuple(platform.columns) == PLATFORM_COLUMNS
    assert rows(platform) == [("e_l", "d", "c", "s", "2024-01-10-09:00:00", "5", "A", "ios",
                               "app1", "t1", "2024-01-10", "09")]
    index = region_index(spark.createDataFrame([(1, 9, "P", "C", "A", "o")], IP_SCHEMA))
    area = area_table(platform, index)
    assert tuple(area.columns) == AREA_COLUMNS
    assert rows(area) == [("e_l", "d", "c", "s", "2024-01-10-09:00:00", "5", "P", "C", "o",
                           "app1", "2024-01-10", "09")]
    assert rows(region_counts(area)) == [("P", 1)]


def test_rule_files(spark, tmp_path):
    (tmp_path / "channel.txt").write_text(
        "A\tapp1\tios\tt1\nB\tapp2\tweb\tt2\textra\nA\tx\tx\tx\n")
    rules = read_channel_rules(spark, str(tmp_path / "channel.txt"))
    assert rows(with_channel(codes(spark, "A", "B"), rules)) == [
        (0, "A", "ios", "app1", "t1"), (1, "B", "web", "app2", "t2")]
    (tmp_path / "ip.txt").write_text("0|1|5|9|4|5|P|C|A|o|tail\n0|1|10|19|4|5|P||A|o\n")
    assert rows(read_ip_rules(spark, str(tmp_path / "ip.txt"))) == [
        (10, 19, "P", "", "A", "o"), (5, 9, "P", "C", "A", "o")]


def test_bad_rule_lines(spark, tmp_path):
    (tmp_path / "channel.txt").write_text("A\tapp1\tios\tt1\nB\tapp2\n")
    (tmp_path / "ip.txt").write_text("0|1|5|9|4|5|P|C|A|o\n0|1|x|9|4|5|P|C|A|o\n")
    for read, name in ((read_channel_rules, "channel.txt"), (read_ip_rules, "ip.txt")):
        path = str(tmp_path / name)
        with pytest.raises(Exception, match="bad rule line"):
            read(spark, path).collect()
        assert read(spark, path, on_bad_rule="drop").count() == 1


def test_first_rule_wins_across_blocks_of_a_file(spark, tmp_path):
    """Also when a file is read in many blocks that are not handed out in order."""
    path = tmp_path / "channel.txt"
    path.write_text("".join(f"code{i % 50}\tapp{i}\tios\tt\n" for i in range(4000)))
    before = {k: spark.conf.get(k) for k in
              ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rules = read_channel_rules(spark, str(path))
        assert rules.rdd.getNumPartitions() > 5
        got = with_channel(codes(spark, *[f"code{i}" for i in range(50)]), rules).collect()
        assert [r.app_channel for r in sorted(got)] == [f"app{i}" for i in range(50)]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
