import random

import pytest

from helpers import SCHEMA, at, record, records, rows_of
from tidegauge.config import DedupConfig, SkewConfig
from tidegauge.operators.dedup import accepted, dedup_ttl, duplicates
from tidegauge.operators.metrics import dedup_stats

CHAIN = SkewConfig(mode="on")
PATHS = [SkewConfig(), CHAIN]


def flags(spark, rows, ttl, skew):
    flagged = dedup_ttl(records(spark, rows), DedupConfig(ttl_seconds=ttl), ["seq"], skew)
    return [f for _, f in sorted((r["seq"], r["is_duplicate"]) for r in flagged.collect())]


def walk(rows, ttl):
    """One row at a time, in time order."""
    last, out = {}, {}
    for row in sorted(rows, key=lambda r: (r[5], r[6])):
        before = last.get(row[0])
        out[row[6]] = before is not None and (row[5] - before).total_seconds() <= ttl
        if not out[row[6]]:
            last[row[0]] = row[5]
    return [out[seq] for seq in sorted(out)]


@pytest.mark.parametrize("skew", PATHS)
def test_fixtures(spark, skew):
    first = [record(1, message_id="a")]
    assert flags(spark, first, 5, skew) == [False]
    repeated = [record(1, message_id="a"), record(2, message_id="a")]
    assert flags(spark, repeated, 5, skew) == [False, True]
    distinct = [record(1, message_id="a"), record(2, message_id="b")]
    assert flags(spark, distinct, 5, skew) == [False, False]
    expired = [record(1, message_id="a"), record(2, message_id="a", seconds=1.2)]
    assert flags(spark, expired, 1, skew) == [False, False]
    bound = [record(1, message_id="a"), record(2, message_id="a", seconds=5)]
    assert flags(spark, bound, 5, skew) == [False, True]
    chain = [record(i, message_id="a", seconds=200 * i) for i in range(3)]
    assert flags(spark, chain, 300, skew) == [False, True, False]
    sensors = [record(1, message_id="a", sensor="s1"), record(2, message_id="a", sensor="s2")]
    assert flags(spark, sensors, 5, skew) == [False, True]


@pytest.mark.parametrize("skew", PATHS)
@pytest.mark.parametrize("seed", range(2))
def test_random_chains(spark, skew, seed):
    rng = random.Random(seed)
    ttl = rng.choice([7, 20, 50])
    rows = [
        record(i, message_id=rng.choice("abc"), seconds=rng.choice([rng.randint(0, 300), rng.random() * 300]))
        for i in range(400)
    ]
    assert flags(spark, rows, ttl, skew) == walk(rows, ttl)


def test_hot_id_takes_the_chain_and_the_rest_the_window(spark):
    rng = random.Random(9)
    rows = [record(i, message_id="None", seconds=rng.random() * 1000) for i in range(500)]
    rows += [record(1000 + i, message_id=f"x{i % 60}", seconds=rng.random() * 1000) for i in range(300)]
    skew = SkewConfig(max_dedup_group_rows=100)
    assert flags(spark, rows, 20, skew) == walk(rows, 20)


@pytest.mark.parametrize("skew", PATHS)
def test_exact_copies_leave_one(spark, skew):
    rows = [record(1, message_id="a")] * 50 + [record(2, message_id="b")] * 3
    flagged = dedup_ttl(records(spark, rows), DedupConfig(), None, skew)
    assert sorted(r["message_id"] for r in accepted(flagged).collect()) == ["a", "b"]
    assert duplicates(flagged).count() == 51


def test_all_columns_are_kept(spark):
    rows = [record(i, i, message_id="a", seconds=i) for i in range(30)]
    df = records(spark, rows)
    for skew in PATHS:
        flagged = dedup_ttl(df, DedupConfig(ttl_seconds=3), ["seq"], skew)
        assert rows_of(flagged.drop("is_duplicate"), *df.columns) == rows_of(df)


def test_statistics(spark):
    rows = [record(1, message_id="s1"), record(2, message_id="s1"), record(3, message_id="s2")]
    flagged = dedup_ttl(records(spark, rows), DedupConfig(ttl_seconds=5), ["seq"])
    stats = dedup_stats(flagged, DedupConfig(ttl_seconds=5)).first()
    assert (stats["total_seen"], stats["total_dupes"], stats["dupe_rate_pct"]) == (3, 1, 33.33)
    assert stats["cache_size"] == 2
    later = dedup_stats(flagged, DedupConfig(ttl_seconds=5), now=at(6)).first()
    assert later["cache_size"] == 0


def test_rows_without_time_or_id_on_both_paths(spark):
    """Untimed rows are older than all others; rows without an id are copies of one message."""
    rng = random.Random(7)
    rows = []
    for i in range(200):
        row = list(record(i, i, message_id=rng.choice("abc"), seconds=rng.randint(0, 40)))
        row[0] = rng.choice([row[0], row[0], None])
        row[5] = rng.choice([row[5], row[5], row[5], None])
        rows.append(tuple(row))
    found = [
        rows_of(dedup_ttl(spark.createDataFrame(rows, SCHEMA), DedupConfig(ttl_seconds=5), ["seq"], s), "seq", "is_duplicate")
        for s in PATHS
    ]
    assert found[0] == found[1] and len(found[0]) == 200
    want, last = [], {}
    for row in sorted(rows, key=lambda r: (r[5] is not None, r[5] or at(0), r[6])):
        t = (row[5] - at(0)).total_seconds() if row[5] else float("-inf")
        known = row[0] in last and (t == last[row[0]] or t - last[row[0]] <= 5)
        want.append((row[6], known))
        if not known:
            last[row[0]] = t
    assert found[0] == sorted(want, key=repr)
