import random
from collections import Counter

import numpy as np
import pytest
from corpus_cases import EDGE
from pyspark.sql import functions as F

from tidegauge.llm import filters, line_dedup
from tidegauge.llm.cuckoo import CuckooFilter, build

A, B = "A line that is long enough to be a key of its own, yes", "ÄÖÜ another line that is long enough, in other letters"
WHITE = " \t\n\x0b\x0c\r"


def key_of(line):
    key = line.strip(WHITE)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in key)


def brute(pairs):
    where = {}
    for i, text in pairs:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 40:
                where.setdefault(key_of(line), set()).add(i)
    last = {k: max(i for i in ids if i is not None) for k, ids in where.items() if len(ids) >= 5}
    out = Counter()
    for i, text in pairs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(key_of(x), i) == i]
        out[(i, "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    return out


def pairs_of(seed):
    rng = random.Random(seed)
    pairs = list(EDGE)
    for i in range(20, 60):
        lines = rng.choices([A, A.lower() + " ", "\t" + B + "\r", "short", "", f"{A} {rng.randint(0, 9)}", A + B], k=rng.randint(1, 8))
        pairs.append((i, "\n".join(lines)))
    return pairs + [(59, B), (59, A), (None, A)]


def rows(df):
    return Counter((r["doc_id"], r["kept"]["text"], r["kept"]["n_lines"], r["kept"]["n_dropped"]) for r in df.collect())


def test_equals_brute_force(docs_of):
    pairs = pairs_of(1)
    df = line_dedup.dedup_lines(docs_of(pairs))
    assert df.columns[:-1] == docs_of(pairs).columns
    assert rows(df) == brute(pairs)


def test_without_filters_and_broadcasts(docs_of, monkeypatch):
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", -1)
    pairs = pairs_of(2)
    assert rows(line_dedup.dedup_lines(docs_of(pairs))) == brute(pairs)


@pytest.mark.parametrize("keys_per_shard, lines", [(1, 1), (2, 3), (100_000, 7)])
def test_filters_joined_by_shard(docs_of, monkeypatch, keys_per_shard, lines):
    """Filters that are too large to send: each line meets the filter of its shard, hot shards in many pieces."""
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", keys_per_shard)
    monkeypatch.setattr(line_dedup, "LINES_PER_PIECE", lines)
    pairs = pairs_of(4)
    df = docs_of(pairs)
    state = line_dedup.line_state(line_dedup.references(df))
    assert rows(line_dedup.drop_lines(df, state)) == brute(pairs)
    lines_of = df.select(F.lit(1).cast("bigint").alias("doc"), F.explode(line_dedup._hits(state, 40, False)).alias("key"))
    found = {bytes(r["key"]) for r in line_dedup._in_filters(lines_of, state).collect()}
    held = {bytes(r["key"]) for r in state.frequent.collect()}
    every = {bytes(r["key"]) for r in lines_of.collect()}
    assert held <= found and len(found) < len(every)


def test_no_filters_at_all(docs_of, monkeypatch):
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    pairs = [(1, A), (2, B)]
    assert rows(line_dedup.dedup_lines(docs_of(pairs))) == brute(pairs)


def test_columns_with_clashing_names(docs_of):
    pairs = pairs_of(5)
    df = docs_of(pairs).selectExpr("*", "1 AS kept", "2 AS hits", "3 AS drops", "4 AS doc", "5 AS row", "6 AS _kept")
    found = line_dedup.dedup_lines(df, name="found")
    assert found.columns == [*df.columns, "found"]
    assert rows(found.select("doc_id", F.col("found").alias("kept"))) == brute(pairs)
    assert {tuple(r) for r in found.select("kept", "hits", "drops", "doc", "row", "_kept").collect()} == {(1, 2, 3, 4, 5, 6)}
    stage = filters.without_repeated_lines(df)
    assert stage.columns == df.columns
    got = Counter((r["doc_id"], r["text"] or "") for r in stage.collect())
    want = Counter()
    for (i, text, _, _), n in brute(pairs).items():
        want[(i, text)] += n
    assert got == want
    assert filters.one_of_each_group(df).columns == df.columns


def test_many_shards(docs_of, monkeypatch):
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 1)
    pairs = pairs_of(3)
    assert rows(line_dedup.dedup_lines(docs_of(pairs))) == brute(pairs)


def test_insert_and_delete_are_reversible(spark, docs_of):
    old = [(i, "\n".join([A, B][: 1 + i % 2])) for i in range(6)]
    new = [(i, A + "\n" + B + "\n" + A + B) for i in range(10, 16)]
    first = line_dedup.line_state(line_dedup.references(docs_of(old)))
    both = line_dedup.insert_documents(first, docs_of(new))
    assert rows(line_dedup.drop_lines(docs_of(old + new), both)) == brute(old + new)
    back = line_dedup.delete_documents(both, docs_of(new))
    assert sorted(map(tuple, back.refs.collect())) == sorted(map(tuple, first.refs.collect()))
    assert rows(line_dedup.drop_lines(docs_of(old), back)) == brute(old)
    held = {r["shard"]: len(CuckooFilter.from_bytes(r["filter"])) for r in back.filters.collect()}
    assert sum(held.values()) == back.frequent.count()


def held_keys(state):
    return sum(len(CuckooFilter.from_bytes(r["filter"])) for r in state.filters.collect())


def test_changes_in_a_row(spark, docs_of, monkeypatch):
    """Documents come and go, some under ids that are there already; the state is that of what is left."""
    monkeypatch.setattr(line_dedup, "REF_PIECES", 3)
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 10)
    rng = random.Random(6)

    def text():
        return "\n".join(rng.choices([A, B, "short", *(f"{A} {i}" for i in range(60))], k=12))

    there = [(i, text()) for i in range(12)] + [(None, A)]
    state = line_dedup.line_state(line_dedup.references(docs_of(there)))
    shards = {state.shards}
    for step in range(4):
        new = [(rng.randint(0, 60), text()) for _ in range(20)] + [(None, B)] * (step % 2)
        state = line_dedup.insert_documents(state, docs_of(new))
        there += new
        gone = rng.sample(range(61), 12) + [1000] + [None] * (step == 2)
        state = line_dedup.delete_documents(state, spark.createDataFrame([(i,) for i in gone], "doc_id int"))
        there = [(i, t) for i, t in there if i not in gone]
        assert len(state.pieces) <= 3
        afresh = line_dedup.line_state(line_dedup.references(docs_of(there)))
        assert sorted(map(str, state.frequent.collect())) == sorted(map(str, afresh.frequent.collect()))
        assert Counter(map(str, state.refs.collect())) == Counter(map(str, afresh.refs.collect()))
        assert held_keys(state) == state.frequent.count()
        shards.add(state.shards)
    assert rows(line_dedup.drop_lines(docs_of(there), state)) == brute(there)
    assert len(shards) > 1  # it has grown on the way


def test_only_changed_keys_are_counted(spark, docs_of):
    old = [(i, A + "\n" + B) for i in range(6)]
    state = line_dedup.line_state(line_dedup.references(docs_of(old)))
    same = line_dedup.delete_documents(state, spark.createDataFrame([(77,)], "doc_id bigint"))
    assert same.pieces[-1].count() == 0 and held_keys(same) == 2
    after = line_dedup.insert_documents(same, docs_of([(9, A)]))
    assert after.pieces[-1].count() == 1
    assert {r["n_docs"]: r["last"] for r in after.frequent.collect()} == {6: 5, 7: 9}


def test_a_full_filter_is_built_from_all_keys_of_its_shard(spark, docs_of):
    """The first filter has room for a few keys; those it held must be in the one that replaces it."""
    first = [(i, A + "\n" + B) for i in range(5)]
    more = [(10 + i, "\n".join(f"{A} {n}" for n in range(300))) for i in range(5)]
    state = line_dedup.line_state(line_dedup.references(docs_of(first)))
    state = line_dedup.insert_documents(state, docs_of(more))
    assert state.shards == 1 and held_keys(state) == 302
    assert rows(line_dedup.drop_lines(docs_of(first + more), state)) == brute(first + more)


def test_empty_table(docs_of):
    assert line_dedup.dedup_lines(docs_of([])).collect() == []


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, size=(5000, 2), dtype=np.int64).astype(np.uint64) * np.uint64(3)
    made = build(keys[:4000])
    assert len(made) == 4000 and made.contains(keys[:4000]).all()
    assert made.contains(keys[4000:]).mean() < 0.01
    made.delete(keys[:2000])
    assert len(made) == 2000 and made.contains(keys[2000:4000]).all()
    assert CuckooFilter.from_bytes(made.to_bytes()).contains(keys[2000:4000]).all()
    small = CuckooFilter.of_size(4)
    assert not small.insert(keys[:100])
