import math
import random

import numpy as np
import pytest

from tidegauge.llm import hard_negatives
from tidegauge.llm.hard_negatives import Block, bounds, candidates, exact_scores, summaries

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, score string, id int, values string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows):
    """All rows of the result, from (vec_id, vector, label)."""
    kept = []
    for i, vector, label in rows:
        if label is None or vector is None or any(v is None or not math.isfinite(v) for v in vector):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        kept.append((i, [math.floor(256 * float(np.float32(v))) for v in vector], label))

    def order(pair):
        score, i = pair
        return -score, math.inf if i is None else i

    out = []
    for a, (anchor, x, label) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scores = [(sum(p * q for p, q in zip(x, y)), i, other, b) for b, (i, y, other) in enumerate(kept) if b != a]
        best = sorted(((s, i) for s, i, other, _ in scores if other == label), key=order)[:5]
        for p, positive in best:
            near = [(s, i) for s, i, other, _ in scores if other != label and 80 * p <= 100 * s <= 100 * p]
            for rank, (s, i) in enumerate(sorted(near, key=order)[:5], 1):
                out.append((anchor, positive, rank, i, p, s))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def table_of(spark, rows, partitions=3):
    extra = ("r", "s", 1, "v")
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA).repartition(partitions)


def vectors(seed, n, width=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, width))
    group = rng.integers(0, 4, n)
    return (centres[group] + rng.normal(scale=0.5, size=(n, width))).astype(np.float32).tolist()


@pytest.mark.parametrize("width", [1, 2, 5, 16, 64])
def test_bounds_hold_and_finer_levels_are_tighter(width):
    rng = np.random.default_rng(width)
    x, y = np.floor(rng.normal(scale=50, size=(2, 200, width)))
    pairs = np.arange(200)
    exact = (x * y).sum(axis=1)
    reaches = []
    for segments in (1, 4, 16):
        least, largest = bounds(summaries(x, segments), pairs, summaries(y, segments), pairs)
        assert (least <= exact).all() and (exact <= largest).all()
        reaches.append((largest - least).mean())
    assert reaches == sorted(reaches, reverse=True)


def test_candidates_are_those_of_all_pairs():
    rng = np.random.default_rng(3)
    sides = [np.floor(rng.normal(scale=40, size=(n, 20))) for n in (15, 300)]
    a, b = (Block(np.arange(len(v)), np.arange(len(v)), np.arange(len(v)) % 3, v) for v in sides)
    scores = (sides[0] @ sides[1].T).astype(int)
    floor, ceiling = np.quantile(scores, 0.9, axis=1), np.quantile(scores, 0.97, axis=1)
    allowed = a.labels[:, None] != b.labels
    x, y, s = candidates(a, b, allowed, floor, ceiling)
    want = allowed & (scores >= floor[:, None]) & (scores <= ceiling[:, None])
    assert set(zip(x.tolist(), y.tolist(), s.tolist())) == {(i, j, scores[i, j]) for i, j in zip(*np.nonzero(want))}


def test_large_numbers_are_exact():
    values = np.array([[2.0**40, 3.0], [2.0**30 + 1, 5.0]])
    block = Block(np.arange(2), np.arange(2), np.zeros(2, int), values)
    one = np.array([0, 1, 0])
    other = np.array([0, 1, 1])
    assert exact_scores(block, one, block, other).tolist() == [2**63 - 1, (2**30 + 1) ** 2 + 25, 2**63 - 1]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, monkeypatch, seed):
    rng = random.Random(seed)
    n = 700
    ids = rng.sample(range(-500, 3_000), n)
    ids[:6] = [0, 100, 200, 300, 700, -100]
    rows = [(i, v, rng.randrange(10) if rng.random() < 0.5 else 3) for i, v in zip(dict.fromkeys(ids), vectors(seed, n))]
    want = brute(rows)
    assert len(want) > 50
    assert found(hard_negatives.hard_negatives(table_of(spark, rows))) == want
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 37)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 2)
    assert found(hard_negatives.hard_negatives(table_of(spark, rows))) == want


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    near = [[1.0, 0.5], [0.9, 0.55], [0.95, 0.5], [0.97, 0.4], [0.93, 0.6]]
    rows = [
        (0, [1.0, 0.5], 1),
        (0, [1.0, 0.5], 1),  # a repeated row
        (100, [-1.0, -0.5], 2),  # all its scores are below zero but one
        (200, [], 2),
        (300, None, 1),
        (400, [1.0, None], 1),
        (500, [nan, 1.0], 1),
        (600, [inf, 1.0], 1),
        (700, [1.0, 0.5], None),
        (1400, [0.2, 0.1, 0.3], 9),
        (None, [1.0, 0.5], 1),
        (None, [1.0, 0.5], 5),
        *[(i, v, 1) for i, v in enumerate(near, 11)],
        *[(i, v, 4) for i, v in enumerate(near, 21)],
        *[(30 + i, [1.0, 0.5], 6) for i in range(9)],  # ties
    ]
    assert found(hard_negatives.hard_negatives(table_of(spark, rows))) == brute(rows)
    assert any(r[0] == 0 and r[3] is not None for r in brute(rows))
    assert found(hard_negatives.hard_negatives(table_of(spark, []))) == []
    assert found(hard_negatives.hard_negatives(table_of(spark, [(0, [1.0], 1)]))) == []


def test_query_against_brute_force(spark):
    from tidegauge.llm.queries import llm_queries

    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = llm_queries()["op13_hard_negatives"](spark, FOLDER)
    assert got.columns == COLUMNS
    assert found(got) == brute(rows) and got.count() > 0
