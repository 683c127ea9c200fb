import hashlib
import random
import re

import numpy as np
import pytest
from corpus_cases import EDGE

from tidegauge.llm import substring_dedup
from tidegauge.llm.fm_index import FMIndex, WaveletTree, matching_statistics

FOLDER = "/root/testdata/sf0.001"


def brute(pairs, window=13):
    """doc_id, n_words, n_removed and kept text of each row, by a dictionary of all windows."""
    split = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in pairs]
    least = {}
    for i, words in split:
        if i is not None:
            for at in range(len(words) - window + 1):
                key = tuple(words[at : at + window])
                least[key] = min(i, least.get(key, i))
    rows = []
    for i, words in split:
        gone = set()
        if i is not None:
            for at in range(len(words) - window + 1):
                if least[tuple(words[at : at + window])] < i:
                    gone.update(range(at, at + window))
        rows.append((i, len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    return sorted(rows, key=repr)


def found(docs, **kwargs):
    rows = substring_dedup.dedup_substrings(docs, **kwargs).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], bytes(r["kept"]).decode()) for r in rows), key=repr)


def test_ranks_of_the_wavelet_tree():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 70, 300):
        symbols = rng.integers(0, size, 500)
        tree = WaveletTree(symbols, size)
        at, which = rng.integers(0, 501, 400), rng.integers(0, size, 400)
        want = [(symbols[:a] == s).sum() for s, a in zip(which, at, strict=True)]
        assert tree.rank(which, at).tolist() == want


@pytest.mark.parametrize("depth", [2, 3, 5, 8, 13])
def test_matching_statistics_against_brute_force(depth):
    rng = random.Random(depth)
    indexed = [[rng.randrange(1, 5) for _ in range(rng.randrange(1, 30))] for _ in range(8)]
    streamed = indexed[:3] + [[rng.randrange(1, 7) for _ in range(rng.randrange(1, 30))] for _ in range(8)]
    text = np.array([w for s in indexed for w in [*s, 0]])
    index = FMIndex(text, 7, depth)
    stream = np.array([w for s in streamed for w in [*s, 0]])
    ends = np.flatnonzero(stream == 0)
    lengths = np.diff(np.r_[-1, ends]) - 1
    got = {}
    for which, place, low, high in matching_statistics(index, stream, ends, lengths):
        for s, p, a, b in zip(which.tolist(), place.tolist(), low.tolist(), high.tolist(), strict=True):
            got[s, p] = sorted(index.order[a:b].tolist())
    want = {}
    for s, words in enumerate(streamed):
        for p in range(len(words) - depth + 1):
            at = [i for i in range(len(text)) if text[i : i + depth].tolist() == words[p : p + depth]]
            if at:
                want[s, p] = at
    assert got == want and (want or depth == 13)


def passages(seed, documents=60):
    """Texts that share passages of all lengths around a window, with copies and repeats inside."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["ünï", "日本", "x" * 80, "x" * 80 + "y"]
    shared = [rng.choices(vocabulary, k=rng.choice([11, 12, 13, 14, 20, 60])) for _ in range(10)]
    pairs = []
    for i in rng.sample(range(-50, 500), documents):
        words = []
        for _ in range(rng.randrange(5)):
            words += rng.choice(shared) if rng.random() < 0.6 else rng.choices(vocabulary, k=rng.randrange(40))
        pairs.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    return pairs + rng.sample(pairs, 5) + [(1000 + i, t) for i, (_, t) in enumerate(rng.sample(pairs, 5))]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(docs_of, seed):
    pairs = passages(seed)
    assert any(r[2] for r in brute(pairs))
    assert found(docs_of(pairs)) == brute(pairs)
    # many shards, short windows
    assert found(docs_of(pairs), shard_bytes=2_000) == brute(pairs)
    assert found(docs_of(pairs), window=4, gram=2, shard_bytes=5_000) == brute(pairs, 4)


def test_hot_minimizers_are_split(docs_of, monkeypatch):
    rng = random.Random(5)
    common = [f"c{i}" for i in range(6)]
    pairs = [
        (i, " ".join([*rng.choices([f"v{j}" for j in range(900)], k=12), *common, *rng.choices("abcdefgh", k=12)]))
        for i in range(120)
    ]
    pairs += [(500 + i, pairs[i][1]) for i in range(10)]
    monkeypatch.setattr(substring_dedup, "SAMPLE", 1)
    rows = substring_dedup._prepared(docs_of(pairs))
    assert len(substring_dedup.hot_minimizers(rows, 100, 13, 5))
    assert found(docs_of(pairs), shard_bytes=100) == brute(pairs)


def test_edge_rows(docs_of):
    alone = [(4, "one two three four five six seven")]
    assert found(docs_of([*EDGE, (8, EDGE[5][1][:-50_000]), (9, " ".join("abcdefghijklmnop")), (None, " ".join("abcdefghijklmnop"))])) == brute(
        [*EDGE, (8, EDGE[5][1][:-50_000]), (9, " ".join("abcdefghijklmnop")), (None, " ".join("abcdefghijklmnop"))]
    )
    assert found(docs_of(alone)) == brute(alone)
    assert found(docs_of([])) == []


def test_long_texts_are_cut_in_pieces(docs_of, monkeypatch):
    rng = random.Random(6)
    words = rng.choices([f"w{i}" for i in range(500)], k=3_000)
    pairs = [(1, " ".join(words)), (2, " ".join(["other", *words[500:2_500], "end"])), (3, "same " * 300), (4, "same " * 40)]
    monkeypatch.setattr(substring_dedup, "PIECE_WORDS", 100)
    assert found(docs_of(pairs)) == brute(pairs)


def test_query_on_given_rows(spark):
    from tidegauge.llm.queries import llm_queries

    rows = llm_queries()["op12_substring_dedup"](spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = {(i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in brute([(r["doc_id"], r["text"]) for r in docs])}
    assert {tuple(r) for r in rows} == want and len(rows) == len(docs)
