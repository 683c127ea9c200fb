import random
import re

import xxhash
from corpus_cases import EDGE

from tidegauge.llm import simhash
from tidegauge.llm.components import connected_components


def brute_fingerprint(text, k=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(docs_of):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    pairs = list(EDGE)
    for i in range(40):
        words = rng.choices(vocabulary, k=400)
        for j in range(rng.choice([1, 1, 3])):
            changed = list(words)
            for _ in range(j * 2):
                changed[rng.randrange(400)] = "new"
            pairs.append((1000 - 3 * i - j, " ".join(changed)))
    got = simhash.near_duplicates(docs_of(pairs)).select("*", simhash.fingerprint_hex(simhash.F.col("fp")).alias("hex")).collect()
    fps = [brute_fingerprint(t or "") for _, t in pairs]
    assert sorted((str(r["doc_id"]), r["hex"]) for r in got) == sorted((str(i), f"{f:016x}") for (i, _), f in zip(pairs, fps))
    distinct = set(fps)
    root = roots(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 3])
    least = {}
    for (i, _), f in zip(pairs, fps):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    assert all(r["component_id"] == least.get(root[int(r["hex"], 16)]) for r in got)
    assert len(set(least.values())) < len({i for i, _ in pairs}) - 3


def test_links_are_complete(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for f in base:
        for _ in range(12):
            flips = rng.sample(range(64), rng.randint(1, 5))
            fps.add(f ^ sum(1 << b for b in flips))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).distinct().collect()
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert {(r["a"], r["b"]) for r in found} == want


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).collect() == []


def test_components_of_chains_stars_and_nulls(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    rows = chain + star + [(3, 3), (None, 5), (9, 8), (8, 9)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {n: 100 for n in range(100, 161)} | {n: 7 for n in [7, *range(200, 260)]} | {8: 8, 9: 8}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
