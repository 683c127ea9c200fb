import itertools
import random

import numpy as np
from corpus_cases import EDGE

from tidegauge.llm import decontaminate as d
from tidegauge.llm.filters import without_leaks


def test_seeds_survive_any_fifth_replaced():
    for n in range(5, 17):
        for gone in itertools.combinations(range(n), n // 5):
            assert any(
                not any(start + i in gone for i, used in enumerate(mask) if used == "1")
                for mask in d.MASKS
                for start in range(n - len(mask) + 1)
            )


def brute_stretch(equal, least):
    best = None
    for a in range(len(equal)):
        for b in range(a + least, len(equal) + 1):
            if 5 * sum(equal[a:b]) >= 4 * (b - a) and (best is None or b - a > best[1] - best[0]):
                best = (a, b)
    return best


def test_longest_stretch():
    rng = random.Random(1)
    for _ in range(1000):
        n, p = rng.randint(1, 30), rng.choice([0.5, 0.7, 0.8, 0.9])
        equal = np.array([rng.random() < p for _ in range(n)])
        assert d.longest_stretch(equal, min(13, n)) == brute_stretch(equal.tolist(), min(13, n))


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([5, 9, 14, 40])))) for k in range(20)]
    items += [(50, "too short"), (51, None), (None, items[0][1].upper()), (3, items[3][1])]
    pairs, planted = list(EDGE), set()
    for i in range(100, 160):
        words = rng.choices(vocabulary, k=60)
        if i % 2:
            k = rng.randrange(20)
            item = items[k][1].split()
            for at in rng.sample(range(len(item)), len(item) // 5):
                item[at] = "other"
            words[30:30] = item
            planted.add((i, k))
        pairs.append((i, ", ".join(words)))
    return items, pairs, planted


def brute(items, pairs):
    """Every item laid over every document in every place."""
    found = set()
    for i, text in pairs:
        doc = d.words_of(text or "")
        for k, item in items:
            words = d.words_of(item or "")
            least = min(13, len(words))
            if not words or len(doc) > 1000:
                continue
            for shift in range(-len(words) + 1, len(doc)):
                low, high = max(0, -shift), min(len(words), len(doc) - shift)
                equal = [words[j] == doc[j + shift] for j in range(low, high)]
                if 5 * sum(equal) >= 4 * least and brute_stretch(equal, least):
                    found.add((i, k))
    return found


def test_equals_brute_force(spark, docs_of):
    items, pairs, planted = case(1)
    benchmark = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    rows = d.find_leaks(docs_of(pairs), benchmark).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert planted <= got == brute(items, pairs)
    assert all(r["similarity"] == r["n_equal"] / r["n_words"] >= 0.8 for r in rows)
    kept = without_leaks(docs_of(pairs), benchmark)
    assert kept.columns == docs_of(pairs).columns
    leaky = {i for i, _ in got}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, _ in pairs if i not in leaky)


def test_blocks_and_empty_tables(spark, docs_of, monkeypatch):
    items, pairs, _ = case(2)
    schema = "item_id long, text string"
    benchmark = spark.createDataFrame(items, schema)
    whole = sorted(map(str, d.find_leaks(docs_of(pairs), benchmark).collect()))
    monkeypatch.setattr(d, "BLOCK_WORDS", 200)
    assert sorted(map(str, d.find_leaks(docs_of(pairs), benchmark).collect())) == whole
    assert d.find_leaks(docs_of([]), benchmark).collect() == []
    nothing = spark.createDataFrame([], schema)
    assert d.find_leaks(docs_of(pairs), nothing).collect() == []
    assert without_leaks(docs_of(pairs), nothing).count() == len(pairs)


def test_short_items_and_scripts_without_spaces(spark, docs_of):
    items = [(1, "what is ai"), (2, "機械学習とは何ですか"), (3, "Größe?"), (4, "one two three four"), (5, "?!")]
    pairs = [
        (10, "So, what is AI? Nobody knows."),
        (11, "what is an ai"),
        (12, "前置き。機械学習とは何ですか。後書き"),
        (13, "機械学習は何ですか"),  # a character short of it, and it differs
        (14, "die größe zählt"),
        (15, "one two three and four"),
        (16, "zero one, two; three: four five"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs_of(pairs), benchmark).collect()}
    assert got == brute(items, pairs)
    assert {(10, 1), (12, 2), (14, 3), (16, 4)} <= got and (11, 1) not in got and (15, 4) not in got


def test_repetitions_against_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        words = [rng.choice("ab") if rng.random() < 0.8 else f"w{rng.randrange(20)}" for _ in range(rng.randrange(5, 40))]
        doc = [*(["a"] * rng.randrange(60)), *words, *(["b", "a"] * rng.randrange(40)), *rng.choices("ab", k=20)]
        index = d.build_index([(7, " ".join(words))])
        hits = d._hits(index, d._hashes(doc, {}))
        want = set()
        for nth, mask in index.masks:
            a, b = d.seeds(d._hashes(words, {}), mask, nth), d.seeds(d._hashes(doc, {}), mask, nth)
            want |= {j - i for i in range(len(a)) for j in range(len(b)) if a[i] == b[j]}
        assert set(hits.get(0, np.zeros(0)).tolist()) >= want
        best = None
        for shift in range(-len(words) + 1, len(doc)):
            low, high = max(0, -shift), min(len(words), len(doc) - shift)
            equal = np.array([words[i] == doc[i + shift] for i in range(low, high)])
            stretch = d.longest_stretch(equal, min(13, len(words))) if high - low >= min(13, len(words)) else None
            if stretch:
                start = low + stretch[0]
                found = (int(equal[slice(*stretch)].sum()), -(start + shift), -(low + stretch[1] + shift), start)
                best = found if best is None else max(best, found)
        got = list(d.matches(index, d._hashes(doc, {})))
        assert got == ([] if best is None else [(0, -best[1], -best[2], best[3], best[0])])


def test_a_long_repetition_takes_seconds():
    import time

    index = d.build_index([(1, "same " * 500), (2, "same " * 499 + "end")])
    doc = d._hashes(["same"] * 200_000, {})
    begun = time.monotonic()
    assert sorted(d.matches(index, doc)) == [(0, 0, 500, 0, 500), (1, 0, 500, 0, 499)]
    assert time.monotonic() - begun < 20
