import random
import zlib

import numpy as np
import pytest
from corpus_cases import EDGE

from tidegauge.llm import toxicity as t
from tidegauge.llm.filters import without_toxic

BAD = ["grobian", "lumpsack", "schurke", "flegel"]


def brute_kernel(a, b):
    """Over all choices of places in both words."""
    import itertools

    total = 0.0
    for x in itertools.combinations(range(len(a)), t.ORDER):
        for y in itertools.combinations(range(len(b)), t.ORDER):
            if all(a[i] == b[j] != t._GAP for i, j in zip(x, y)):
                total += t.DECAY ** (x[-1] - x[0] + 1 + y[-1] - y[0] + 1)
    return total


def test_kernel_equals_brute_force():
    words = ["idiot", "i.d-iot", "idxiot", "aaa", "ab", "tooidi"]
    codes = t.codes_of(words)
    for i in range(len(words)):
        for j in range(len(words)):
            got = t.subsequence_kernel(codes[i : i + 1], codes[j : j + 1])[0]
            assert got == pytest.approx(brute_kernel(codes[i].tolist(), codes[j].tolist()), rel=1e-4)


def test_gaps_and_insertions_stay_close():
    marks = t.landmarks_of(["idiot"])
    near = t.similarities(["idiot", "i.d.i.o.t", "idi*ot", "idxiot", "iddiot", "idiots", "x" * 30 + "idiot"], marks)
    far = t.similarities(["patriot", "editor", "idea", "toidi", "", "."], marks)
    assert near[0, 0] == pytest.approx(1.0) and near[:6].min() > 0.3 and far.max() == 0.0
    assert "idiot" in t.words_of("you i d i o t !")


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghiklmnoprstuw", k=rng.randint(3, 8))) for _ in range(300)]
    pairs, labels = [], []
    for i in range(400):
        words = rng.choices(vocabulary, k=40)
        toxic = i % 4 == 0
        if toxic:
            for word in rng.choices(BAD, k=3):
                cut = rng.randrange(1, len(word))
                words.insert(rng.randrange(40), rng.choice([word, word, word[:cut] + "*" + word[cut:], ".".join(word)]))
        pairs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return pairs, labels


def test_learns_and_holds_out(spark, docs_of):
    pairs, labels = corpus(1)
    odd = [(None, 1, 1), (5, None, None), (5, 1, 0), (777, 1, 1)]
    table = spark.createDataFrame(labels + odd, "doc_id long, quality int, toxic int")
    docs = docs_of(pairs + EDGE)
    model = t.train(docs, table)
    rows = t.score_texts(docs, model).collect()
    assert len(rows) == len(pairs) + len(EDGE) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows if r["doc_id"] is not None)
    truth = {i: toxic for i, _, toxic in labels if i > 10}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([p == y for p, y in held]) >= 0.95
    again = t.train(docs.repartition(5), table)
    assert np.allclose(model.weights, again.weights) and model.landmarks.words == again.landmarks.words
    kept = without_toxic(docs, model)
    assert kept.columns == docs.columns
    bad = sum(r["predicted"] for r in rows)
    assert kept.count() == len(rows) - bad and bad > 80


def test_held_out_labels_do_not_count(spark, docs_of):
    pairs, labels = corpus(2)
    flipped = [(i, q, 1 - x if zlib.crc32(str(i).encode()) % 5 == 0 else x) for i, q, x in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (t.train(docs_of(pairs), spark.createDataFrame(x, schema)) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights)


def test_without_labels_or_documents(spark, docs_of):
    schema = "doc_id long, quality int, toxic int"
    pairs, labels = corpus(3)
    assert t.train(docs_of(pairs), spark.createDataFrame([], schema)) is None
    assert t.train(docs_of([]), spark.createDataFrame(labels, schema)) is None
    assert {r["score"] for r in t.score_texts(docs_of(EDGE), None).collect()} == {0.0}
    assert t.score_texts(docs_of([]), None).collect() == []
    assert without_toxic(docs_of(EDGE), None).count() == len(EDGE)
