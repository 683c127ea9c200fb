import hashlib
import random
from collections import Counter

import pytest
from corpus_cases import EDGE

from tidegauge.llm import winnowing as w


def brute(text, gram, window):
    codes, mask = [ord(c) for c in text], 2**64 - 1
    gram = min(gram, len(codes))
    if not codes:
        return []
    hashes = []
    for i in range(len(codes) - gram + 1):
        h = 0
        for c in codes[i : i + gram]:
            h = (h * w._BASE + c + 1) & mask
        m = ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) & mask
        hashes.append(m ^ (m >> 32))
    window = min(window, len(hashes))
    chosen = set()
    for i in range(len(hashes) - window + 1):
        part = hashes[i : i + window]
        chosen.add(i + max(j for j in range(window) if part[j] == min(part)))
    return [(hashes[p] >> 32, p) for p in sorted(chosen)]


def test_rightmost_minima():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("ab é😀") for _ in range(rng.randint(0, 60)))
        gram, window = rng.randint(1, 30), rng.randint(1, 20)
        found = w.winnow(text, gram, window)
        assert list(zip(found.hashes.tolist(), found.positions.tolist())) == brute(text, gram, window)


def test_shared_runs_share_a_hash():
    rng = random.Random(4)
    for _ in range(50):
        shared = "".join(rng.choice("abcdef ") for _ in range(w.GRAM + w.WINDOW - 1))
        x, y = ("".join(rng.choice("uvwxyz") for _ in range(rng.randint(0, 90))) for _ in range(2))
        assert set(w.winnow(x + shared + y).hashes) & set(w.winnow(y + shared + x).hashes)


@pytest.mark.parametrize("per_range", [4000, 7, 1])
def test_next_document_and_edits(docs_of, monkeypatch, per_range):
    monkeypatch.setattr(w, "ROWS_PER_RANGE", per_range)
    rng = random.Random(5)
    pairs = EDGE + [(i, f"hello world {rng.randint(0, 3)} " * rng.randint(0, 20)) for i in rng.sample(range(100, 900), 40)]
    order = sorted((w._NULL_ID if i is None else i, t or "") for i, t in pairs)
    want = Counter()
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        own, changed = w.winnow(text), w.winnow(edited)
        want[
            (
                None if i == w._NULL_ID else i, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                w.as_text(own), w.as_text(changed), w.likeness(own, changed), w.likeness(own, w.winnow(after)),
                tuple(own.positions.tolist()),
            )
        ] += 1
    got = w.compare_with_next(docs_of(pairs)).collect()
    assert Counter((*r[:-1], tuple(r["positions"])) for r in got) == want


def test_fingerprint_table_and_empty_tables(docs_of):
    rows = w.fingerprints(docs_of(EDGE)).collect()
    assert len(rows) == len(EDGE) and all(len(r["hashes"]) == len(r["positions"]) for r in rows)
    assert w.fingerprints(docs_of([])).collect() == [] == w.compare_with_next(docs_of([])).collect()
    alone = w.compare_with_next(docs_of([(1, "only one text, which is its own next one")])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_short_texts_with_a_changed_quarter_are_alike(docs_of):
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rng.randint(24, 100))) for _ in range(150)]
    rows = w.compare_with_next(docs_of(list(enumerate(texts)))).collect()
    assert len(rows) == 150 and all(r["near_edited"] > 0.2 for r in rows)
    passage = "a passage of 24 letters."
    assert w.likeness(w.winnow("x" * 30 + passage), w.winnow(passage + "y" * 30)) > 0


def test_query_positions_are_those_of_the_fingerprint(docs_of):
    pairs = [(1, "a text that is long enough to have some windows of grams in it"), (2, "short"), (3, None)]
    rows = {r["doc_id"]: r for r in w.compare_with_next(docs_of(pairs)).collect()}
    for i, text in pairs:
        own = w.winnow(text or "")
        assert rows[i]["positions"] == own.positions.tolist()
        assert len(rows[i]["positions"]) * 8 == len(rows[i]["fingerprint"])
        # of any fifteen characters in a row one position starts a chosen gram
        for start in range(len(text or "") - w.GRAM - w.WINDOW + 2):
            assert any(start <= p < start + w.WINDOW for p in rows[i]["positions"])
