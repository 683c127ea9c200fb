import hashlib
import heapq
import random
import re
import zlib

import pytest

from tidegauge.llm import conversation_repair as cr

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, digest string, rows int, part string"
WORD = "[^\x20\x09-\x0d]"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else v for v in (conv, turn, role, text)]
        role, text = shown[2], shown[3]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))


def brute(conv, rows):
    """A conversation's result; the edits by a search over (row, roles so far) with cost and letters as one key."""
    seen, marks = set(), []
    for _, role, text in rows:
        last = re.findall(WORD, text)
        kind = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else ""
        seen.add((role, text))
        marks.append(kind)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, state, turns = heapq.heappop(queue)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in ("", "a"):
            break
        fits = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        full = {"u": "user", "a": "assistant"}
        for initial in fits.replace("s", ""):
            heapq.heappush(queue, (cost + 5, audit + "I", at, initial, (*turns, (full[initial], ""))))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, state, turns))
            if marks[at] not in ("blank", "duplicate"):
                more = 5 * (marks[at] == "truncated")
                if role[:1] and role[:1] in fits:
                    heapq.heappush(queue, (cost + more, audit + "K", at + 1, role[:1], (*turns, (role, text))))
                for initial in fits.replace("s", ""):
                    new = (*turns, (full[initial], text))
                    heapq.heappush(queue, (cost + 1 + more, audit + "R", at + 1, initial, new))
    counts = [marks.count(k) for k in ("blank", "duplicate", "truncated")]
    return (conv, gaps, *counts, illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in turns)))


def expected(rows):
    convs = dict.fromkeys(r[0] for r in rows)
    return sorted((brute(c, damage([r for r in rows if r[0] == c])) for c in convs), key=repr)


def found(df):
    return sorted((tuple(r) for r in cr.repair(cr.damaged(df)).select(*COLUMNS).collect()), key=repr)


def table_of(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "d", 1, "p") for r in rows], SCHEMA).repartition(partitions)


def talk(rng, conv, n, roles=("system", "user", "assistant", "assistant", "user", "tool", "", "Sys")):
    texts = ["Yes.", "No!", "Why?", "cut off", " ", "Fine. \n", " ", "a.b"] + [f"text {i}." for i in range(30)]
    return [(conv, rng.choice([t, t, t, t + 1, None]), rng.choice(roles), rng.choice(texts)) for t in range(n)]


def lattice_rows(rng, n):
    return bytes(rng.choice([0, 1, 2, 1, 2, 3, 5, 6, 9, 10, 8]) for _ in range(n))


def whole(rows):
    """Cost and letters by dynamic programming from the end."""
    best = {(len(rows), s): None for s in range(4)}
    exits = [0 if s in cr.FINAL else 10**9 for s in range(4)]
    for at in range(len(rows), -1, -1):
        now = {}
        for s in range(4):
            options = [(exits[s], "")] if at == len(rows) else []
            if at < len(rows):
                row = rows[at]
                c, a = best[at + 1, s]
                options.append((c + 2, "D" + a))
                if not row & 4:
                    more = 5 if row & 8 else 0
                    initial = "sua-"[row & 3]
                    if (s, initial) in cr.NEXT:
                        c, a = best[at + 1, cr.NEXT[s, initial]]
                        options.append((c + more, "K" + a))
                    for f, t in cr.TURN:
                        if f == s:
                            c, a = best[at + 1, t]
                            options.append((c + 1 + more, "R" + a))
            now[s] = min(options)
        for _ in range(4):
            now = {s: min([now[s], *[(now[t][0] + 5, "I" + now[t][1]) for f, t in cr.TURN if f == s]]) for s in range(4)}
        best |= {(at, s): now[s] for s in range(4)}
    return best[0, 0]


def test_auction_against_dynamic_programming():
    rng = random.Random(1)
    for _ in range(400):
        rows = lattice_rows(rng, rng.randrange(14))
        assert cr.cheapest(rows) == whole(rows)


def test_prices_never_exceed_the_distances():
    rng = random.Random(2)
    for _ in range(50):
        rows = lattice_rows(rng, 10)
        lattice = cr.Lattice(rows, (0, cr._FAR, cr._FAR, 0), True)
        lattice.converge(0)
        before = list(lattice.prices)
        assert all(p <= lattice.converge(n) for n, p in enumerate(before[:-1]))


def test_crossing_costs():
    rng = random.Random(3)
    for _ in range(60):
        a, b = lattice_rows(rng, rng.randrange(1, 6)), lattice_rows(rng, rng.randrange(1, 6))
        end = cr.Lattice(b, (0, cr._FAR, cr._FAR, 0), True)
        through = min(x + end.converge(s) for s, x in enumerate(cr.crossing(a)[0]))
        assert through == whole(a + b)[0]


@pytest.mark.parametrize("block, group", [(64, 256), (3, 256), (2, 3)])
def test_against_brute_force(spark, monkeypatch, block, group):
    """Blocks of two rows and groups of three blocks give scans of several levels."""
    monkeypatch.setattr(cr, "BLOCK", block)
    monkeypatch.setattr(cr, "GROUP", group)
    monkeypatch.setattr(cr, "RANGE_ROWS", 40)
    rng = random.Random(block)
    rows = [r for c in range(25) for r in talk(rng, c, rng.choice([0, 1, 2, 5, 8, 12]))] + talk(rng, 99, 45)
    rows += talk(rng, None, 6) + [(200, None, None, None), (201, 5, "user", None), (201, None, None, "x.")]
    rows += [(300, 1, "user", "same."), (300, 1, "user", "same."), (300, 1, "user", "same."), (300, 2, "assistant", "same.")]
    assert found(table_of(spark, rows)) == expected(rows)


def test_edge_rows(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "gone."), (-5, 3, "assistant", "word " * 50_000 + "end.")]
    got = found(table_of(spark, rows))
    assert got == expected(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", sha("")) in got
    assert found(table_of(spark, [])) == []


def test_query_against_brute_force(spark):
    from tidegauge.llm.queries import llm_queries

    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = llm_queries()["op11_conversation_repair"](spark, FOLDER)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)
