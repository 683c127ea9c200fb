import hashlib
import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
import tiktoken
from corpus_cases import EDGE
from test_line_dedup import brute as brute_lines
from test_simhash import brute_fingerprint, roots

from tidegauge.llm import bpe, decontaminate, filters, toxicity

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        stage(spark, kept, FOLDER).write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        assert kept.columns == COLUMNS
        after = {r["doc_id"]: r["text"] for r in kept.collect()}
        assert len(after) == kept.count()
        if name == "toxicity":
            model = toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
            scores = {r["doc_id"]: r["score"] for r in toxicity.score_texts(docs, model).collect()}
            assert after.keys() == {i for i in before if scores[i] < 0.5}
        elif name == "line_dedup":
            assert {i: t for i, t, _, _ in brute_lines(before.items())} == {i: t or "" for i, t in after.items()}
        elif name == "simhash_dedup":
            fps = {i: brute_fingerprint(t or "") for i, t in before.items()}
            some = set(fps.values())
            root = roots(some, [(a, b) for a in some for b in some if a < b and (a ^ b).bit_count() <= 3])
            first = {}
            for i in sorted(fps):
                first.setdefault(root[fps[i]], i)
            assert after.keys() == set(first.values())
        else:
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            index = decontaminate.build_index(items)
            assert after.keys() == {i for i, t in before.items() if not decontaminate.has_leak(index, t or "", {})}
        assert 0 < len(after) <= len(before)
    ranks, pattern = bpe.tokenizer(spark)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(after)
    for r in rows:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(after[r["doc_id"]] or "")
        assert r["decoded_sha256"] == hashlib.sha256((after[r["doc_id"]] or "").encode()).hexdigest()


def test_edge_rows_through_all_filters(spark, docs_of):
    docs = docs_of([*EDGE, (4, "another text under the same id")])
    lines = filters.without_repeated_lines(docs)
    assert lines.columns == docs.columns and lines.count() == docs.count()
    groups = filters.one_of_each_group(docs)
    assert groups.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in groups.collect()]
    texts = [t for _, t in kept]
    # texts without words are copies of each other, and so are the two equal rows of id 4
    assert sorted(i for i, _ in kept if i is not None) == [-7, 1, 4, 4, 5, 6]
    assert (None, "a row without an id") in kept and len(kept) == 7 and len(set(texts)) == 7


def test_one_row_per_group_against_brute_force(spark, docs_of):
    """Groups of copies, ids that repeat or are missing: one row per component, its smallest id."""
    rng = random.Random(3)
    pairs = []
    for base in range(12):
        words = rng.choices([f"w{i}" for i in range(300)], k=300)
        for copy in range(rng.choice([1, 2, 5])):
            changed = list(words)
            if copy % 2:
                changed[rng.randrange(300)] = "new"
            pairs.append((rng.choice([None, base, base + 40 + copy]), " ".join(changed)))
    fps = [brute_fingerprint(t) for _, t in pairs]
    some = set(fps)
    root = roots(some, [(a, b) for a in some for b in some if a < b and (a ^ b).bit_count() <= 3])
    members = {}
    for (i, t), f in zip(pairs, fps, strict=True):
        members.setdefault(root[f], []).append((i, t))
    kept = [(r["doc_id"], r["text"]) for r in filters.one_of_each_group(docs_of(pairs)).collect()]
    assert len(kept) == len(members)
    for group in members.values():
        ids = [i for i, _ in group if i is not None]
        assert len([row for row in kept if row in group and row[0] == (min(ids) if ids else None)]) == 1


def test_filters_on_an_empty_table(spark, docs_of):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven")], "item_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = docs_of([])
    assert filters.without_toxic(docs, toxicity.train(docs, labels)).collect() == []
    assert filters.without_leaks(docs, benchmark).collect() == []
    assert filters.without_repeated_lines(docs).collect() == []


def test_one_of_each_group_keeps_columns(docs_of):
    docs = docs_of([(1, "a b c"), (2, "a b c")])
    assert filters.one_of_each_group(docs).columns == docs.columns
    assert filters.one_of_each_group(docs_of([])).collect() == []


def test_queries_are_registered(spark):
    from __spark_entry__ import oracle_sql, queries

    names = set(queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(oracle_sql()) <= names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "bpe"]


@pytest.mark.parametrize("name", ["op2_chat", "op10_line_dedup", "op12_substring_dedup", "op13_hard_negatives"])
def test_query_equals_sql(spark, name):
    import duckdb
    from check_queries import normalised

    from __spark_entry__ import oracle_sql, queries

    db = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    got = queries()[name](spark, FOLDER).toPandas()
    want = db.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and normalised(got) == normalised(want)


def test_other_queries_answer_every_row(spark):
    from __spark_entry__ import queries

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    crc = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}
    for name in ("op3_pii", "op5_simhash", "op6_toxicity", "op7_bpe", "op8_winnowing", "op9_sharding"):
        rows = queries()[name](spark, FOLDER).collect()
        assert sorted(r["doc_id"] for r in rows) == ids
        if name == "op6_toxicity":
            assert {r["doc_id"]: r["held_out"] for r in rows} == crc
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").count()
    assert queries()["op1_html"](spark, FOLDER).count() == pages
    assert queries()["op4_decontaminate"](spark, FOLDER).count() > 0
