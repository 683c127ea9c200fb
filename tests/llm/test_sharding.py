import zlib
from collections import Counter

from corpus_cases import EDGE
from pyspark.sql import functions as F

from tidegauge.llm.sharding import jump_hash, shard_documents


def reference(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 12345678901234567, *range(100, 400), None]
    shards = (1, 2, 15, 16, 17, 64, 65, 200, 10_000)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    rows = df.select("k", *[jump_hash(F.col("k"), n).alias(str(n)) for n in shards]).collect()
    for row in rows:
        assert list(row)[1:] == [reference((row["k"] or 0) % 2**64, n) for n in shards]


def test_rows_sizes_and_slots(spark, docs_of):
    pairs = EDGE + [(i, f"text {i}") for i in range(100, 300)] + [(500, "hot")] * 100
    got = shard_documents(docs_of(pairs)).collect()
    want = Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), reference((i or 0) % 2**64, 16))
        for i, t in pairs
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in got) == want
    for shard in range(16):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 16) and r["law"] == "key" for r in got)


def test_empty_table_and_no_python(docs_of):
    df = shard_documents(docs_of([]))
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
