import random
from collections import Counter

import numpy as np
import pytest
import tiktoken
from corpus_cases import EDGE
from pyspark.sql import functions as F

from tidegauge.llm import bpe

ODD = ["  ", "a  b", " \n x", "it's we'll  x", "\x1c a\x1cb \x1c", "é\xa0 b　c", "  " * 500 + "x", "1２3", "x  y", " lead", "trail "]


@pytest.fixture(scope="module")
def vocabulary(spark):
    ranks, pattern = bpe.tokenizer(spark)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return ranks, pattern, library


def test_equals_the_library(docs_of, vocabulary):
    ranks, pattern, library = vocabulary
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab '\n \t1.é\xa0\x85\x1f​s") for _ in range(rng.randint(0, 40))) for _ in range(200)]
    pairs = EDGE + list(enumerate(texts, 100))
    encoded = bpe.encode_documents(docs_of(pairs), ranks, pattern, chunk_chars=700)
    got = bpe.decode_documents(encoded, ranks).select("*", bpe.unpacked(F.col("ids")).alias("array")).collect()
    want = Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in pairs)
    assert Counter((r["doc_id"], tuple(r["array"]), bytes(r["bytes"])) for r in got) == want


def test_long_words_merge_alike(vocabulary):
    ranks, _, library = vocabulary
    rng = random.Random(2)
    for _ in range(100):
        word = "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 200)))
        assert bpe.merge_word(word.encode(), ranks) == library.encode_ordinary(word)


def test_digests_and_empty_table(docs_of, vocabulary):
    ranks, pattern, library = vocabulary
    rows = bpe.token_digests(bpe.decode_documents(bpe.encode_documents(docs_of([(1, "a b"), (2, None)]), ranks, pattern), ranks)).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {1: 2, 2: 0}
    assert bpe.encode_documents(docs_of([]), ranks, pattern).collect() == []


def test_numbers_keep_through_packing():
    for values in ([], [0], [1, 2**32 - 1, 70_000]):
        assert bpe._unpack_numbers(bpe._pack_numbers(np.array(values, dtype=np.uint32))).tolist() == values
