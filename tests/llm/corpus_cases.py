from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        T.StructField("key", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("fp", T.DoubleType()),
        T.StructField("shard", T.StringType()),
        T.StructField("chunk", T.StringType()),
    ]
)


def doc_rows(pairs):
    """Rows of a documents table with extra columns, from (doc_id, text)."""
    return [
        (i, t, None, "s", None if t is None else len(t), "k", None, 1, 0.5, "x", None) for i, t in pairs
    ]


LONG = "word " * 40_000 + "x" * 50_000
EDGE = [
    (1, None),
    (2, ""),
    (3, " \n \t"),
    (4, "one two three four five six seven"),
    (4, "one two three four five six seven"),
    (5, LONG),
    (6, "Ünïcödé 日本語 😀 text"),
    (None, "a row without an id"),
    (None, None),
    (-7, "minus seven"),
]
