"""Operators as conditions and choices on whole rows, which keep all columns of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import store_table
from . import decontaminate, line_dedup, simhash, toxicity
from .names import free_name


def _kept_rows(docs: DataFrame, make: Callable[[], Callable[[list[str]], list[bool]]]) -> DataFrame:
    """Rows of ``docs`` that a function of their texts keeps; it is made once per task. Whole rows go
    through, some hundreds of texts are looked at together, and a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeps = make()
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts = [t or "" for t in part["text"].to_pylist()]
                yield part.filter(pa.array(keeps(texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def without_toxic(docs: DataFrame, model: toxicity.Model | None) -> DataFrame:
    """Rows of ``docs`` whose score is below a half; all of them without a model. No shuffle."""
    if model is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[list[str]], list[bool]]:
        features = toxicity.Featurizer(sent.value.landmarks)
        return lambda texts: (sent.value.scores(features(texts)) < 0.5).tolist()

    return _kept_rows(docs, make)


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """All rows of ``docs``; texts that lost lines, and their ``n_chars``, are replaced."""
    name = free_name(docs, "kept")
    found = line_dedup.dedup_lines(docs, name=name)
    kept = F.col(name)
    changed = kept["n_dropped"] > 0
    new = {"text": kept["text"], "n_chars": F.char_length(kept["text"]).cast("bigint")}
    return found.select(
        *(F.when(changed, new[c]).otherwise(F.col(c)).alias(c) if c in new else c for c in docs.columns)
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """Of each component of near copies (``simhash``) one row: that with the smallest doc_id, and one without an id
    only if its component has no other. Rows that share an id or have none are told apart by a key
    of their own, so another text under the same id stays; texts without words are copies of each other, and an
    empty table gives no rows. Whole rows are stored once, as the key must not change, and shuffled once by it."""
    row = free_name(docs, "row")
    rows = store_table(docs.withColumn(row, F.monotonically_increasing_id()))
    chosen = simhash.first_of_each_group(rows, row)
    return rows.join(chosen, row, "left_semi").select(*docs.columns)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no item of the benchmark is found. No shuffle."""
    for index in decontaminate.indexes(benchmark):
        docs = _kept_rows(docs, _finder(docs.sparkSession.sparkContext.broadcast(index)))
    return docs


def _finder(sent) -> Callable[[], Callable[[list[str]], list[bool]]]:
    def make() -> Callable[[list[str]], list[bool]]:
        known: dict[str, int] = {}
        return lambda texts: [not decontaminate.has_leak(sent.value, t, known) for t in texts]

    return make
