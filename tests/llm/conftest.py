import pytest
from corpus_cases import SCHEMA, doc_rows


@pytest.fixture
def docs_of(spark):
    def make(pairs, partitions=3):
        return spark.createDataFrame(doc_rows(pairs), SCHEMA).repartition(partitions)

    return make
