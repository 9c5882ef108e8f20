"""Shared helpers of the corpus tests."""

import pytest

SF = "/root/testdata/sf0.001"

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def make_documents(spark):
    """Documents from (doc_id, text) pairs, with columns whose names could clash."""

    def make(rows):
        full = [(i, t, "en", "src", None if t is None else len(t), 1, "x") for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS + ", n bigint, key string").repartition(3)

    return make
