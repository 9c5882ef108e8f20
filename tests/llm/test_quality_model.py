"""Held-out accuracy, the gradient against differences, and texts of every kind."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import quality_model as m
from patronage.llm.text import column_bytes, held_out

LABELS = "doc_id bigint, quality int, toxic int"


def fold():
    return held_out(F.col("doc_id"), 5, 0)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = m.quality_scores(documents, labels, fold()).join(labels, "doc_id").where("held_out").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    auc = np.mean([a > b for a in good for b in bad])
    assert auc > 0.97 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_every_word_lies_in_one_passage():
    import pyarrow as pa

    texts = ["", " ", "a", "one two " * 20, "w " * 95, "w " * 96, "w " * 97, "x y z " * 1000, None, "é" * 4000]
    raw, offsets = column_bytes(pa.array(texts))
    x, first = m.passages(raw, offsets)
    assert np.isfinite(x).all() and (np.diff(first) >= 1).all()
    words = np.expm1(x[:, m.NAMES.index("words")] * 5).round()
    assert words.max() <= m.WIDEST
    assert np.add.reduceat(words, first[:-1]).tolist() == [len((t or "").split()) for t in texts]


def test_gradient():
    pick = np.random.default_rng(3)
    x, first, y = pick.normal(size=(30, len(m.NAMES))), np.array([0, 1, 6, 14, 30]), np.array([1.0, 0, 1, 0])
    steps = m.STEPS
    try:
        m.STEPS = 3
        model = m._fit(x, first, y)
    finally:
        m.STEPS = steps
    x = model.normal(x)
    _, gradient = model.gradient(x, first, y)
    for name, value in model.p.items():
        flat = value.reshape(-1)
        for k in range(0, len(flat), max(1, len(flat) // 5)):
            kept, loss = flat[k], []
            for step in (1e-5, -1e-5):
                flat[k] = kept + step
                loss.append(model.gradient(x, first, y)[0])
            flat[k] = kept
            assert gradient[name].reshape(-1)[k] == pytest.approx((loss[0] - loss[1]) / 2e-5, rel=1e-3, abs=1e-6)
    assert np.add.reduceat(model.attention(x, first), first[:-1]) == pytest.approx(1)


def test_edge_rows(spark, make_documents):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "word " * 30000), (4, "###"), (6, "fine words of a text")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 0), (4, None, 0), (6, 1, 1), (99, 0, 0)], LABELS)
    got = m.quality_scores(make_documents(rows), labels, fold()).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert m.quality_scores(make_documents([]), labels, fold()).collect() == []
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in m.quality_scores(make_documents(rows), none, fold()).collect()} == {0.5}


def test_held_out_rows_are_not_learned_from(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    first = m.train(documents, labels, fold())
    wrong = labels.withColumn("quality", F.when(fold(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = m.train(documents, wrong, fold())
    assert all((first.p[k] == again.p[k]).all() for k in first.p)
