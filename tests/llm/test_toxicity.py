"""Held-out accuracy, windows and grams against plain Python, texts and labels of every kind."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from patronage.llm import toxicity as m
from patronage.llm.text import column_bytes, held_out

LABELS = "doc_id bigint, quality int, toxic int, text string"


def fold():
    return held_out(F.col("doc_id"), 5, 0)


def planted(n, seed=1):
    """Prose of made-up words; every fourth document holds some of a few stems with endings."""
    pick = random.Random(seed)
    syllables = ["an", "the", "er", "tion", "re", "ly", "and", "ou", "st", "in", "ble", "ha"]
    stems = ["grobbl", "vexnar", "zukwit"]
    documents, labels = [], []
    for i in range(n):
        words = ["".join(pick.choices(syllables, k=pick.randint(1, 4))) for _ in range(pick.randint(30, 300))]
        toxic = int(i % 4 == 0)
        for _ in range(pick.randint(3, 6) if toxic else 0):
            words.insert(pick.randrange(len(words)), pick.choice(stems) + pick.choice(["", "a", "ing", "er"]))
        documents.append((i, " ".join(words)))
        labels.append((i, 1, toxic, "clash"))
    return documents, labels


def test_held_out_accuracy(spark, make_documents):
    documents, labels = planted(1500)
    labels = spark.createDataFrame(labels, LABELS)
    scores = m.toxicity_scores(make_documents(documents), labels, fold())
    assert scores.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scores.join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in toxic]) > 0.9 and np.mean([r["predicted"] for r in clean]) < 0.05
    assert np.mean([a["score"] > b["score"] for a in toxic for b in clean]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_held_out_labels_are_not_read(spark, make_documents):
    documents, labels = planted(400, seed=2)
    frame = make_documents(documents)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, x) for i, q, t, x in labels]
    both = [m.toxicity_scores(frame, spark.createDataFrame(rows, LABELS), fold()).orderBy("doc_id").collect() for rows in (labels, turned)]
    assert both[0] == both[1]


def test_windows_and_grams():
    texts = ["", " ", "One two", "a " * 17, "é" * 300, "x" * 1000 + " y", None, "\tA\n\nB "]
    raw, offsets = m.plain(*column_bytes(pa.array(texts)))
    spans, first = m.windows(raw, offsets)
    view = raw.tobytes()
    for i, text in enumerate(texts):
        words = re.findall(rb"[^ ]+", (text or "").lower().encode().replace(b"\n", b" ").replace(b"\t", b" "))
        pieces = [w[k : k + m.LONGEST] for w in words for k in range(0, len(w), m.LONGEST)]
        expected = [pieces[k : k + m.WINDOW] for k in range(0, len(pieces), m.WINDOW)]
        got = [view[s : s + n] for s, n in spans[first[i] : first[i + 1]].tolist()]
        assert len(got) == len(expected)
        assert b"".join(b"".join(e) for e in expected) == b"".join(got).replace(b" ", b"")
    at, value = m.grams(raw)
    whole = [view[i : i + 5] for i in range(len(view) - 4) if b" " not in view[i + 1 : i + 4]]
    assert [int.from_bytes(g, "big") for g in whole] == value.tolist()


def test_hard_rows(spark, make_documents):
    documents, labels = planted(200, seed=3)
    hard = [(None, "grobbla grobbla"), (None, None), (5000, ""), (5001, None), (5002, "\n \t"), (5003, "字" * 3000), (5004, "z" * 300_000), (1, documents[1][1])]
    labels += [(None, 1, 1, ""), (7, 0, None, ""), (99999, 1, 1, ""), (2, 1, 0, ""), (2, 1, 0, ""), (5001, 1, 1, ""), (5000, 1, 0, "")]
    rows = m.toxicity_scores(make_documents(documents + hard), spark.createDataFrame(labels, LABELS), fold()).collect()
    assert len(rows) == 208 and all(r["score"] is not None and 0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (5000, 5001, 5002)}
    assert len(empty) == 1
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)


def test_labels_of_one_kind_and_empty_tables(spark, make_documents):
    frame = make_documents([(1, "a b c"), (2, None)])
    one = m.toxicity_scores(frame, spark.createDataFrame([(1, 1, 0, ""), (2, 1, 0, "")], LABELS), fold()).collect()
    assert [r["score"] for r in one] == [1 / 3] * 2  # the null text is no example
    none = m.toxicity_scores(frame, spark.createDataFrame([], LABELS), fold()).collect()
    assert [r["score"] for r in none] == [0.5] * 2
    assert m.toxicity_scores(frame.limit(0), spark.createDataFrame([], LABELS), fold()).collect() == []


def test_evidence_is_of_the_row_alone():
    """Other rows of a block, and where a block ends, change nothing."""
    known = m.Dictionaries(b" grobbl", b" and the other " * 50)
    texts = ["the grobbla", "", "and the other and", "x grobbl y " * 40]
    raw, offsets = column_bytes(pa.array(texts))
    together = known.evidence(raw, offsets)
    alone = [known.evidence(*column_bytes(pa.array([t])))[0] for t in texts]
    assert np.array_equal(together, np.array(alone))
    assert together[3, 0] > 0 and together[2, 0] == 0
