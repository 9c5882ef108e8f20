"""The transformation against decoded texts in plain Python, the index against encoding, exact restoration."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patronage.llm import infilling as m
from patronage.llm.text import column_bytes

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")

TEXTS = [
    None, "", " ", "\n\t ", "a", " a", "a ", "  a  b  ", "one two three", "é", "é ü x", "日本語 テキスト", "a😀b 😀 😀",
    "x <P> y", "<S>", "ends <M>", "<P", "<", "P> a <", "a < P > b", "x<S y> z", "<<S", "\x85 \x1c word", "word " * 500, "äö" * 700, "q" * 5000,
]


def brute(i, text, seed=42, unit="words", rate=50, first=80):
    text = text or ""
    units = UNIT.findall(text) if unit == "words" else list(text)
    h = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(p) for p in (units[:a], units[a:b], units[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return i, n, "plain", None, None, text
    if h4 % 100 < first:
        return i, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return i, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("unit", ["words", "characters"])
def test_against_plain_python(spark, make_documents, unit):
    data = [(k * 7 + j, t) for k, t in enumerate(TEXTS) for j in range(7)] + [(None, "no id here"), (3, "twice"), (3, "twice")]
    frame = m.fill_in_middle(make_documents(data), unit=unit, rate=90, suffix_first=50)
    assert rows(frame) == sorted((brute(i, t, unit=unit, rate=90, first=50) for i, t in data), key=repr)
    again = frame.select("doc_id", m.restored("form", "output").alias("text"))
    assert rows(again) == sorted(((i, t or "") for i, t in data), key=repr)


def test_given_documents(spark, documents):
    got = m.fill_in_middle(documents)
    assert rows(got) == sorted((brute(r["doc_id"], r["text"]) for r in documents.collect()), key=repr)
    assert got.where("form <> 'plain'").count() > 0


def test_index():
    text = "aé日😀" * 50 + "plain" * 40 + "ü"
    raw, _ = column_bytes(pa.array([text]))
    index = m.ExceptionIndex.of(raw)
    bytes_before = np.cumsum([0] + [len(c.encode()) for c in text])
    assert index.chars(bytes_before).tolist() == list(range(len(text) + 1))
    assert index.bytes(np.arange(len(text) + 1)).tolist() == bytes_before.tolist()
    ascii_only = m.ExceptionIndex.of(np.frombuffer(b"abc", np.uint8))
    assert not len(ascii_only.at) and ascii_only.chars(np.array([2])).tolist() == [2]


def test_empty_table_and_unknown_unit(spark, make_documents):
    assert m.fill_in_middle(make_documents([(1, "a")]).limit(0)).collect() == []
    with pytest.raises(ValueError):
        m.fill_in_middle(make_documents([(1, "a")]), unit="tokens")


def test_very_long_text(spark, make_documents):
    text = "wörd " * 400_000
    frame = m.fill_in_middle(make_documents([(i, text) for i in range(4)]), rate=100)
    sums = frame.select(F.sha2(m.restored("form", "output"), 256).alias("s")).distinct().collect()
    assert [r["s"] for r in sums] == [hashlib.sha256(text.encode()).hexdigest()]
