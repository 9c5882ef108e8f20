"""The histogram's sums against plain Python."""

from collections import Counter

from tokenizers import Tokenizer

from patronage.llm import length_histogram as h
from patronage.llm.encoding import byte_bpe_50k


def lengths(rows):
    tokenizer = Tokenizer.from_file(byte_bpe_50k().path)
    tokenizer.encode_special_tokens = True
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in rows]


def test_sums(documents, make_documents, monkeypatch):
    monkeypatch.setattr(h, "STRETCH", 50)
    texts = [r["text"] for r in documents.collect()] + [None, "", "", "a", "word " * 9000]
    found = lengths(texts)
    histogram = h.length_histogram(make_documents([(k % 90 or None, t) for k, t in enumerate(texts)]), byte_bpe_50k())
    rows = histogram.collect()
    assert {r["length"]: r["n_docs"] for r in rows} == Counter(found)
    for r in rows:
        reach = [n for n in found if n >= r["length"]]
        assert (r["docs_from"], r["tokens_from"]) == (len(reach), sum(reach))
        assert (r["total_docs"], r["total_tokens"], r["n_tokens"]) == (len(found), sum(found), r["length"] * r["n_docs"])
        assert r["truncated_tokens"] == sum(min(n, r["length"]) for n in found)
    limits = [0, 1, 2, 100, 512, 2048, 10**6]
    for r in h.at_limits(histogram, limits).collect():
        assert r["truncated_tokens"] == sum(min(n, r["context_limit"]) for n in found)
        assert r["docs_over"] == sum(n > r["context_limit"] for n in found)
    ordered = sorted(found)
    for r in h.at_quantiles(histogram, [0.01, 0.5, 0.9, 1.0]).collect():
        assert r["length"] == ordered[max(0, -int(-r["share"] * len(ordered) // 1) - 1)]


def test_empty_table(make_documents):
    histogram = h.length_histogram(make_documents([]), byte_bpe_50k())
    assert histogram.collect() == []
    assert [tuple(r) for r in h.at_limits(histogram, [5]).collect()] == [(5, 0, 0)]
    assert h.at_quantiles(histogram, [0.5]).first()["length"] is None
