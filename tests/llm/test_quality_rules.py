"""Measurements, bits, policies and ablations against plain Python."""

import re
from collections import Counter

from patronage.llm import quality_rules as q


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(repeated),
    )


def test_measurements(make_documents, documents):
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a"), (5, "a b"), (6, "a b c a b c"), (7, "x x x x x"),
        (8, "a\n\na\n a\na"), (9, "#*$%&|<> é€𝄞"), (10, "no break\x1cword"), (11, "ab " * 60000), (None, "a b"), (1, "A\nA"),
    ]
    rows += [(100 + r["doc_id"], r["text"]) for r in documents.collect()]
    got = q.quality_rules(make_documents(rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == Counter((i, *measured(t)) for i, t in rows)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (r["failed"] == 0) and not (r["base_failed"] and r["kept"])


def test_empty_table(make_documents):
    assert q.quality_rules(make_documents([])).collect() == []
    assert all(r["n_failed"] == 0 for r in q.ablation(q.ledger(make_documents([]))).collect())


def test_policies_and_ablation(documents):
    entries = q.ledger(documents)
    bits = [r["failed"] for r in entries.collect()]
    for policy, mask in q.POLICIES.items():
        kept = q.apply_policy(entries, policy).where("kept").count()
        assert kept == sum(b & (mask | q.BASE) == 0 for b in bits)
        for row in q.ablation(entries, policy).collect():
            bit = 1 << [name for name, _ in q.RULES].index(row["rule"])
            assert row["n_failed"] == sum(bool(b & bit) for b in bits)
            assert row["n_only"] == sum(b & mask == bit for b in bits)
            assert row["n_kept_without"] == sum(b & mask & ~bit == 0 for b in bits)


def test_main_path_is_native(documents):
    plan = q.quality_rules(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan
