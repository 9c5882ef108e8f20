"""Passages against an alignment of every item with every whole text."""

import random

import numpy as np

from patronage.llm.decontamination import Q, Items, contaminated_passages, drop_contaminated, fold


def budget(item, percent=10):
    return max(0, min(len(item) * percent // 100, (len(item) - Q) // Q))


def least_edits(item, text):
    """Least edits between the item and any substring of the text."""
    row = np.zeros(len(text) + 1, dtype=np.int64)
    place = np.arange(len(text) + 1)
    for j, symbol in enumerate(item):
        new = np.empty_like(row)
        new[0] = j + 1
        new[1:] = np.minimum(row[:-1] + (text != symbol), row[1:] + 1)
        row = np.minimum.accumulate(new - place) + place
    return int(row.min())


def folded(text):
    return fold(np.frombuffer((text or "").encode(), dtype=np.uint8))


def brute(rows, items):
    out = set()
    for key, text in rows:
        for number, item in items:
            a, t = folded(item), folded(text)
            if len(a) >= Q and len(t) and (n := least_edits(a, t)) <= budget(a):
                out.add((key, number, n))
    return out


def best(frame):
    found = {}
    for r in frame.collect():
        key = (r["doc_id"], r["item_id"])
        found[key] = min(found.get(key, 1 << 30), r["edits"])
    return {(*k, n) for k, n in found.items()}


def edited(text, edits, pick):
    text = list(text)
    for _ in range(edits):
        at = pick.randrange(len(text))
        text[at : at + pick.choice([0, 1, 1])] = pick.choice(["", "x", "é", "  ", "Q"])
    return "".join(text)


def test_equals_alignment_of_everything(spark, make_documents):
    pick = random.Random(7)
    word = lambda: "".join(pick.choice("abcdeé") for _ in range(pick.randrange(1, 8)))
    passage = lambda n: " ".join(word() for _ in range(n))
    items = [(k, passage(n)) for k, n in enumerate((3, 6, 10, 20, 40, 60))] + [(90, "ab"), (91, ""), (92, "ab " * 30), (93, None)]
    rows = [(1, None), (2, ""), (3, "ab " * 200), (4, "abcdefg")]
    for key in range(10, 90):
        _, item = items[key % 6]
        parts = [passage(pick.randrange(30)), edited(item, pick.randrange(0, len(item) // 7 + 2), pick), passage(pick.randrange(30))]
        rows.append((key, pick.choice(["", "\n", " "]).join(parts).upper() if key % 5 == 0 else " ".join(parts)))
    rows += [(200, items[5][1] + " " + items[4][1] + items[5][1]), (None, items[4][1])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    frame = contaminated_passages(make_documents(rows), benchmark)
    expected = brute(rows, [(k, t) for k, t in items if t is not None])
    assert best(frame) == expected and len(expected) > 40
    texts = dict(rows)
    for r in frame.collect():
        part = folded(texts[r["doc_id"]])[r["start"] : r["end"]]
        assert least_edits(folded(dict(items)[r["item_id"]]), part) == r["edits"]
    assert sum(1 for r in frame.collect() if r["doc_id"] == 200 and r["item_id"] == 5) == 2
    kept = drop_contaminated(make_documents(rows), benchmark)
    assert kept.columns == make_documents(rows).columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, _ in rows} - {k for k, _, _ in expected}


def test_items_in_blocks(spark, make_documents, monkeypatch):
    from patronage.llm import decontamination

    rows = [(k, f"some words before the passage number {k} of this benchmark and some behind it") for k in range(20)]
    items = spark.createDataFrame([(k, f"passage number {k} of this benchmark and some") for k in range(20)], "item_id bigint, text string")
    whole = best(contaminated_passages(make_documents(rows), items, 0))
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 200)
    assert best(contaminated_passages(make_documents(rows), items, 0)) == whole == {(k, k, 0) for k in range(20)}


def test_empty_tables(spark, make_documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert contaminated_passages(make_documents([(1, "x")]), none).collect() == []
    assert drop_contaminated(make_documents([(1, "x")]), none).count() == 1
    some = spark.createDataFrame([(1, "a benchmark text")], "item_id bigint, text string")
    assert contaminated_passages(make_documents([]), some).collect() == []
    assert Items([1], ["a benchmark text"], 10).find(folded(""), np.array([0, 0])) == []
