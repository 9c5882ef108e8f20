"""Removal of repeats against a set of all windows, and the run-length index against plain search."""

import hashlib
import random

import numpy as np
import pytest

from patronage.llm import repeats
from patronage.llm.repeats import remove_repeats
from patronage.llm.run_length_index import RunLengthIndex, suffix_array


def brute(rows, length=100):
    seen, out = {}, {}
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if seen.setdefault(window, (key, k)) != (key, k):
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for part in bytes(gone).split(b"\0") if part)
        out[key] = (len(data), spans, hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest())
    return out


def got(frame):
    return {
        r["doc_id"]: (r["n_bytes"], len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in frame.collect()
    }


def test_equals_all_windows(documents):
    assert got(remove_repeats(documents)) == brute([(r["doc_id"], r["text"]) for r in documents.collect()])


@pytest.fixture
def hard_rows():
    pick = random.Random(3)
    word = lambda n: "".join(pick.choice("abcdé") for _ in range(n))
    common, rows = [word(k) for k in (40, 60, 99, 100, 101, 180, 700)], []
    for key in range(120):
        parts = [pick.choice([word(pick.randrange(1, 90)), pick.choice(common)]) for _ in range(pick.randrange(1, 9))]
        rows.append((key, "".join(parts)))
    rows += [(200, "a" * 5000), (201, "ab" * 3000), (202, "abc" * 70), (203, None), (204, ""), (205, "x" * 99), (206, "x" * 100)]
    rows += [(207, "x" * 100), (208, "x" * 101), (None, common[6]), (209, common[6] + common[5] + common[6])]
    return rows


def test_hard_texts(make_documents, hard_rows):
    assert got(remove_repeats(make_documents(hard_rows))) == brute(hard_rows)


def test_small_limits(make_documents, hard_rows, monkeypatch):
    """Many blocks, parts and indexes; a reduction to one segment per anchor; crowded anchors by hashes."""
    raw = np.frombuffer("".join(t or "" for _, t in hard_rows).encode(), dtype=np.uint8)
    sizes = [len((t or "").encode()) for _, t in hard_rows]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    whole = sum(c.sum() for c in [repeats.segments(raw, offsets, 100)[1]])
    monkeypatch.setattr(repeats, "BLOCK", 500)
    monkeypatch.setattr(repeats, "PART", 300)
    pieces = [(p, o) for p, o, _, _ in repeats._parts(raw, offsets, 100)]
    assert sum(repeats.segments(p, o, 100)[1].sum() for p, o in pieces) == whole == sum(max(0, s - 99) for s in sizes)


@pytest.mark.parametrize("most", [256, 8])
def test_crowded_anchors(make_documents, monkeypatch, most):
    """More segments under one anchor than one index takes, and also under a quarter of it."""
    monkeypatch.setattr(repeats, "SEGMENTS", most)
    pick = random.Random(9)
    word = lambda n: "".join(pick.choice("abcdefgh") for _ in range(n))
    middle, tails = word(60), [word(30) for _ in range(500)]
    rows = [(k, word(150) + tails[pick.randrange(500)] + middle + tails[pick.randrange(500)] + word(150)) for k in range(700)]
    assert got(remove_repeats(make_documents(rows))) == brute(rows)


def test_empty_and_repeated_rows(make_documents):
    assert remove_repeats(make_documents([])).collect() == []
    text = " ".join(str(i * i) for i in range(100))
    rows = remove_repeats(make_documents([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r["doc_id"], len(r["kept"])) for r in rows) == [(1, len(text))] * 2 + [(2, 0)]


def test_index_matching_statistics():
    pick = np.random.default_rng(4)
    for size, letters in ((60, 2), (400, 3), (1500, 40)):
        text = np.append(pick.integers(1, 1 + letters, size), 0)
        order = suffix_array(text)
        assert list(order) == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        query = np.concatenate([text[5:40], pick.integers(1, 2 + letters, 200), text[size // 2 : size // 2 + 60]])
        starts, ends = np.array([0, 30, 200]), np.array([30, 200, len(query)])
        words = text.tobytes()
        step = text.itemsize

        def longest(at, end):
            n = 0
            while at + n < end and any(words[i:].startswith(query[at : at + n + 1].tobytes()) for i in range(0, len(words), step)):
                n += 1
            return n

        for who, at, length in RunLengthIndex(text).matching_statistics(query, starts, ends):
            for w, a, n in zip(who, at, length):
                assert n == longest(a, ends[w])


def test_rows_without_an_own_id(make_documents):
    """Null ids and different texts of one id: marks belong to one row, and equal null rows are repeats."""
    pick = random.Random(5)
    word = lambda n: "".join(pick.choice("abcdefgh") for _ in range(n))
    passage = word(150)
    rows = [(k, text) for k in (None, 7) for text in (passage + word(900), word(500) + passage + word(400), word(1100))]
    rows += [(None, rows[2][1])] * 3 + [(None, None), (None, None), (7, None), (3, word(300)), (3, "")]
    seen, want = set(), []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())):
        gone = bytearray(len(text or ""))
        for k in range(len(gone) - 99):
            if text[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(text[k : k + 100])
        want.append((str(key), len(gone), "".join(c for c, g in zip(text or "", gone) if not g)))
    found = remove_repeats(make_documents(rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], bytes(r["kept"]).decode()) for r in found) == sorted(want)
