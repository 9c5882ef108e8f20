"""The join against all pairs."""

import itertools
import random
import re

import numpy as np
import pytest

from patronage.llm import ngram_join
from patronage.llm.components import connected_components
from patronage.llm.ngram_join import ngram_jaccard_join


def brute(rows, size, percent):
    sets = {}
    for key, text in rows:
        words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())]
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets[key] = grams or ({tuple(words)} if words else set())
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {k: (len(s), root(k)) for k, s in sets.items()}


def got(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_equals_all_pairs(documents, size, percent):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got(ngram_jaccard_join(documents, size, percent)) == brute(rows, size, percent)


def test_large_group_of_near_copies(make_documents):
    """Edited copies of one text, some just over and some just under the threshold, in frequent words."""
    pick = random.Random(5)
    base = [f"w{pick.randrange(40)}" for _ in range(150)]
    rows = []
    for key in range(220):
        words = list(base)
        for _ in range(key % 12):
            words[pick.randrange(len(words))] = pick.choice(["and", f"x{pick.randrange(9)}", f"y{key}"])
        rows.append((key, " ".join(words)))
    rows += [(500 + k, " ".join(f"z{k}_{i}" for i in range(30))) for k in range(20)]
    frame = ngram_jaccard_join(make_documents(rows), 3, 90)
    assert got(frame) == brute(rows, 3, 90)


def test_edge_rows(make_documents):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A b"), (6, "a  B"), (7, "é" * 5000), (8, "a b c"), (9, "a b c d")]
    assert got(ngram_jaccard_join(make_documents(rows), 3, 90)) == brute(rows, 3, 90)
    twice = make_documents([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d")])
    out = sorted(ngram_jaccard_join(twice, 3, 90).collect(), key=str)
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in out) == [
        ("1", 2, 1), ("1", 2, 1), ("2", 2, 1), ("None", 2, None),
    ]
    assert ngram_jaccard_join(make_documents([]), 3, 90).collect() == []


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (103, 103)]
    frame = connected_components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    found = {r["node"]: r["component"] for r in frame.collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100}


def test_lines_in_common_are_no_key(make_documents, monkeypatch):
    """Documents that have single lines in common, each as often as a fixed limit would allow, do not meet."""
    pick = random.Random(3)
    lines = [" ".join(f"l{k}_{j}" for j in range(30)) for k in range(60)]
    rows = [(key, " ".join(pick.sample(lines, 4))) for key in range(200)]
    rows += [(300 + key, f"{rows[key][1]} end") for key in range(10)]
    met = []
    store = ngram_join.store

    def counted(frame, name):
        out = store(frame, name)
        if name == "keys":
            met.append(out.select("doc_id").distinct().count())
        return out

    monkeypatch.setattr(ngram_join, "store", counted)
    assert got(ngram_jaccard_join(make_documents(rows), 3, 90)) == brute(rows, 3, 90)
    assert met[0] < 120


@pytest.mark.parametrize("percent", [50, 80, 90, 99])
def test_similar_sets_share_a_key(percent):
    """Sets of every size that are just similar, one larger or both with tokens of their own."""
    pick = np.random.default_rng(1)
    bounds = ngram_join._Bounds(percent)
    for n in [*range(1, 60), 137, 400, 1001]:
        common = -(-n * percent // 100)
        for own in {0, (n - common) // 2}:
            every = pick.integers(0, 1 << 63, n, dtype=np.uint64)
            a, b = np.sort(every[: n - own]), np.sort(np.concatenate([every[:common], every[n - own :]]))
            if 100 * common < percent * n:
                continue
            keys, base = ngram_join.group_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), bounds)
            assert set(keys[: base[1]].tolist()) & set(keys[base[1] :].tolist())


@pytest.mark.parametrize("percent", [80, 90])
def test_sets_without_common_tokens_share_no_key(percent):
    """A group without tokens is equal in any two sets of a class, so it is no key where fuller groups do."""
    pick = np.random.default_rng(2)
    sizes = pick.integers(30, 600, 200)
    base = np.concatenate([[0], np.cumsum(sizes)])
    tokens = np.concatenate([np.sort(pick.integers(0, 1 << 63, n, dtype=np.uint64)) for n in sizes])
    keys, _ = ngram_join.group_keys(tokens, base, ngram_join._Bounds(percent))
    assert len(np.unique(keys)) == len(keys)
