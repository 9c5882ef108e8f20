"""The baseline against plain counting, the tree's scores against a walk over states, one symbol at a time."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import suffix_tree as st
from patronage.llm.text import held_out


def tokens(text):
    return [w.lower() for w in re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())] + [None]


def baseline(rows):
    held = {k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows}
    seen = Counter(t for k, text in rows if not held[k] for t in tokens(text))
    total = sum(seen.values())
    return [
        (
            k, held[k], len(tokens(text)), sum(seen[t] > 0 for t in tokens(text)), total,
            sum(math.log10((seen[t] + 1) / (total + len(seen) + 1)) for t in tokens(text)),
        )
        for k, text in rows
    ]


def scored(frame):
    return st.suffix_tree_scores(frame, held_out(frame["doc_id"], 7, 2)).collect()


def same(rows, got):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    for want, have in zip(sorted(baseline(rows), key=key), sorted(got, key=key), strict=True):
        assert want[:5] == tuple(have)[:5]
        assert have["base_score"] == pytest.approx(want[5], rel=1e-9)


def test_baseline(documents, monkeypatch):
    monkeypatch.setattr(st, "BLOCK_IDS", 32)
    got = scored(documents)
    same([(r["doc_id"], r["text"]) for r in documents.collect()], got)
    # held-out texts: the tree predicts bytes, so it is compared with 5 bits a byte
    held = [r for r in got if r["held_out"]]
    text = {r["doc_id"]: r["text"] for r in documents.collect()}
    size = sum(len(text[r["doc_id"]].encode()) + 1 for r in held)
    assert len(held) > 10 and -sum(r["score"] for r in held) / math.log10(2) / size < 3.6


def test_edge_rows(make_documents):
    rows = [(1, None), (2, ""), (2, "a b"), (2, "a b"), (3, "Aé \x1c b " * 4000), (None, "a"), (None, None), (8, " \n "), (-4, "c")]
    got = scored(make_documents(rows))
    same(rows, got)
    assert all(r["score"] < 0 for r in got)
    assert scored(make_documents([])) == []
    only_held = [(k, "x y") for k in range(60) if zlib.crc32(str(k).encode()) % 7 == 2]
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in scored(make_documents(only_held)))


@pytest.fixture(scope="module")
def tree(documents):
    return st.build_tree(st._ngram_counts(documents.withColumn("held_out", F.lit(False))))


def test_distributions_sum_to_one(tree):
    assert np.allclose((10**tree.log_class).sum(axis=1), 1)
    assert np.allclose(np.bincount(st.CLASS, weights=10**tree.log_byte)[: st.CLASSES].sum(), len(set(st.CLASS.tolist())))
    assert set(tree.depth.tolist()) == {0, 1, 2, 3, 4} and len(tree.depth) > 500


def test_scores_follow_the_longest_state(tree):
    texts = ["", "the and", "Aé\n12;", "x" * 50]
    raw = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    for text, score in zip(texts, tree.scores(raw, offsets)):
        past, total = [st._OTHER] * st.DEPTH, 0.0
        for b in [*(x + 32 if 65 <= x <= 90 else x for x in text.encode()), st._END]:
            context = 0
            for c in past[-st.DEPTH :]:
                context = context * st.CLASSES + c
            c = int(st.CLASS[b])
            total += tree.log_class[tree.state[context], c] + tree.log_byte[b]
            past.append(c)
        assert score == pytest.approx(total)


def test_divergence_decides(tree):
    """A context that behaves like its suffix is no state of its own."""
    counts = {}
    for a in range(26):
        for b in range(26):
            counts[a << 5 | b] = 100  # the class before says nothing
    counts[26 << 5 | 0] = 5000  # after a space always class 0
    rows = [(0, code, n) for code, n in counts.items()]

    from pyspark.sql import SparkSession

    frame = SparkSession.getActiveSession().createDataFrame(rows, "kind int, code int, n bigint")
    built = st.build_tree(frame)
    assert built.depth.max() >= 1 and built.state[26] != 0
    assert built.log_class[built.state[26]].argmax() == 0


def by_runs(tree, rows, held):
    """The scores from plain counts of runs of words, one token at a time."""
    counts = Counter()
    for (_, text), out in zip(rows, held):
        if not out:
            line = tokens(text)
            counts.update(tuple(line[i:j]) for i in range(len(line)) for j in range(i + 1, min(len(line), i + st.ORDER) + 1))
    seen = sum(n for run, n in counts.items() if len(run) == 1)
    distinct = max(1, sum(len(run) == 1 for run in counts))
    prob = lambda node, b: 10 ** (tree.log_class[node, st.CLASS[b]] + tree.log_byte[b])
    white = [*b" \t\n\x0b\x0c\r"]
    for _, text in rows:
        line = [*(x + 32 if 65 <= x <= 90 else x for x in (text or "").encode()), st._END]
        nodes = []
        for k in range(len(line)):
            context = 0
            for c in ([st._OTHER] * st.DEPTH + [int(st.CLASS[b]) for b in line[:k]])[-st.DEPTH :]:
                context = context * st.CLASSES + c
            nodes.append(int(tree.state[context]))
        total, past, k = 0.0, [], 0
        closes = lambda k: sum(prob(nodes[k], b) for b in [*white, st._END])
        after_word = False
        while True:
            # white space, then a word or the end
            start = k
            while line[k] in white:
                total += math.log10(prob(nodes[k], line[k]) / (closes(k) if after_word and k == start else 1))
                k += 1
            if line[k] == st._END and after_word and k == start:
                total += math.log10(prob(nodes[k], st._END) / closes(k))
                break
            stop = 1 - sum(prob(nodes[k], b) for b in white)
            total += math.log10(stop)
            end = k
            while line[end] != st._END and line[end] not in white:
                end += 1
            word = bytes(line[k:end]) if end > k else None
            spelled = math.prod(prob(nodes[i], line[i]) for i in range(k, end)) * closes(end) if word else prob(nodes[k], st._END)
            p = (counts[word,] + distinct * spelled / stop) / (seen + distinct)
            for size in range(1, min(len(past), st.ORDER - 1) + 1):
                context = tuple(past[-size:])
                p = (counts[(*context, word)] + st.WORD_WEIGHT * p) / (counts[context] + st.WORD_WEIGHT)
            total += math.log10(p)
            if word is None:
                break
            past.append(word)
            k, after_word = end, True
        yield total


def test_scores_are_those_of_runs_of_words(make_documents, monkeypatch):
    monkeypatch.setattr(st, "BLOCK_IDS", 8)
    rows = [(k, " ".join(f"{'ABcé7'[j % 5]}{j * j * k % 7}" for j in range(k % 13))) for k in range(60)]
    rows += [(70, None), (71, " \n "), (72, "a \t b\n"), (73, "c1  c1 c1"), (74, "数 字 数 字"), (None, "a b")]
    frame = make_documents(rows)
    held = [k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows]
    built = st.build_tree(st._ngram_counts(frame.withColumn("held_out", held_out(frame["doc_id"], 7, 2))))
    want = {k: s for (k, _), s in zip(rows, by_runs(built, rows, held))}
    have = {r["doc_id"]: r["score"] for r in scored(frame)}
    assert sum(held) > 5 and have == pytest.approx(want)


def test_phrases_are_learned(make_documents):
    """Words of one length in the order of the corpus score far better than out of order; the states grow."""
    words = [f"{'bcdfghjklm'[k // 10]}{'aeiou'[k % 5]}{'npqrstvwxz'[k % 10]}{k:02d}数" for k in range(100)]
    held = [k for k in range(300) if zlib.crc32(str(k).encode()) % 7 == 2]
    line = lambda k: " ".join(words[(k + j) % 100] for j in range(30))
    mixed = lambda k: " ".join(words[(k + 37 * j) % 100] for j in range(30))
    frame = make_documents([(k, mixed(k) if k in held[:9] else line(k)) for k in range(300)])
    got = {r["doc_id"]: r["score"] for r in scored(frame) if r["held_out"]}
    assert max(got[k] for k in held[:9]) < 4 * min(got[k] for k in held[9:])
    sizes = [
        sum(r["different"] for r in st._answers(f.select("text", F.col("doc_id").alias("block"), F.lit(False).alias("held_out")), 3, 2).collect())
        for f in (frame.where("doc_id < 20"), frame)
    ]
    assert sizes[1] > 1.5 * sizes[0]


def test_packed_runs_come_back():
    pick = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 1 << 62), (1000, 1 << 40), (50_000, 1 << 63), (300, 1 << 20)):
        keys = np.sort(pick.integers(0, top, n, dtype=np.uint64))
        values = np.where(pick.random(n) < 0.01, pick.integers(1, 1 << 40, n), 1)
        k, v = st._unpacked(st._packed(keys, values))
        assert k.tolist() == keys.tolist() and v.tolist() == values.tolist()
    dense = np.sort(pick.integers(0, 1 << 41, 2000, dtype=np.uint64))
    assert len(st._packed(dense, np.ones(2000))) < 4.3 * 2000


def test_answers_hold_no_hashes(make_documents):
    """A number of a byte or less goes back for a run that two blocks hold, and the counts are those of all blocks."""
    pick = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in pick.integers(0, 1 << 30, 200)) for _ in range(60)]
    frame = make_documents([(k, texts[k % 60]) for k in range(120)])
    asked = frame.select("text", F.floor(F.col("doc_id") / 60).alias("block"), F.lit(False).alias("held_out"))
    answers = st._answers(asked, 3, 2, 40)
    data = next(name for name, kind in answers.dtypes if kind == "binary")
    rows = answers.collect()
    runs = 60 * 199  # of three tokens, the end one of them
    assert (sum(r["different"] for r in rows), sum(r["n"] for r in rows)) == (runs, 2 * runs)
    assert sum(len(r[data]) for r in rows) < 2 * runs


def test_counts_of_a_block_in_several_parts():
    pick = np.random.default_rng(6)
    keys = (pick.integers(0, 500, 3000, dtype=np.uint64) << np.uint64(6)) | (pick.integers(0, 2, 3000, dtype=np.uint64) << np.uint64(1))
    plain, shift = keys & ~st._HELD_OUT, 11
    every = np.unique(plain)
    trained = np.isin(every, plain[(keys & st._HELD_OUT) == 0])
    want = np.where(trained, pick.integers(1, 70_000, len(every)), 0)
    buckets = (every >> np.uint64(shift)).astype(int)
    answers = [(int(b), st._packed_counts((want - trained)[buckets == b])) for b in np.unique(buckets)]
    have = st._counts(keys, answers, shift)
    assert have.tolist() == want[np.searchsorted(every, plain)].tolist()
    assert st._counts(np.zeros(0, np.uint64), [], shift).tolist() == []


def test_memory_of_steps(tree):
    """A task that scores a text holds few numbers for each of its bytes."""
    raw = np.random.default_rng(8).integers(97, 123, 1 << 18, dtype=np.uint8)
    raw[::6] = 32
    tracemalloc.start()
    tree.scores(raw, np.array([0, 100, len(raw)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(raw)
