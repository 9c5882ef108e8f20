"""The layout of all pieces, ids by the library on whole texts, and the mixture of every sequence."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from patronage.llm import packing
from patronage.llm.encoding import Encoder, byte_bpe_50k, word_bpe_49k
from patronage.llm.packing import Schedule, pack
from patronage.llm.text import blocks, column_bytes

ODD = " |  |\n|\n\n| \n|\t|a|é|×|÷|ß|'s|'|'ll|.|!!|12|3| |　|́|日本|🙂|x|Zed| the|-|\x1c|\x85|<|endoftext|>|\r\n|Σ|İ|\x00".split("|")


def library(vocabulary):
    tokenizer = Tokenizer.from_file(vocabulary.path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("vocabulary", [byte_bpe_50k(), word_bpe_49k()])
def test_ids_of_pieces_are_those_of_whole_texts(documents, vocabulary, monkeypatch):
    import pyarrow as pa

    from patronage.llm import encoding

    monkeypatch.setattr(encoding, "REMEMBERED", 3000)
    pick = random.Random(2)
    texts = ["".join(pick.choice(ODD) for _ in range(pick.randrange(40))) for _ in range(1500)]
    texts += [r["text"] for r in documents.collect()] + [None, "", "é" * 3000, "a" * 9000]
    whole, tool = library(vocabulary), Encoder(vocabulary)
    raw, offsets = column_bytes(pa.array(texts))
    for low, high, part, places in blocks(raw, offsets, 60000):
        ids, first = tool.encode(part, places)
        for k in range(high - low):
            assert ids[first[k] : first[k + 1]].tolist() == whole(texts[low + k])


def check(rows, pieces, length):
    whole = library(byte_bpe_50k())
    ids = {k: np.array(whole(t) + [1], dtype="<u4") for k, t in rows}
    documents, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        documents[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert len(part) == p["length"] > 0 and zlib.crc32(part.tobytes()) == p["ids_crc32"]
        assert p["doc_tokens"] == len(ids[p["doc_id"]])
    for key, found in documents.items():
        at = 0
        for p in sorted(found, key=lambda p: p["start"]):
            assert p["start"] == at
            at += p["length"]
        assert at == len(ids[key])
    assert set(documents) == set(ids)
    total = sum(map(len, ids.values()))
    assert sorted(sequences) == list(range(-(-total // length)))
    for number, found in sequences.items():
        at = 0
        for p in sorted(found, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == min(length, total - number * length)
    return sequences


def test_all_documents(documents):
    rows = documents.collect()
    pieces = pack(documents, byte_bpe_50k()).collect()
    sequences = check([(r["doc_id"], r["text"]) for r in rows], pieces, 2048)
    source, tokens = {r["doc_id"]: r["source"] for r in rows}, defaultdict(int)
    for p in pieces:
        tokens[source[p["doc_id"]]] += p["length"]
    total = sum(tokens.values())
    for number in list(sequences)[:-3]:
        mixture = defaultdict(int)
        for p in sequences[number]:
            mixture[source[p["doc_id"]]] += p["length"]
        assert all(abs(mixture[s] / 2048 - n / total) < 0.02 for s, n in tokens.items())


def test_target_weights(spark):
    rows = [(k, "some words here " * (k % 50), "ab"[k % 2], k) for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n bigint").repartition(4)
    pieces = pack(frame, byte_bpe_50k(), length=256, weights={"a": 3, "b": 1}).collect()
    sequences = check([(k, t) for k, t, _, _ in rows], pieces, 256)
    source = {k: s for k, _, s, _ in rows}
    for number in range(len(sequences) // 2):
        share = sum(p["length"] for p in sequences[number] if source[p["doc_id"]] == "a") / 256
        assert abs(share - 0.75) < 0.02


def test_edge_rows(spark, monkeypatch):
    schema = "doc_id bigint, text string, source string"
    rows = [(1, None, None), (2, "", "s"), (3, "word " * 5000, "s"), (4, "a", "t"), (-7, "b c", "u")]
    pieces = pack(spark.createDataFrame(rows, schema), byte_bpe_50k(), length=64).collect()
    check([(k, t) for k, t, _ in rows], pieces, 64)
    monkeypatch.setattr(packing, "QUEUES", 2)
    check([(k, t) for k, t, _ in rows], pack(spark.createDataFrame(rows, schema), byte_bpe_50k(), length=64).collect(), 64)
    assert pack(spark.createDataFrame([], schema), byte_bpe_50k()).collect() == []
    twice = pack(spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (None, "c", "s")], schema), byte_bpe_50k()).collect()
    assert len(twice) == 3 and len({(p["sequence_id"], p["offset"]) for p in twice}) == 3


def test_schedule_serves_every_token_once():
    pick = random.Random(4)
    for _ in range(60):
        totals = [pick.choice([0, 1, 5, pick.randrange(3000)]) for _ in range(pick.randrange(1, 9))]
        plan = Schedule(totals, [pick.choice([1, 3, 1000, 10**12]) for _ in totals], pick.choice([1, 7, 64, 2048]))
        queue, start, size = [], [], []
        for q, n in enumerate(totals):
            at = 0
            while at < n:
                step = min(n - at, pick.randrange(1, 400))
                queue.append(q), start.append(at), size.append(step)
                at += step
        doc, offset, count, place = plan.lay_out(*(np.array(x, dtype=np.int64) for x in (queue, start, size)))
        spots = np.concatenate([np.arange(p, p + c) for p, c in zip(place, count)]) if len(doc) else np.zeros(0)
        assert sorted(spots.tolist()) == list(range(sum(totals)))
        for q, n in enumerate(totals):
            mine = np.array(queue)[doc] == q if len(doc) else np.zeros(0, bool)
            tokens = [np.array(start)[d] + o + np.arange(c) for d, o, c in zip(doc[mine], offset[mine], count[mine])]
            where = [p + np.arange(c) for c, p in zip(count[mine], place[mine])]
            order = np.argsort(np.concatenate(where)) if where else []
            assert not where or np.concatenate(tokens)[order].tolist() == list(range(n))


def test_schedules_with_shares_far_apart():
    """Every token of every queue is laid once, without gaps, whatever the totals and weights."""
    pick = random.Random(11)
    fixed = [278, 4636, 16768, 237855, 41, 673, 10485, 446445, 47, 24197]
    for trial in range(300):
        n = pick.randrange(2, 12)
        totals = fixed if trial == 0 else [int(2 ** pick.uniform(0, 14)) for _ in range(n)]
        weights = totals if trial % 2 == 0 else [pick.choice([1, pick.randrange(1, 60000)]) for _ in totals]
        schedule = Schedule(list(totals), list(weights), pick.choice([16, 64, 2048]))
        queue, start, size = [], [], []
        for q, total in enumerate(totals):
            at = 0
            while at < total:
                length = min(total - at, pick.randrange(1, 97))
                queue.append(q), start.append(at), size.append(length)
                at += length
        doc, offset, count, place = schedule.lay_out(np.array(queue), np.array(start), np.array(size))
        assert (count > 0).all() and count.sum() == sum(totals)
        assert (place % schedule.length + count <= schedule.length).all()
        order = np.argsort(place)
        assert place[order[0]] == 0 and (place[order][1:] == (place + count)[order][:-1]).all()
        per_document = np.bincount(doc, count, len(size))
        assert per_document.tolist() == size
