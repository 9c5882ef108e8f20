"""Round trips of blocks and files; ids by the library on whole texts."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from patronage.llm import id_files
from patronage.llm.encoding import word_bpe_49k
from patronage.llm.id_files import from_planes, joined_crc, read_documents, read_range, to_planes, write_ids


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    pick = np.random.default_rng(1)
    for count in (1, 7, 8, 9, 1000, 4096):
        for high in (1, 2, 49408, 1 << 32):
            ids = pick.integers(0, high, count, dtype=np.uint64).astype(np.uint32)
            planes = to_planes(ids, bits)
            assert len(planes) == (32 if bits else 4)
            assert (from_planes(planes, count) == ids).all()
            if high == 49408 and count == 4096:
                assert planes[-1] == b"" and sum(map(len, planes)) < 2.2 * count


def test_joined_crc():
    pick = random.Random(1)
    for _ in range(50):
        a, b = pick.randbytes(pick.randrange(90)), pick.randbytes(pick.randrange(300))
        assert joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def expected(rows):
    tokenizer = Tokenizer.from_file(word_bpe_49k().path)
    tokenizer.encode_special_tokens = True
    at, out, stream = 0, [], []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        stream += ids
        at += len(ids)
    return out, stream


def as_rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("bits, block", [(False, 1 << 16), (True, 1 << 16), (False, 1000)])
def test_documents_round_trip(spark, documents, tmp_path, monkeypatch, bits, block):
    monkeypatch.setattr(id_files, "BLOCK_IDS", block)
    write_ids(documents, str(tmp_path / "ids"), word_bpe_49k(), 2, bits)
    want, stream = expected([(r["doc_id"], r["text"]) for r in documents.collect()])
    assert as_rows(read_documents(spark, str(tmp_path / "ids")).select("doc_id", "start", "n_tokens", "ids_crc32")) == want
    part = {r["position"]: r["id"] for r in read_range(spark, str(tmp_path / "ids"), 5000, 3000).collect()}
    assert part == dict(zip(range(5000, 8000), stream[5000:8000]))


def test_edge_rows(spark, make_documents, tmp_path, monkeypatch):
    monkeypatch.setattr(id_files, "BLOCK_IDS", 64)
    rows = [(5, "b"), (5, "a c"), (5, "b"), (None, "x y"), (None, None), (-3, ""), (7, "word " * 500), (9, None)]
    write_ids(make_documents(rows), str(tmp_path / "ids"), word_bpe_49k())
    got = as_rows(read_documents(spark, str(tmp_path / "ids")).select("doc_id", "start", "n_tokens", "ids_crc32"))
    assert got == expected(rows)[0]
    write_ids(make_documents([]), str(tmp_path / "none"), word_bpe_49k())
    assert read_documents(spark, str(tmp_path / "none")).collect() == []
