"""Token ids of whole texts by the tokenizers library, each distinct piece of text encoded once.

Both supported tokenizers first split a text into parts that are encoded on their own. A text is cut at
places that are certain to be such borders, the pieces are hashed, and the library encodes those
pieces that a task has not met before; ids of known pieces are looked up. The ids are those of the whole
text (tests compare them). Where a border is not certain no cut is made, so pieces can be long.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np

from patronage.llm.text import IS_SPACE, blocks, hash_spans

#: pieces that a worker remembers at most; then it starts anew
REMEMBERED = 1 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[33:127] = True
#: first bytes of sequences that may be white space or combine with what stands before
_UNSURE = np.zeros(256, dtype=bool)
_UNSURE[[0xC2, 0xCC, 0xCD, *range(0xE0, 0x100)]] = True


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file. `spaces`: a space belongs to the piece behind it; else white space has no ids."""

    path: str
    spaces: bool


def byte_bpe_50k(path: str | None = None) -> Vocabulary:
    return Vocabulary(path or _public("byte_bpe_50k.json"), True)


def word_bpe_49k(path: str | None = None) -> Vocabulary:
    return Vocabulary(path or _public("word_bpe_49k.json"), False)


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_starts(raw: np.ndarray, offsets: np.ndarray, spaces: bool) -> np.ndarray:
    """Where pieces start: at each text, and at certain borders inside."""
    n = len(raw)
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    if n > 2:
        # bytes that are certainly not white space: visible ASCII and the letters U+00C0 to U+00FF
        latin = np.zeros(n, dtype=bool)
        latin[1:] = raw[:-1] == 0xC3
        ends = _VISIBLE[raw] | (latin & (raw >= 0x80))
        begins = _VISIBLE[raw] | ((raw >= 0xC3) & ~_UNSURE[raw])
        between = ends[:-2] & begins[2:]
        space = between & (raw[1:-1] == 32)
        line = between & (raw[1:-1] == 10)
        if spaces:
            cut[1 : n - 1] |= space | line
            cut[2:n] |= line
        else:
            cut[1 : n - 1] |= space | line
            cut[2:n] |= space | line
        letter = _LETTER[raw] | (latin & (raw >= 0x80) & (raw != 0x97) & (raw != 0xB7))
        cut[1:n] |= letter[:-1] & _MARK[raw[1:]]
    return np.flatnonzero(cut[:-1])


class Encoder:
    """Encodes blocks of texts; remembers the ids of pieces."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        # one thread a task: Spark deals the cores out
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.spaces = vocabulary.spaces
        self.tokenizer = Tokenizer.from_file(vocabulary.path)
        self.tokenizer.encode_special_tokens = True
        self.forget()

    def forget(self) -> None:
        self.number: dict[int, int] = {}
        self.first, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.pool, self.used = np.zeros(1 << 14, np.uint32), 0

    def _learn(self, hashes: list[int], pieces: list[bytes]) -> None:
        known = len(self.number)
        found = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        ids = [e.ids for e in found]
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(sizes.sum()))
        while known + len(ids) > len(self.first):
            self.first, self.size = np.resize(self.first, 2 * len(self.first)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.used : self.used + len(flat)] = flat
        self.size[known : known + len(ids)] = sizes
        self.first[known : known + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        self.number.update(zip(hashes, range(known, known + len(ids))))

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a block, and where each text's begin."""
        starts = piece_starts(raw, offsets, self.spaces)
        ends = np.append(starts[1:], len(raw))
        if not self.spaces:
            solid = ~((ends == starts + 1) & IS_SPACE[raw[starts]]) if len(starts) else np.zeros(0, bool)
            starts, ends = starts[solid], ends[solid]
        hashes, where, back = np.unique(hash_spans(raw, starts, ends), return_index=True, return_inverse=True)
        if len(self.number) > REMEMBERED or self.used > 8 * REMEMBERED:
            self.forget()
        get = self.number.get
        keys = hashes.tolist()
        rows = np.array([get(h, -1) for h in keys], dtype=np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new):
            data = raw.tobytes()
            a, b = starts[where[new]].tolist(), ends[where[new]].tolist()
            known = len(self.number)
            self._learn([keys[k] for k in new], [data[i:j] for i, j in zip(a, b)])
            rows[new] = np.arange(known, known + len(new))
        piece = rows[back] if len(starts) else np.zeros(0, np.int64)
        sizes = self.size[piece]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.arange(total[-1]) + np.repeat(self.first[piece] - total[:-1], sizes)]
        return ids, total[np.searchsorted(starts, offsets)]


@cache
def encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(vocabulary)


def encoded_blocks(raw: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary):
    """First row, end row, ids and their offsets, for blocks of whole texts."""
    tool = encoder(vocabulary)
    for low, high, part, places in blocks(raw, offsets):
        yield (low, high, *tool.encode(part, places))
