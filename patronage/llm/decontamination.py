"""Benchmark passages in documents, found by q-gram filtering and banded alignment.

An item of m bytes may differ from a passage by k = m * percent / 100 edits. By the q-gram lemma such
a passage shares at least m + 1 - q * (k + 1) q-grams with the item, all on k + 1 neighbouring
diagonals. Every q-gram of every text is looked up among those of the items; hits are counted per
document, item and diagonal band, bands being twice as wide as needed and overlapping by half, so one
band holds a whole passage. Bands under the bound are dropped, the rest are verified by alignment
inside the band. The filter loses nothing.

A-Z count as a-z and white space as a space. The items are taken in blocks of bounded size, each sent
to the tasks once; documents are not shuffled. Where k would leave no q-gram in common, k is lowered
until one is left; an item of fewer than q bytes matches nothing. Null texts are empty; null ids and
repeated rows are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from patronage.llm.text import IS_SPACE, LOWER, blocks, column_bytes, mix, words_of

Q = 8
#: bytes of benchmark text in one block, positions looked up at once
ITEM_BYTES, STEP = 4 << 20, 1 << 20
#: hashed counters of hits per text, item and stretch of diagonals, for a first bound
_COUNTERS, _STRETCH = 1 << 22, 1 << 12
_FOLD = LOWER.copy()
_FOLD[IS_SPACE] = 32
_FAR = 1 << 20


def fold(text: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and the two-byte capitals from U+00C0 to U+00DE; white space as a space."""
    text = _FOLD[text]
    capital = np.flatnonzero((text[1:] >= 0x80) & (text[1:] <= 0x9E) & (text[1:] != 0x97) & (text[:-1] == 0xC3)) + 1
    text[capital] += 0x20
    return text


class Items:
    """The q-grams of a block of items."""

    def __init__(self, ids: list, texts: list[str], percent: int) -> None:
        self.ids = ids
        self.texts = [fold(np.frombuffer(t.encode(), dtype=np.uint8)) for t in texts]
        self.size = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.budget = np.maximum(0, np.minimum(self.size * percent // 100, (self.size - Q) // Q))
        self.least = self.size + 1 - Q * (self.budget + 1)
        held = [i for i, t in enumerate(self.texts) if len(t) >= Q]
        grams = [words_of(self.texts[i])[: self.size[i] - Q + 1] for i in held]
        all_grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(all_grams, kind="stable")
        self.item = np.repeat(np.array(held, dtype=np.int64), [len(g) for g in grams])[order]
        self.place = np.concatenate([np.arange(len(g)) for g in grams])[order] if grams else np.zeros(0, np.int64)
        self.grams, self.first = np.unique(all_grams[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.seen = np.zeros(1 << 22, dtype=bool)
        self.seen[self._slot(self.grams)] = True

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def hits(self, text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, item, diagonal and item place of every q-gram that a text and an item have in common."""
        lanes, found = words_of(text), []
        for a in range(0, len(text), STEP):
            part = lanes[a : min(a + STEP, len(text))]
            found.append(np.flatnonzero(self.seen[self._slot(part)]) + a)
        at = np.concatenate(found) if found else np.zeros(0, np.int64)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + Q <= offsets[row + 1]
        at, row = at[inside], row[inside]
        grams = lanes[at]
        k = np.minimum(np.searchsorted(self.grams, grams), max(len(self.grams) - 1, 0))
        same = self.grams[k] == grams if len(self.grams) else np.zeros(len(at), dtype=bool)
        at, row, k = at[same], row[same], k[same]
        many = self.first[k + 1] - self.first[k]
        entry = np.repeat(self.first[k] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        row = np.repeat(row, many)
        return row, self.item[entry], np.repeat(at, many) - offsets[row] - self.place[entry], self.place[entry]

    def find(self, text: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, start, end, edits) of each passage within its item's budget."""
        row, item, diagonal, gram = self.hits(text, offsets)
        if not len(row):
            return []
        # most hits are chance: too few near their diagonal even when all of them count
        place = (row * len(self.ids) + item) << 20
        cell = diagonal // _STRETCH
        slots = [((mix((place + cell + d).astype(np.uint64))) % np.uint64(_COUNTERS)).astype(np.int64) for d in (-1, 0, 1)]
        counts = np.bincount(slots[1], minlength=_COUNTERS)
        near = counts[slots[1]] + np.maximum(counts[slots[0]], counts[slots[2]]) >= self.least[item]
        row, item, diagonal, gram = row[near], item[near], diagonal[near], gram[near]
        out: dict[tuple[int, int, int], tuple[int, int]] = {}
        # all q-grams of an item on one diagonal: the item itself, no alignment needed
        (r, i, d), count = _counted(row, item, diagonal)
        whole: dict[tuple[int, int], list[int]] = {}
        for n in np.flatnonzero(count == self.size[i] - Q + 1):
            whole.setdefault((int(r[n]), int(i[n])), []).append(int(d[n]))
            out[int(r[n]), int(i[n]), int(d[n] + self.size[i[n]])] = (int(d[n]), 0)
        low = diagonal // (self.budget[item] + 1)
        # an item's q-gram counts once in a band, however often the text repeats it
        distinct, _ = _counted(np.tile(row, 2), np.tile(item, 2), np.concatenate([low, low - 1]), np.tile(gram, 2))
        (row, item, band), count = _counted(*distinct[:3])
        held = np.flatnonzero(count >= self.least[item])
        row, item, diagonal = row[held], item[held], band[held] * (self.budget[item[held]] + 1)
        width = 2 * (self.budget[item] + 1)
        left = [
            n
            for n in np.argsort(self.size[item], kind="stable").tolist()
            if not any(diagonal[n] <= e < diagonal[n] + width[n] for e in whole.get((int(row[n]), int(item[n])), ()))
        ]
        for a in range(0, len(left), 64):
            part = np.array(left[a : a + 64])
            self._align(text, offsets, row[part], item[part], diagonal[part], width[part], out)
        return [(r, i, start, end, edits) for (r, i, end), (start, edits) in sorted(out.items())]

    def _align(self, text, offsets, row, item, diagonal, width, out) -> None:
        budget = self.budget[item]
        # whole band and the budget on both sides
        low = diagonal - budget
        wide = width + 2 * budget
        edits, end = _banded(text, offsets[row], offsets[row + 1], [self.texts[i] for i in item], low, wide, None)
        good = [n for n in np.flatnonzero(edits <= budget) if (int(row[n]), int(item[n]), int(end[n])) not in out]
        if not good:
            return
        # aligned backwards from the ends found, the starts are where the items end
        row, item, end, edits, budget = row[good], item[good], end[good], edits[good], budget[good]
        begin = offsets[row] + np.maximum(0, end - self.size[item] - budget)
        back = [text[a:b][::-1] for a, b in zip(begin, offsets[row] + end)]
        places = np.concatenate([[0], np.cumsum([len(b) for b in back])])
        _, length = _banded(
            np.concatenate(back), places[:-1], places[1:], [self.texts[i][::-1] for i in item], -budget, 2 * budget + 1, 0
        )
        for n in range(len(good)):
            out[int(row[n]), int(item[n]), int(end[n])] = (int(end[n] - length[n]), int(edits[n]))


def _counted(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of the columns, sorted, and how often each occurs."""
    keys = np.stack(columns)
    keys = keys[:, np.lexsort(keys[::-1])]
    fresh = np.ones(keys.shape[1], dtype=bool)
    fresh[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    edge = np.flatnonzero(fresh)
    return keys[:, edge], np.diff(np.append(edge, keys.shape[1]))


def _banded(text, begin, stop, items, low, wide, start) -> tuple[np.ndarray, np.ndarray]:
    """Least edits between each whole item and a substring of its text inside a band of diagonals, and
    where that substring ends. The substring starts anywhere, or at `start`."""
    size = np.array([len(t) for t in items])
    n, most = len(items), int(wide.max())
    offset = np.arange(most, dtype=np.int32)
    length = (stop - begin)[:, None]
    place = (low[:, None] + offset).astype(np.int32)  # text place of each cell at item place 0
    outside = offset >= wide[:, None]
    pad = int(size.max())
    patterns = np.zeros((n, pad), dtype=np.int16)
    for k, t in enumerate(items):
        patterns[k, : len(t)] = t
    cost = np.where((place < 0) | (place > length) | outside, _FAR, 0).astype(np.int32)
    if start is not None:
        cost = np.where(place == start, 0, _FAR).astype(np.int32)
    best, end = np.full(n, _FAR), np.zeros(n, np.int64)

    def finish(done: np.ndarray, place: np.ndarray) -> None:
        at = cost[done].argmin(axis=1)
        best[done] = cost[done, at]
        end[done] = place[done, at]

    for j in range(pad):
        symbol_at = place + j
        held = (symbol_at >= 0) & (symbol_at < length)
        symbols = np.where(held, text[np.minimum(np.maximum(begin[:, None] + symbol_at, 0), max(len(text) - 1, 0))], -1)
        replace = cost + (symbols != patterns[:, j : j + 1])
        replace[~held] = _FAR
        skip = np.full_like(cost, _FAR)
        skip[:, :-1] = cost[:, 1:] + 1
        cost = np.minimum(replace, skip)
        now = symbol_at + 1
        cost[(now < 0) | (now > length) | outside] = _FAR
        cost = np.minimum.accumulate(cost - offset, axis=1) + offset
        cost[(now < 0) | (now > length) | outside] = _FAR
        done = np.flatnonzero(size == j + 1)
        if len(done):
            finish(done, now)
    return best, end


def _item_blocks(benchmark: DataFrame, percent: int) -> Iterator[Items]:
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // ITEM_BYTES)
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        if part:
            yield Items([r["item_id"] for r in part], [r["text"] for r in part], percent)


def contaminated_passages(documents: DataFrame, benchmark: DataFrame, percent: int = 10) -> DataFrame:
    """(doc_id, item_id, start, end, edits): the passages, as byte ranges of the texts."""
    spark, schema = documents.sparkSession, "doc_id bigint, item_id bigint, start bigint, end bigint, edits int"
    out = spark.createDataFrame([], schema)
    for items in _item_blocks(benchmark, percent):
        shared = spark.sparkContext.broadcast(items)

        def search(batches, shared=shared):
            index = shared.value
            for batch in batches:
                raw, offsets = column_bytes(batch.column(1))
                for low, _, part, places in blocks(raw, offsets):
                    found = index.find(fold(part), places)
                    if found:
                        rows, numbers, starts, ends, edits = zip(*found)
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array([low + r for r in rows])),
                                pa.array([index.ids[i] for i in numbers], pa.int64()),
                                pa.array(starts, pa.int64()),
                                pa.array(ends, pa.int64()),
                                pa.array(edits, pa.int32()),
                            ],
                            names=["doc_id", "item_id", "start", "end", "edits"],
                        )

        out = out.unionByName(documents.select("doc_id", "text").mapInArrow(search, schema))
    return out


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, percent: int = 10) -> DataFrame:
    """The rows whose text holds no passage of an item, with all their columns."""
    spark, where = documents.sparkSession, documents.columns.index("text")
    for items in _item_blocks(benchmark, percent):
        shared = spark.sparkContext.broadcast(items)

        def clean(batches, shared=shared):
            for batch in batches:
                raw, offsets = column_bytes(batch.column(where))
                keep = np.ones(len(batch), dtype=bool)
                for low, _, part, places in blocks(raw, offsets):
                    keep[[low + f[0] for f in shared.value.find(fold(part), places)]] = False
                yield batch.filter(pa.array(keep))

        documents = documents.mapInArrow(clean, documents.schema)
    return documents
