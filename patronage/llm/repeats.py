"""Removal of repeated byte strings, exact over a whole corpus, by run-length indexes.

A byte is removed when it lies in a string of `length` bytes that also starts earlier: in a document
with a smaller doc_id, or earlier in the same document. Strings are judged on the input.

1. Every window of `length` bytes belongs to the anchor with the smallest hash among its k-grams
   (the leftmost of equal ones), so equal windows have equal anchors at equal places. Neighbouring
   windows with one anchor form a segment. Segments with equal bytes are reduced to the first one
   inside each block of text, before anything is shuffled; the others are marked as repeats.
2. Segments meet by anchor. Equal ones are reduced again, to the first. Most anchors then have one
   segment left and are done. So are segments whose bytes around the anchor differ from all others'.
3. Where different segments share an anchor, their bytes are fetched. The segments of an anchor are
   ordered by place, and halves of growing blocks are compared: a run-compressed Burrows-Wheeler
   index with sampled run ends holds the earlier halves, the later halves are streamed through it,
   and a window is marked where its matching statistic reaches `length`. Every two segments meet
   once. The anchor's first byte is replaced by the number of its block, so a match means the same
   anchor. One index holds many anchors; its text is bounded.
4. The segments of an anchor with very many of them are cut into quarters by the anchor's place in the
   window. The windows of a quarter have most of their bytes in common; a hash of these is a new, much
   narrower anchor, and steps 2 and 3 follow for it. What is crowded even then (hundreds of different
   segments around 80 equal bytes) is grouped by a 128-bit hash of each window's bytes, with a combined
   minimum, and all windows but the first are marked.
5. Marks are joined to the documents, united and cut out.

Null and empty texts have no windows. Every row with a null doc_id is a document of its own; they come
before all others, in the order of the MD5 of their texts. Different texts of one doc_id are documents of
their own too, in that order. Only rows with equal doc_id and text are one document: none is earlier than
the other, and all get the same marks. Where ids are null or repeated, the rows are numbered in a stored
table and the numbers are the keys; otherwise the ids are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from patronage.llm.run_length_index import RunLengthIndex
from patronage.llm.text import column_bytes, mix, release, store, words_of

_U = np.uint64
#: bytes of an anchor, of a block of text, of the text of one index; segments of an anchor in an index
ANCHOR, BLOCK, INDEX, SEGMENTS = 32, 1 << 17, 1 << 20, 256
#: segments that a task reduces at once
FLUSH = 1 << 20
#: a text is cut into parts of this many windows, so that a place fits the low bits of a hash
PART = 1 << 22
_LOW = 24
_FACTORS = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _parts(raw: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of text: bytes, offsets, the row of each piece and its start in the row's text.

    Long texts come in overlapping parts, each window in exactly one.
    """
    n, low = len(offsets) - 1, 0
    while low < n:
        size = offsets[low + 1] - offsets[low]
        if size > BLOCK:
            for start in range(0, int(size) - length + 1, PART):
                end = min(int(size), start + PART + length - 1)
                a = int(offsets[low])
                yield raw[a + start : a + end], np.array([0, end - start]), np.array([low]), np.array([start])
            low += 1
            continue
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + BLOCK, "right")) - 1)
        rows = np.arange(low, high)
        yield raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], rows, np.zeros(len(rows), np.int64)
        low = high


def _window_hashes(lanes: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hashes of the windows of `length` bytes that start at `at`."""
    h = np.full(len(at), seed, dtype=np.uint64)
    for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        h = (h ^ lanes[at + k]) * _FACTORS[0]
        h ^= h >> _U(31)
    return mix(h)


def segments(raw: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of windows with one anchor: start, number of windows, anchor's place and hash, bytes' hash."""
    n, reach = len(raw), length - ANCHOR + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 6
    lanes = words_of(raw)
    grams = n - ANCHOR + 1
    h = lanes[:grams] * _FACTORS[0]
    h ^= h >> _U(32)
    for j in (8, 16, 24):
        h = (h + lanes[j : j + grams]) * _FACTORS[j // 8]
        h ^= h >> _U(32)
    h *= _FACTORS[0]
    h &= ~_U((1 << _LOW) - 1)
    h |= np.arange(grams, dtype=np.uint64)
    # smallest of each `reach` neighbours from running minima inside blocks of that length
    count = -(-grams // reach)
    padded = np.full(count * reach, ~_U(0))
    padded[:grams] = h
    grid = padded.reshape(count, reach)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = n - length + 1
    least = np.minimum(back[:windows], ahead[reach - 1 : reach - 1 + windows])
    # windows that would reach over the end of their text
    edge = np.zeros(windows + 1, dtype=np.int32)
    ends = offsets[1:]
    lows = np.minimum(np.maximum(offsets[:-1], ends - length + 1), windows)
    np.add.at(edge, lows, 1)
    np.add.at(edge, np.minimum(ends, windows), -1)
    inside = np.cumsum(edge[:-1]) == 0
    change = np.ones(windows, dtype=bool)
    change[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change)
    counts = np.diff(np.append(first, windows))
    held = inside[first]
    first, counts = first[held], counts[held]
    anchor = least[first]
    place = (anchor & _U((1 << _LOW) - 1)).astype(np.int64)
    name = (anchor >> _U(_LOW)).astype(np.int64)
    # a segment is shorter than two windows, so its first and last window cover it
    whole = mix(
        _window_hashes(lanes, first, length, 1) + _window_hashes(lanes, first + counts - 1, length, 2) * _FACTORS[1] + counts.astype(np.uint64)
    )
    return first, counts, place, name, whole.view(np.int64), _sides(lanes, first, counts, place, length)


def _sides(lanes: np.ndarray, first: np.ndarray, counts: np.ndarray, anchor: np.ndarray, length: int) -> np.ndarray:
    """Four bytes per segment, one for each quarter of the places that an anchor can have in a window:
    a hash of the bytes that all windows of the quarter have, or 0 where the segment has no such window.
    Two segments with an equal window agree in one of the four."""
    free = length - ANCHOR
    step = -(-(free + 1) // 4)
    out = np.zeros(len(first), dtype=np.uint32)
    high = anchor - first
    low = high - counts + 1
    for j in range(4):
        a, b = j * step, min(free, (j + 1) * step - 1)
        has = np.flatnonzero((low <= b) & (high >= a))
        h = _window_hashes(lanes, anchor[has] - a, ANCHOR + a + free - b, 5 + j) % _U(255) + _U(1)
        out[has] |= (h << _U(8 * j)).astype(np.uint32)
    return out.view(np.int32)


_ROW = "name bigint, whole bigint, doc bigint, start bigint, windows int, lead int, sides int"


def _cut(documents: DataFrame, length: int) -> DataFrame:
    """The segments that are first in their block; `whole` is null for runs of marked windows."""

    def flush(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, start, counts, lead, name, whole, sides = (np.concatenate(column) for column in zip(*found))
        _, heads, back = np.unique(whole ^ name, return_index=True, return_inverse=True)
        head = np.zeros(len(doc), dtype=bool)
        head[heads] = True
        # rows that repeat a doc_id and its text: the same place is not an earlier one
        again = np.flatnonzero(~head & ((doc != doc[heads[back]]) | (start != start[heads[back]])))
        joins = np.zeros(len(again), dtype=bool)
        joins[1:] = (again[1:] == again[:-1] + 1) & (doc[again[1:]] == doc[again[:-1]])
        joins[1:] &= start[again[1:]] == start[again[:-1]] + counts[again[:-1]]
        opens = np.flatnonzero(~joins)
        heads, marks = np.flatnonzero(head), again[opens]
        picked = np.concatenate([heads, marks])
        sums = np.add.reduceat(counts[again], opens) if len(again) else np.zeros(0, np.int64)
        void = np.arange(len(picked)) >= len(heads)
        # marks travel with the rest, spread by their place
        spread = mix(start[picked].astype(np.uint64) + doc[picked].astype(np.uint64) * _FACTORS[0]).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.where(void, spread, name[picked])),
                pa.array(whole[picked], mask=void),
                pa.array(doc[picked]),
                pa.array(start[picked]),
                pa.array(np.concatenate([counts[heads], sums]).astype(np.int32)),
                pa.array(lead[picked].astype(np.int32)),
                pa.array(sides[picked]),
            ],
            schema=_SCHEMA,
        )

    def cut(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            if (keys[1:] < keys[:-1]).any():
                batch, keys = batch.take(pa.array(np.argsort(keys, kind="stable"))), np.sort(keys)
            raw, offsets = column_bytes(batch.column(1))
            found, held = [], 0
            for part, places, rows, shift in _parts(raw, offsets, length):
                first, counts, anchor, name, whole, sides = segments(part, places, length)
                if not len(first):
                    continue
                piece = np.searchsorted(places, first, "right") - 1
                found.append((keys[rows[piece]], first - places[piece] + shift[piece], counts, anchor - first, name, whole, sides))
                held += len(first)
                if held > FLUSH:
                    yield flush(found)
                    found, held = [], 0
            if found:
                yield flush(found)

    return documents.select("doc", "text").mapInArrow(cut, _ROW)


_SCHEMA = pa.schema(
    [("name", pa.int64()), ("whole", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("windows", pa.int32()), ("lead", pa.int32()), ("sides", pa.int32())]
)
_MET = "kind int, name bigint, doc bigint, start bigint, windows int, lead int"
_MARK, _FEW, _MANY = 0, 1, 2


def _meet(rows: DataFrame, length: int) -> DataFrame:
    """Reduces equal segments to the first; kind is a mark, or a segment of an anchor with few or many."""

    def meet(batches):
        # the segment that others are compared with, and the waiting segments of the last anchor
        head = np.zeros((0, 7), np.int64)
        waiting, crowded = np.zeros((0, 7), np.int64), None

        def out(kind, table):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(table), kind, np.int32))]
                + [pa.array(table[:, j].astype(np.int32 if j > 3 else np.int64)) for j in (0, 2, 3, 4, 5)],
                names=["kind", "name", "doc", "start", "windows", "lead"],
            )

        def alike(table):
            """Without segments, and quarters of segments, that can have no window in common with others."""
            step = -(-(length - ANCHOR + 1) // 4)
            low, high = np.full(len(table), length), np.full(len(table), -1)
            fresh = np.ones(len(table), dtype=np.int64)
            fresh[1:] = table[1:, 0] != table[:-1, 0]
            for j in range(4):
                byte = (table[:, 6] >> (8 * j)) & 255
                _, back, often = np.unique(np.cumsum(fresh) * 256 + byte, return_inverse=True, return_counts=True)
                same = (byte > 0) & (often[back] > 1)
                low[same] = np.minimum(low[same], j * step)
                high[same] = np.minimum(length - ANCHOR, (j + 1) * step - 1)
            keep = high >= 0
            table, low, high = table[keep].copy(), low[keep], high[keep]
            anchor = table[:, 3] + table[:, 5]
            end = np.minimum(table[:, 3] + table[:, 4], anchor - low + 1)
            table[:, 3] = np.maximum(table[:, 3], anchor - high)
            table[:, 4], table[:, 5] = end - table[:, 3], anchor - table[:, 3]
            return table

        for batch in batches:
            void = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            columns = [batch.column(0), batch.column(1).fill_null(0), *batch.columns[2:]]
            table = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in columns], axis=1)
            if void.any():
                yield out(_MARK, table[void])
                table = table[~void]
            if not len(table):
                continue
            new_batch = np.concatenate([head, table])
            known = len(head)
            fresh = np.ones(len(new_batch), dtype=bool)
            fresh[1:] = (new_batch[1:, :2] != new_batch[:-1, :2]).any(axis=1)
            leader = np.maximum.accumulate(np.where(fresh, np.arange(len(new_batch)), 0))
            same_place = (new_batch[:, 2:4] == new_batch[leader][:, 2:4]).all(axis=1)
            again = ~fresh & ~same_place
            if again.any():
                yield out(_MARK, new_batch[again])
            head = new_batch[leader[-1] : leader[-1] + 1]
            firsts = new_batch[known:][fresh[known:]]
            if crowded is not None and len(firsts):
                more = firsts[:, 0] == crowded
                if more.any():
                    yield out(_MANY, firsts[more])
                firsts = firsts[~more]
                crowded = crowded if not len(firsts) else None
            if not len(firsts):
                continue
            waiting = np.concatenate([waiting, firsts])
            edge = np.flatnonzero(waiting[1:, 0] != waiting[:-1, 0]) + 1
            bounds = np.concatenate([[0], edge, [len(waiting)]])
            sizes = np.diff(bounds)
            done = np.repeat(sizes, sizes)
            last = np.arange(len(waiting)) >= bounds[-2]
            few = (done > 1) & (done <= SEGMENTS) & ~last
            many = (done > SEGMENTS) & ~last
            if few.any():
                yield out(_FEW, alike(waiting[few]))
            if many.any():
                yield out(_MANY, waiting[many])
            waiting = waiting[last]
            if len(waiting) > SEGMENTS:
                yield out(_MANY, waiting)
                crowded, waiting = int(waiting[0, 0]), waiting[:0]
        if len(waiting) > 1:
            yield out(_FEW, alike(waiting))

    return (
        rows.repartition("name")
        .sortWithinPartitions("name", "whole", "doc", "start")
        .mapInArrow(meet, _MET)
    )


def _fetch(found: DataFrame, documents: DataFrame, length: int) -> DataFrame:
    """The bytes of the segments in `found`, read from their documents."""
    asked = found.groupBy("doc").agg(F.collect_list(F.struct("kind", "name", "start", "windows", "lead")).alias("asked"))
    keyed = documents.select("doc", "text")

    def slices(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            lists = batch.column(2)
            item = lists.flatten()
            rows = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy(zero_copy_only=False))
            start, windows = (item.field(j).to_numpy(zero_copy_only=False).astype(np.int64) for j in (2, 3))
            begin = offsets[rows] + start
            end = begin + windows + length - 1
            held = end <= offsets[rows + 1]
            data = raw.tobytes()
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            for a in range(0, len(rows), 20000):
                keep = np.flatnonzero(held[a : a + 20000]) + a
                if not len(keep):
                    continue
                at = pa.array(keep)
                yield pa.RecordBatch.from_arrays(
                    [
                        item.field(0).take(at),
                        item.field(1).take(at),
                        pa.array(doc[rows[keep]]),
                        item.field(2).take(at),
                        item.field(3).take(at),
                        item.field(4).take(at),
                        pa.array([data[i:j] for i, j in zip(begin[keep].tolist(), end[keep].tolist())], pa.binary()),
                    ],
                    names=["kind", "name", "doc", "start", "windows", "lead", "data"],
                )

    return keyed.join(asked, "doc").select("doc", "text", "asked").mapInArrow(slices, _MET + ", data binary")


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges of these starts and sizes, one range after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _stream(table: dict[str, np.ndarray], data: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For whole anchors, sorted by name and place: the segments and offsets of windows that are repeats."""
    name, lead, windows = table["name"], table["lead"], table["windows"]
    fresh = np.ones(len(name), dtype=bool)
    fresh[1:] = name[1:] != name[:-1]
    group = np.cumsum(fresh) - 1
    rank = np.arange(len(name)) - np.flatnonzero(fresh)[group]
    sizes = np.array([len(d) for d in data], dtype=np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])
    symbols = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.int32) + 2
    marked, places, half = [], [], 1
    while half <= rank.max(initial=0):
        later = (rank // half) % 2 == 1
        pair = group.astype(np.int64) * (int(rank.max()) + 1) + rank // (2 * half)
        met = np.isin(pair, pair[later])
        _, number = np.unique(pair, return_inverse=True)
        text = symbols.copy()
        text[base[:-1] + lead] = 300 + number
        early = np.flatnonzero(met & ~later)
        late = np.flatnonzero(later)
        # earlier segments, a separator after each, and the end
        joined = np.ones(int(sizes[early].sum()) + len(early) + 1, dtype=np.int32)
        to = np.cumsum(sizes[early] + 1) - sizes[early] - 1
        joined[_ranges(to, sizes[early])] = text[_ranges(base[early], sizes[early])]
        joined[-1] = 0
        index = RunLengthIndex(joined)
        for who, at, reached in index.matching_statistics(text, base[late], base[late] + sizes[late]):
            hit = reached >= length
            if hit.any():
                marked.append(late[who[hit]])
                places.append(at[hit] - base[late[who[hit]]])
        half *= 2
    if not marked:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(marked), np.concatenate(places)


_SPAN = "doc bigint, start bigint, windows int"


def _indexed(rows: DataFrame, length: int) -> DataFrame:
    """Marks from run-length indexes over anchors with few segments."""

    def search(batches):
        kept: list[pa.RecordBatch] = []
        held = 0

        def marks(table: pa.Table):
            columns = {k: table.column(k).to_numpy().astype(np.int64) for k in ("name", "doc", "start", "windows", "lead")}
            who, at = _stream(columns, table.column("data").to_pylist(), length)
            return pa.RecordBatch.from_arrays(
                [pa.array(columns["doc"][who]), pa.array(columns["start"][who] + at), pa.array(np.ones(len(who), np.int32))],
                names=["doc", "start", "windows"],
            )

        for batch in batches:
            kept.append(batch)
            held += batch.column(batch.schema.get_field_index("data")).nbytes
            if held < INDEX:
                continue
            table = pa.Table.from_batches(kept)
            names = table.column("name").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(names[1:] != names[:-1]) + 1])
            sizes = np.concatenate([[0], np.cumsum([len(d) for d in table.column("data").to_pylist()])])
            low = 0
            for k, edge in enumerate(edges):
                if sizes[edge] - sizes[low] >= INDEX:
                    yield marks(table.slice(low, edge - low))
                    low = edge
            if edges[-1] > low and held > 2 * INDEX:
                yield marks(table.slice(low, edges[-1] - low))
                low = edges[-1]
            kept = table.slice(low).combine_chunks().to_batches()
            held = int(sizes[-1] - sizes[low])
        if kept:
            yield marks(pa.Table.from_batches(kept))

    few = rows.where(F.col("kind") == _FEW).repartition("name").sortWithinPartitions("name", "doc", "start")
    return few.dropDuplicates(["name", "doc", "start"]).sortWithinPartitions("name", "doc", "start").mapInArrow(search, _SPAN)


def _quarters(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Marks and narrower segments (as from `_fetch`) of the anchors with very many segments."""

    def split(batches):
        free = length - ANCHOR
        step = -(-(free + 1) // 4)
        for batch in batches:
            raw, offsets = column_bytes(batch.column(batch.schema.get_field_index("data")).cast(pa.large_binary()).view(pa.large_string()))
            lanes, data = words_of(raw), raw.tobytes()
            name, doc, start, windows, lead = (batch.column(j).to_numpy().astype(np.int64) for j in range(1, 6))
            for j in range(4):
                a, b = j * step, min(free, (j + 1) * step - 1)
                first, last = np.maximum(0, lead - b), np.minimum(windows - 1, lead - a)
                has = np.flatnonzero(first <= last)
                if not len(has):
                    continue
                first, last = first[has], last[has]
                begin, end = offsets[has] + first, offsets[has] + last + length
                around = _window_hashes(lanes, offsets[has] + lead[has] - a, ANCHOR + a + free - b, 31 + j)
                whole = _window_hashes(lanes, begin, length, 41) + _window_hashes(lanes, end - length, length, 43) * _FACTORS[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(mix(around ^ mix(name[has].astype(np.uint64))).view(np.int64)),
                        pa.array(mix(whole + (last - first).astype(np.uint64)).view(np.int64)),
                        pa.array(doc[has]),
                        pa.array(start[has] + first),
                        pa.array((last - first + 1).astype(np.int32)),
                        pa.array((lead[has] - first).astype(np.int32)),
                        pa.array([data[x:y] for x, y in zip(begin.tolist(), end.tolist())], pa.binary()),
                    ],
                    names=["name", "whole", "doc", "start", "windows", "lead", "data"],
                )

    schema = "name bigint, whole bigint, doc bigint, start bigint, windows int, lead int, data binary"
    parts = store(rows.where(F.col("kind") == _MANY).mapInArrow(split, schema), "quarters")
    firsts = parts.groupBy("name", "whole").agg(F.min(F.struct("doc", "start", "windows", "lead", "data")).alias("first"), F.count("*").alias("n"))
    marks = (
        parts.drop("data").join(firsts.where("n > 1").select("name", "whole", "first.doc", "first.start").toDF("name", "whole", "d", "s"), ["name", "whole"])
        .where("doc <> d or start <> s")
        .select("doc", "start", "windows")
    )
    crowd = firsts.groupBy("name").agg(F.count("*").alias("crowd")).where("crowd > 1")
    narrow = firsts.join(crowd, "name").select(
        F.when(F.col("crowd") > SEGMENTS, F.lit(_MANY)).otherwise(F.lit(_FEW)).alias("kind"), "name", "first.*"
    )
    return marks, store(narrow, "narrow")


def _grouped(rows: DataFrame, length: int) -> DataFrame:
    """Marks by hashes of whole windows, for what is crowded in its quarter too."""

    def windows(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(3).cast(pa.large_binary()).view(pa.large_string()))
            lanes = words_of(raw)
            counts = batch.column(2).to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(batch)), counts)
            step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = offsets[row] + step
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_window_hashes(lanes, at, length, 11).view(np.int64)),
                    pa.array(_window_hashes(lanes, at, length, 23).view(np.int64)),
                    pa.array(batch.column(0).to_numpy()[row]),
                    pa.array(batch.column(1).to_numpy()[row] + step),
                ],
                names=["a", "b", "doc", "start"],
            )

    hashed = (
        rows.where(F.col("kind") == _MANY)
        .select("doc", "start", "windows", "data")
        .mapInArrow(windows, "a bigint, b bigint, doc bigint, start bigint")
    )
    firsts = hashed.groupBy("a", "b").agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return (
        hashed.join(firsts, ["a", "b"])
        .where("doc <> first.doc or start <> first.start")
        .select("doc", "start", F.lit(1).alias("windows"))
    )


def _keyed(documents: DataFrame) -> DataFrame:
    """`documents` with `doc`, in the order of doc_id: the same for equal rows with an id, else different."""
    odd = documents.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1 or doc_id is null")
    if odd.isEmpty():
        return documents.withColumn("doc", F.col("doc_id"))
    # the last key spreads equal rows; numbers grow from partition to partition and inside them
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest").asc_nulls_first()]
    numbered = store(
        documents.withColumn("digest", F.md5("text"))
        .withColumn("spread", F.rand(7))
        .repartitionByRange(*order, F.col("spread"))
        .sortWithinPartitions(*order)
        .drop("spread")
        .withColumn("number", F.monotonically_increasing_id()),
        "numbered",
    )
    again = numbered.groupBy("doc_id", "digest").agg(F.min("number").alias("least"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    # rows without an id or a text find no partner
    return store(
        numbered.join(again, ["doc_id", "digest"], "left").withColumn("doc", F.coalesce("least", "number")).drop("digest", "number", "least"),
        "keyed",
    )


def remove_repeats(documents: DataFrame, length: int = 100, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, n_bytes, spans array of start and end, kept binary), one row per input row.

    With `carry` the rows have those columns in a struct `row`, and `kept_text` instead of `kept`: the
    text that is left, without characters that were cut in two (null stays null).
    """
    if length < 2 * ANCHOR:
        raise ValueError(f"length must be at least {2 * ANCHOR}")
    spark = documents.sparkSession
    row = [F.struct(*(F.col(c) for c in carry)).alias("row")] if carry else []
    documents = _keyed(documents.select("doc_id", "text", *row))
    release(spark)
    met = store(_meet(_cut(documents, length), length), "met")
    release(spark)
    rows = store(_fetch(met.where(F.col("kind") > _MARK), documents, length), "segments")
    release(spark)
    again, narrow = _quarters(rows, length)
    marks = (
        met.where(F.col("kind") == _MARK)
        .select("doc", "start", "windows")
        .unionByName(_indexed(rows, length))
        .unionByName(again)
        .unionByName(_indexed(narrow, length))
        .unionByName(_grouped(narrow, length))
    )
    marked = store(marks.groupBy("doc").agg(F.collect_list(F.struct("start", "windows")).alias("marks")), "marks")
    release(spark)

    def cut(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            lists, spans, kept = batch.column(2), [], []
            for i in range(len(batch)):
                text = raw[offsets[i] : offsets[i + 1]]
                found = lists[i].values if lists[i].is_valid else None
                if found is None or not len(found):
                    spans.append([])
                    kept.append(text.tobytes())
                    continue
                start = found.field(0).to_numpy()
                end = start + found.field(1).to_numpy() + (length - 1)
                inside = end <= len(text)
                depth = np.zeros(len(text) + 1, dtype=np.int64)
                np.add.at(depth, start[inside], 1)
                np.add.at(depth, end[inside], -1)
                gone = np.cumsum(depth[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                left = np.split(text, edges)[::2]
                kept.append(b"".join(p.tobytes().decode(errors="ignore").encode() for p in left) if carry else text[~gone].tobytes())
            columns = {
                "doc_id": batch.column(0),
                "n_bytes": pa.array(np.diff(offsets)),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            }
            if carry:
                columns["kept_text"] = pa.array(
                    [None if null else k.decode(errors="ignore") for null, k in zip(batch.column(1).is_null().to_pylist(), kept)],
                    pa.string(),
                )
                columns["row"] = batch.column(3)
            else:
                columns["kept"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    joined = documents.join(marked, "doc", "left").select("doc_id", "text", "marks", *(["row"] if carry else []))
    schema = "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>"
    if carry:
        schema += ", kept_text string, row " + joined.schema["row"].dataType.simpleString()
    else:
        schema += ", kept binary"
    return joined.mapInArrow(cut, schema)
