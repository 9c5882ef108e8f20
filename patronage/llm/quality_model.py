"""Quality of whole documents by attention-based multiple-instance learning.

A document is a bag of passages of 32 to 96 words; every word lies in one. Each passage is encoded by
measurements of its text (sizes, kinds of characters, repetition inside it and with the rest of its
document) and a hidden layer. Gated attention gives every passage a weight, the weighted mean of the
passages represents the document, and a logistic output scores it. Only documents have labels, so the
weights are learned from these alone.

The model is fitted on the driver from about `SAMPLE` labelled documents (taken by a hash of their id,
at most twice as many), each with at most `SAMPLE_PASSAGES` passages spread over it; scoring reads every passage of every
text. A label that is null, or has no document, is not used; of several for one document the least, and of
several texts of a labelled id the least.

Null and empty texts are one passage without words. Null ids and repeated rows are scored like others.
Without labels, or with only one kind of them, the score is the smoothed share of label 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from patronage.llm.text import LOWER, blocks, column_bytes, hash_spans, hashed_sample, mix, word_spans

WORDS, WIDEST = 64, 96
SAMPLE, SAMPLE_PASSAGES = 2500, 32
HIDDEN, GATE, STEPS, RATE, DECAY = 16, 8, 250, 0.03, 1e-4

_KINDS = {
    "symbol": b"#*$%&|<>@^~_=+\\/{}[]",
    "bar": b"|",
    "mark": b".,;:!?'\"()-",
    "loud": b"!?",
    "digit": b"0123456789",
    "capital": bytes(range(65, 91)),
    "line": b"\n",
    "high": bytes(range(128, 256)),
}
NAMES = [*_KINDS, "word_length", "length_spread", "distinct", "same_as_before", "again_in_text", "words", "text_words", "long_words"]


def passages(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Measurements of all passages of a block of texts, and the first passage of each text."""
    starts, ends, first = word_spans(raw, offsets)
    n_words = np.diff(first)
    n_parts = np.maximum(1, (n_words + WORDS // 2) // WORDS)
    base = np.concatenate([[0], np.cumsum(n_parts)])
    part_row = np.repeat(np.arange(len(n_words)), n_parts)
    k = np.arange(base[-1]) - base[part_row]
    low = first[part_row] + k * n_words[part_row] // n_parts[part_row]
    high = first[part_row] + (k + 1) * n_words[part_row] // n_parts[part_row]
    size = high - low
    out = np.zeros((len(size), len(NAMES)), dtype=np.float32)
    full = np.flatnonzero(size > 0)
    if not len(full):
        return out, base
    low, high, size = low[full], high[full], size[full]
    begin, end = starts[low], ends[high - 1]
    lengths = (ends - starts).astype(np.float64)
    chars = np.add.reduceat(lengths, low)
    columns: list[np.ndarray] = []
    for name, kind in _KINDS.items():
        table = np.zeros(256, dtype=np.int32)
        table[list(kind)] = 1
        seen = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int64)])
        columns.append((seen[end] - seen[begin]) / (chars if name in ("digit", "capital", "high") else size))
    words = hash_spans(LOWER[raw], starts, ends)
    mean = chars / size
    spread = np.sqrt(np.maximum(0, np.add.reduceat(lengths * lengths, low) / size - mean * mean))
    # distinct words of a passage: its row sorted, filled up with values that differ
    grid = np.arange(WIDEST + 1, dtype=np.uint64)[None, :].repeat(len(size), axis=0)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    passage = np.repeat(np.arange(len(size)), size)
    grid[passage, at] = words
    grid.sort(axis=1)
    distinct = (grid[:, 1:] != grid[:, :-1]).sum(axis=1) + 1 - (WIDEST + 1 - size)
    before = np.zeros(len(words))
    before[1:] = words[1:] == words[:-1]
    before[first[:-1][n_words > 0]] = 0
    again = np.zeros(len(words))
    if len(words) > 2:
        row = np.repeat(np.arange(len(n_words)), n_words)
        grams = mix(mix(words[:-2] + row[:-2].astype(np.uint64)) * np.uint64(3) + mix(words[1:-1]) * np.uint64(5) + words[2:])
        inside = row[:-2] == row[2:]
        _, back, often = np.unique(grams[inside], return_inverse=True, return_counts=True)
        again[np.flatnonzero(inside)] = often[back] > 1
    columns += [
        mean / 10, spread / 10, distinct / size, np.add.reduceat(before, low) / size, np.add.reduceat(again, low) / size,
        np.log1p(size) / 5, np.log1p(n_words[part_row[full]]) / 10, np.add.reduceat((lengths > 20).astype(np.float64), low) / size,
    ]
    out[full] = np.stack(columns, axis=1)
    return out, base


@dataclass
class BagModel:
    """Hidden layer, gated attention over the passages of a bag, logistic output."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def _forward(self, x: np.ndarray, first: np.ndarray):
        p, starts, sizes = self.p, first[:-1], np.diff(first)
        h = np.tanh(x @ p["w"] + p["b"])
        v, u = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        raw = (v * u) @ p["a"]
        e = np.exp(raw - np.repeat(np.maximum.reduceat(raw, starts), sizes))
        weight = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(weight[:, None] * h, starts, axis=0)
        return h, v, u, weight, z, 1 / (1 + np.exp(-(z @ p["c"] + p["d"])))

    def normal(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self._forward(self.normal(x), first)[-1]

    def attention(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self._forward(self.normal(x), first)[3]

    def gradient(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss with decay, and its gradient; x is normalised."""
        p, starts, sizes = self.p, first[:-1], np.diff(first)
        h, v, u, weight, z, score = self._forward(x, first)
        eps = 1e-12
        loss = -np.mean(y * np.log(score + eps) + (1 - y) * np.log(1 - score + eps)) + DECAY * sum((q**2).sum() for q in p.values()) / 2
        out = (score - y) / len(y)
        g = {"c": z.T @ out, "d": out.sum(keepdims=True)}
        dz = np.repeat(out[:, None] * p["c"], sizes, axis=0)
        dw = (dz * h).sum(axis=1)
        draw = weight * (dw - np.repeat(np.add.reduceat(weight * dw, starts), sizes))
        g["a"] = (v * u).T @ draw
        dvu = draw[:, None] * p["a"]
        dv, du = dvu * u * (1 - v * v), dvu * v * u * (1 - u)
        g["v"], g["u"] = h.T @ dv, h.T @ du
        dh = (weight[:, None] * dz + dv @ p["v"].T + du @ p["u"].T) * (1 - h * h)
        g["w"], g["b"] = x.T @ dh, dh.sum(axis=0)
        return loss, {k: g[k] + DECAY * p[k] for k in p}


def _fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, seed: int = 7) -> BagModel:
    pick, f = np.random.default_rng(seed), x.shape[1]
    model = BagModel(
        x.mean(axis=0),
        x.std(axis=0) + 1e-3,
        {
            "w": pick.normal(0, f**-0.5, (f, HIDDEN)), "b": np.zeros(HIDDEN),
            "v": pick.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "u": pick.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "a": pick.normal(0, GATE**-0.5, GATE), "c": pick.normal(0, HIDDEN**-0.5, HIDDEN), "d": np.zeros(1),
        },
    )
    x = model.normal(x)
    moment = {k: np.zeros_like(q) for k, q in model.p.items()}
    square = {k: np.zeros_like(q) for k, q in model.p.items()}
    for step in range(1, STEPS + 1):
        _, gradient = model.gradient(x, first, y)
        for k, g in gradient.items():
            moment[k] = 0.9 * moment[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            model.p[k] = model.p[k] - RATE * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return model


def train(documents: DataFrame, labels: DataFrame, held_out: Column) -> BagModel | float:
    """The model, or the share of label 1 where there are not two kinds of labels."""
    known = (
        labels.select("doc_id", "quality").where("doc_id is not null and quality is not null").where(~held_out)
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    ids = hashed_sample(known, SAMPLE, "doc_id")

    def encode(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            for low, high, part, places in blocks(raw, offsets):
                x, base = passages(part, places)
                bags = []
                for a, b in zip(base[:-1], base[1:]):
                    bags.append(x[np.unique(np.linspace(a, b - 1, min(int(b - a), SAMPLE_PASSAGES)).astype(np.int64))].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(bags, pa.binary()), batch.column(2).slice(low, high - low)],
                    names=["doc_id", "bag", "quality"],
                )

    sample = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most twice SAMPLE rows of two numbers
    # one row an id, so that the bound on ids is one on rows
    sample = sample.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = sample.select("doc_id", "text", "quality").mapInArrow(encode, "doc_id bigint, bag binary, quality int").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["bag"])))
    y = np.array([float(r["quality"] == 1) for r in rows])
    if not len(y) or y.min() == y.max():
        return float((y.sum() + 1) / (len(y) + 2))
    bags = [np.frombuffer(r["bag"], dtype=np.float32).reshape(-1, len(NAMES)) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    return _fit(np.concatenate(bags).astype(np.float64), first, y)


def quality_scores(documents: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per input row; `held_out` is over a column doc_id."""
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels, held_out))

    def score(batches):
        known = model.value
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            scores = [np.zeros(0)]
            for low, high, part, places in blocks(raw, offsets):
                if isinstance(known, float):
                    scores.append(np.full(high - low, known))
                else:
                    scores.append(known.score(*passages(part, places)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.concatenate(scores))], names=["doc_id", "held_out", "score"])

    scored = documents.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(score, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
