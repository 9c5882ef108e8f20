"""Toxicity of whole documents by compression with two zstandard dictionaries.

Two dictionaries of one size are trained. Both end in the same prose, which zstandard's trainer picks from
ordinary documents; the toxic one begins with the passages that set toxic documents apart, the ordinary one
with bytes that no text has. A window of `WINDOW` words is compressed with both: the bytes that the
toxic dictionary saves are the window's evidence. The prose lies at the same distance in both, so windows
without such passages save nothing.

Passages: a gram is `GRAM` bytes of a word with a space at each end. It is telling when `SHARE` of the toxic
documents or more hold it, at least `ODDS` times as often as ordinary ones, with a G statistic of `TELLING` or more.
Overlapping telling grams of a word join to a passage; the most frequent passages fill the dictionary.

The largest savings, their sum and the number of windows are turned into a score by a logistic model with
ordinary documents weighted `CLEAN` times the toxic ones together; its coefficients are fitted on documents that the passages were not taken from.

Bounds of what is fitted: about `TOXIC` toxic and `ORDINARY` ordinary labelled documents (by a hash of their id,
at most twice as many; one text for an id, the least), `PASSAGE_BYTES` of passages, `PROSE_BYTES` of prose from
`PIECES` pieces a document. Grams and passages are counted by Spark; counts, pieces and five numbers a sampled
document reach the driver, never texts. Scoring reads every window of every text.

A-Z count as small letters, all white space as a space. A word of more than `LONGEST` bytes is cut, so that
texts without white space have windows too. Null and empty texts, and texts without words, have no window and
get the score of no evidence. A null label, or one without a document, is not used; of several for one
document the largest. Null ids and repeated rows are scored like others. Without labels, or with only one kind
of them, the score is the smoothed share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from patronage.llm.text import IS_SPACE, LOWER, blocks, column_bytes, hashed_sample, store

GRAM, SHARE, ODDS, TELLING = 5, 0.015, 20.0, 24.0
WINDOW, LONGEST = 12, 128
PASSAGE_BYTES, PROSE_BYTES = 4096, 32768
TOXIC, ORDINARY = 2500, 7500
PIECES, PIECE = 4, 192
CLEAN = 1.0
SPACE = 32


def plain(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Small letters, white space as a space, and a space at both ends of every row."""
    folded = np.where(IS_SPACE[raw], np.uint8(SPACE), LOWER[raw])
    return np.insert(folded, np.repeat(offsets, 2)[1:-1], SPACE), offsets + 2 * np.arange(len(offsets))


def windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every window (with the spaces around it), and the first window of each row."""
    solid = raw != SPACE
    begins = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
    ends = np.flatnonzero(solid[:-1] & ~solid[1:]) + 1
    # long words become several
    many = np.maximum(1, -(-(ends - begins) // LONGEST))
    begins = np.repeat(begins, many) + LONGEST * (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
    first = np.searchsorted(begins, offsets)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    opens = np.flatnonzero((np.arange(len(begins)) - first[row]) % WINDOW == 0)
    start = begins[opens]
    start = start - (raw[start - 1] == SPACE) if len(start) else start
    owner = row[opens]
    last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
    end = np.where(last, offsets[owner + 1], np.append(begins[opens][1:], 0)) if len(owner) else start
    return np.stack([start, end - start], axis=1), np.searchsorted(owner, np.arange(len(offsets)))


def grams(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the grams of a plain buffer, and the grams as numbers: no space inside, perhaps at the ends."""
    n = len(raw) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = np.ones(n, dtype=bool)
    value = np.zeros(n, dtype=np.int64)
    for k in range(GRAM):
        if 0 < k < GRAM - 1:
            inner &= raw[k : k + n] != SPACE
        value = value << 8 | raw[k : k + n]
    at = np.flatnonzero(inner)
    return at, value[at]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
        window_log=17, hash_log=16, chain_log=16, search_log=4, min_match=4, strategy=zstandard.STRATEGY_BTLAZY2,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


@dataclass
class Dictionaries:
    """The two dictionaries, and compression of windows with both."""

    passages: bytes
    prose: bytes

    def __getstate__(self):
        return {"passages": self.passages, "prose": self.prose}

    @cached_property
    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        return _compressor(bytes(len(self.passages)) + self.prose), _compressor(self.passages + self.prose)

    def savings(self, raw: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one, per window."""
        if not len(spans) or not self.passages:
            return np.zeros(len(spans))
        parts = zstandard.BufferWithSegments(raw.tobytes(), spans.astype(np.uint64).tobytes())
        sizes = []
        for compressor in self.compressors:
            packed = compressor.multi_compress_to_buffer(parts, threads=0)
            sizes.append(np.fromiter((len(packed[i]) for i in range(len(packed))), np.int64, len(packed)))
        return (sizes[0] - sizes[1]).astype(np.float64)

    def evidence(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The measurements of every row: two largest savings, their sums beyond 1 and 3, windows."""
        raw, offsets = plain(raw, offsets)
        spans, first = windows(raw, offsets)
        saved = self.savings(raw, spans)
        rows, n = len(offsets) - 1, np.diff(first)
        out = np.zeros((rows, 5))
        full = np.flatnonzero(n)
        if len(full):
            owner = np.repeat(np.arange(rows), n)
            order = np.lexsort((-saved, owner))
            out[full, 0] = saved[order[first[:-1][full]]]
            two = np.flatnonzero(n > 1)
            out[two, 1] = saved[order[first[:-1][two] + 1]]
            out[:, 2] = np.bincount(owner, np.clip(saved - 1, 0, None), rows)
            out[:, 3] = np.bincount(owner, np.clip(saved - 3, 0, None), rows)
        out[:, 0:2] = np.clip(out[:, 0:2], 0, None)
        out[:, 2:] = np.log1p(np.stack([out[:, 2], out[:, 3], n], axis=1))
        return out


@dataclass
class ToxicityModel:
    """Dictionaries with the coefficients of the measurements; without dictionaries a share."""

    dictionaries: Dictionaries | None
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.dictionaries is None:
            return np.full(len(offsets) - 1, self.weights[0])
        x = (self.dictionaries.evidence(raw, offsets) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    weight = weight / weight.sum()
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, gradient)
        w = w - step * min(1, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


def _sample(documents: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, toxic, fold (0: calibrates, others: passages) and text of the labelled documents to learn from."""
    known = (
        labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null").where(~held_out)
        .groupBy("doc_id").agg((F.max("toxic") == 1).cast("int").alias("toxic"))
    )
    ids = hashed_sample(known.where("toxic = 1"), TOXIC, "doc_id").unionByName(hashed_sample(known.where("toxic = 0"), ORDINARY, "doc_id"))
    rows = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id")  # at most twice as many ids
    one = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return one.select("doc_id", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)).cast("int").alias("fold"), "text")


def _per_row(batches: Iterator[pa.RecordBatch]):
    """Label and plain bytes of every row of (toxic, text)."""
    for batch in batches:
        raw, offsets = column_bytes(batch.column(1))
        label = batch.column(0).to_numpy(zero_copy_only=False)
        for low, _, part, places in blocks(raw, offsets):
            part, places = plain(part, places)
            for i in range(len(places) - 1):
                yield label[low + i], part[places[i] : places[i + 1]]


def _telling_grams(sample: DataFrame, toxic: int, ordinary: int) -> DataFrame:
    """Grams that set toxic documents apart."""

    def count(batches):
        for label, raw in _per_row(batches):
            found = np.unique(grams(raw)[1])
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), label, np.int32))], names=["gram", "toxic"])

    a, b = F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b")
    counted = sample.select("toxic", "text").mapInArrow(count, "gram bigint, toxic int").groupBy("gram").agg(a, b)
    share = toxic / (toxic + ordinary)
    both = F.col("a") + F.col("b")
    part = lambda x, s: F.when(x > 0, x * F.log(x / (both * s))).otherwise(0.0)
    g = 2 * (part(F.col("a"), share) + part(F.col("b"), 1 - share))
    odds = ((F.col("a") + 0.5) / (toxic + 1)) / ((F.col("b") + 0.5) / (ordinary + 1))
    # both labels of a sample of bounded size: what is left is small; the strongest fill a dictionary many times over
    return counted.where((g >= TELLING) & (odds >= ODDS) & (F.col("a") >= SHARE * toxic)).orderBy(g.desc(), "gram").limit(8 * PASSAGE_BYTES).select("gram")


def _passages(sample: DataFrame, telling: np.ndarray) -> bytes:
    """The most frequent passages of telling grams, the best at the end."""
    if not len(telling):
        return b""
    known = np.sort(telling)

    def find(batches):
        for label, raw in _per_row(batches):
            at, value = grams(raw)
            hit = at[known[np.minimum(np.searchsorted(known, value), len(known) - 1)] == value]
            if label != 1 or not len(hit):
                continue
            # grams that touch and lie in one word are one passage; a space at the end of a gram ends it
            apart = np.flatnonzero((np.diff(hit) > GRAM) | (raw[hit[1:]] == SPACE)) + 1
            first, last = hit[np.append(0, apart)], hit[np.append(apart - 1, len(hit) - 1)] + GRAM
            view = raw.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([view[s:e] for s, e in zip(first.tolist(), last.tolist())], pa.binary())], names=["passage"])

    counted = sample.where("toxic = 1").select("toxic", "text").mapInArrow(find, "passage binary").groupBy("passage").count()
    content = b""
    for r in counted.orderBy(F.desc("count"), "passage").limit(PASSAGE_BYTES).collect():
        passage = bytes(r["passage"])
        if passage not in content and len(content) + len(passage) <= PASSAGE_BYTES:
            content = passage + content
    return content


def _prose(sample: DataFrame) -> bytes:
    """What zstandard's trainer keeps of pieces of ordinary documents."""

    def pieces(batches):
        for _, raw in _per_row(batches):
            starts = np.unique(np.linspace(0, max(0, len(raw) - PIECE), PIECES).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([raw[s : s + PIECE].tobytes() for s in starts.tolist()], pa.binary())], names=["piece"])

    rows = sample.where("toxic = 0").select("toxic", "text").mapInArrow(pieces, "piece binary").collect()
    found = sorted(bytes(r["piece"]) for r in rows)
    try:
        return zstandard.train_dictionary(PROSE_BYTES, found).as_bytes()
    except zstandard.ZstdError:  # too little text to train from: all of it fits
        return b"".join(dict.fromkeys(found))[:PROSE_BYTES]


def train(documents: DataFrame, labels: DataFrame, held_out: Column) -> ToxicityModel:
    sample = store(_sample(documents, labels, held_out), "labelled")
    counts = {(r["toxic"], r["fold"] > 0): r["count"] for r in sample.groupBy("toxic", "fold").count().groupBy("toxic", (F.col("fold") > 0).alias("fold")).agg(F.sum("count").alias("count")).collect()}
    toxic, ordinary = (sum(n for (label, _), n in counts.items() if label == y) for y in (1, 0))
    none = np.zeros(5)
    if not toxic or not ordinary:
        return ToxicityModel(None, none, none + 1, np.array([(toxic + 1) / (toxic + ordinary + 2)]))
    learn = sample.where("fold > 0")
    telling = _telling_grams(learn, counts.get((1, True), 0), counts.get((0, True), 0)).collect()
    dictionaries = Dictionaries(_passages(learn, np.array([r["gram"] for r in telling], dtype=np.int64)), _prose(learn))

    def measure(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(2))
            for low, high, part, places in blocks(raw, offsets):
                x = dictionaries.evidence(part, places)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low), pa.array(list(x), pa.list_(pa.float64()))],
                    names=["doc_id", "toxic", "x"],
                )

    calibrate = sample.where("fold = 0") if counts.get((1, False)) and counts.get((0, False)) else sample
    rows = calibrate.select("doc_id", "toxic", "text").mapInArrow(measure, "doc_id bigint, toxic int, x array<double>").collect()
    rows.sort(key=lambda r: r["doc_id"])
    x, y = np.array([r["x"] for r in rows]), np.array([float(r["toxic"]) for r in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    weight = np.where(y == 1, 1 / y.sum(), CLEAN / (len(y) - y.sum()))
    return ToxicityModel(dictionaries, mean, scale, _logistic((x - mean) / scale, y, weight))


def toxicity_scores(documents: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per input row; `held_out` is over a column doc_id."""
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels, held_out))

    def score(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            scores = [model.value.score(part, places) for _, _, part, places in blocks(raw, offsets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.concatenate([np.zeros(0), *scores]))], names=["doc_id", "held_out", "score"]
            )

    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double"
    scored = documents.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(score, schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
