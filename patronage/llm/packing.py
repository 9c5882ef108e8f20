"""Packing of documents into sequences of fixed length with a controlled mixture of sources.

Every source is a queue of its documents' tokens, in ascending doc_id. Rounds of deficit round robin
take from each queue its share of a round: its credit grows by `length * weight` per round, it sends
the whole tokens of its credit and carries the rest, a fraction of a token, into the next round. When
a queue runs dry its share goes to the others by their weights (a new phase). The rounds follow each
other without gaps and are cut into sequences of `length` tokens, so every sequence holds one round's
mixture, and only the last sequence of all can be short.

Credits are sums, so the number of tokens that a queue has sent before a round is a closed formula of
the round, and a document's place follows from its place in its queue: no state passes from sequence
to sequence or from task to task, and every task lays out its own documents. Places in the queues come
from sums over chunks of documents, so a source with a third of all rows is no single task. Weights
are rounded to 1/65536; without them each source weighs its own tokens, so the queues end together.

Null and empty texts consist of the end id. A null source is a source. Rows with a null doc_id stand
first in their queue; rows that repeat a doc_id are separate documents. Sources beyond `QUEUES` share
queues by hash.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from patronage.llm.encoding import Vocabulary, encoded_blocks
from patronage.llm.text import column_bytes, release, store

#: queues, and doc_ids of a chunk whose tokens are summed before the sums are
QUEUES, CHUNK = 4096, 2048
#: parts into which a round is shared out
SHARES = 1 << 16


def encode_documents(documents: DataFrame, vocabulary: Vocabulary, end_id: int) -> DataFrame:
    """doc_id, source, n_tokens and the ids (end id last, little-endian; two bytes each where they fit)."""

    def encode(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            for low, high, ids, first in encoded_blocks(raw, offsets, vocabulary):
                rows = []
                for a, b in zip(first[:-1], first[1:]):
                    rows.append(np.append(ids[a:b], np.uint32(end_id)))
                sizes = [len(r) for r in rows]
                kind = "<u2" if max((int(r.max()) for r in rows), default=0) < 1 << 16 else "<u4"
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(2).slice(low, high - low),
                        pa.array(sizes, pa.int64()),
                        pa.array([r.astype(kind).tobytes() for r in rows], pa.binary()),
                    ],
                    names=["doc_id", "source", "n_tokens", "ids"],
                )

    return documents.select("doc_id", "text", "source").mapInArrow(
        encode, "doc_id bigint, source string, n_tokens bigint, ids binary"
    )


@dataclass
class Phase:
    """Rounds during which the same queues are served."""

    before: int  # tokens sent before the phase, by all
    queues: list[int]
    shares: list[int]
    sent: list[int]  # by each of the queues, before the phase
    rounds: int


class Schedule:
    """Where the tokens of each queue go in the stream of all sequences."""

    def __init__(self, totals: list[int], weights: list[int], length: int) -> None:
        self.length, self.totals, self.phases = length, totals, []
        self.shares = [max(1, w * SHARES // max(1, sum(weights))) for w in weights]
        sent = [0] * len(totals)
        left = [q for q in range(len(totals)) if totals[q] > 0]
        while left:
            whole = sum(self.shares[q] for q in left)
            # rounds until the first queue runs dry; in its last round it may send less
            rounds = min(-(-(totals[q] - sent[q]) * whole // (length * self.shares[q])) for q in left)
            self.phases.append(Phase(sum(sent), left, [self.shares[q] for q in left], [sent[q] for q in left], rounds))
            for q in left:
                sent[q] = min(totals[q], sent[q] + length * self.shares[q] * rounds // whole)
            left = [q for q in left if sent[q] < totals[q]]

    def lay_out(self, queue: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces of documents given by queue, place in the queue and size: document number, offset in
        the document, length, place in the stream; in order of the documents."""
        found = []
        for phase in self.phases:
            whole = sum(phase.shares)

            def credit(k: int, rounds: np.ndarray, phase=phase, whole=whole) -> np.ndarray:
                """Tokens sent by queue k of the phase after so many of its rounds."""
                most = self.totals[phase.queues[k]] - phase.sent[k]
                return np.minimum(rounds * (self.length * phase.shares[k]) // whole, most)

            for k, q in enumerate(phase.queues):
                first = phase.sent[k]
                end = first + int(credit(k, np.array([phase.rounds]))[0])
                if end == first:  # a small share sends nothing in a short phase
                    continue
                mine = np.flatnonzero((queue == q) & (start < end) & (start + size > first))
                if not len(mine):
                    continue
                a = np.maximum(start[mine], first) - first
                b = np.minimum(start[mine] + size[mine], end) - first
                share = self.length * phase.shares[k]
                turn, last = ((a + 1) * whole - 1) // share, (b * whole - 1) // share
                many = last - turn + 1
                doc = np.repeat(np.arange(len(mine)), many)
                rounds = np.repeat(turn - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
                own = credit(k, rounds)
                low, high = np.maximum(a[doc], own), np.minimum(b[doc], credit(k, rounds + 1))
                place = phase.before + low - own
                for j in range(len(phase.queues)):
                    place += credit(j, rounds + 1) if j < k else credit(j, rounds)
                held = high > low
                found.append((mine[doc][held], (low + first - start[mine][doc])[held], (high - low)[held], place[held]))
        if not found:
            return (np.zeros(0, np.int64),) * 4
        doc, offset, count, place = (np.concatenate(c) for c in zip(*found))
        # a round's part may reach over the end of a sequence
        room = self.length - place % self.length
        over = count > room
        doc, offset = np.append(doc, doc[over]), np.append(offset, (offset + room)[over])
        place = np.append(place, (place + room)[over])
        count = np.append(np.minimum(count, room), (count - room)[over])
        order = np.lexsort((offset, doc))
        return doc[order], offset[order], count[order], place[order]


def pack(
    documents: DataFrame,
    vocabulary: Vocabulary,
    length: int = 2048,
    end_id: int = 1,
    weights: dict[str | None, int] | None = None,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source: one row per piece.

    `weights` are the target proportions of the sources (0 counts as the least share); a source without one weighs its tokens.
    """
    spark = documents.sparkSession
    encoded = store(encode_documents(documents, vocabulary, end_id), "encoded")
    release(spark)
    # a queue's name is never null, so that windows and joins share one partitioning
    queue = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    sums = encoded.groupBy(queue.alias("queue")).agg(F.sum("n_tokens").alias("n")).limit(QUEUES + 1).collect()
    if len(sums) > QUEUES:
        queue = F.pmod(F.xxhash64("source"), F.lit(QUEUES)).cast("string")
        sums = encoded.groupBy(queue.alias("queue")).agg(F.sum("n_tokens").alias("n")).collect()
    encoded = encoded.withColumn("queue", queue)
    names = sorted((r["queue"], r["n"]) for r in sums)
    numbers = {name: k for k, (name, _) in enumerate(names)}
    wanted = {"" if source is None else f"={source}": weight for source, weight in (weights or {}).items()}
    schedule = Schedule([n for _, n in names], [wanted.get(name, n) for name, n in names], length)
    # places in the queues: sums over chunks, then inside chunks
    chunked = encoded.withColumn("chunk", F.coalesce(F.floor(F.col("doc_id") / CHUNK), F.lit(-(1 << 62))))
    before = Window.partitionBy("queue").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        chunked.groupBy("queue", "chunk").agg(F.sum("n_tokens").alias("n"))
        .select("queue", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    )
    inside = Window.partitionBy("queue", "chunk").orderBy("doc_id", "mark").rowsBetween(Window.unboundedPreceding, -1)
    placed = chunked.withColumn("mark", F.xxhash64("ids")).withColumn("at", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    joined = placed.join(chunks, ["queue", "chunk"])
    shared = spark.sparkContext.broadcast((schedule, numbers))

    def lay_out(batches):
        plan, number = shared.value
        for batch in batches:
            queue = np.array([number[q] for q in batch.column(4).to_pylist()], dtype=np.int64)
            start = batch.column(5).to_numpy().astype(np.int64)
            size = batch.column(2).to_numpy().astype(np.int64)
            doc, offset, count, place = plan.lay_out(queue, start, size)
            crc, views = np.empty(len(doc), dtype=np.int64), batch.column(3)
            held, data = -1, memoryview(b"")
            for n, (d, a, c) in enumerate(zip(doc.tolist(), offset.tolist(), count.tolist())):
                if d != held:
                    held, blob = d, views[d].as_buffer()
                    kind = "<u2" if len(blob) == 2 * size[d] else "<u4"
                    data = memoryview(np.frombuffer(blob, dtype=kind).astype("<u4")).cast("B")
                crc[n] = zlib.crc32(data[4 * a : 4 * (a + c)])
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    pa.array(offset),
                    pa.array(count),
                    pa.array(crc),
                    pa.array(size[doc]),
                    pa.array(place // plan.length),
                    pa.array(place % plan.length),
                    batch.column(1).take(at),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"],
            )

    return joined.select(
        "doc_id", "source", "n_tokens", "ids", "queue", (F.col("at") + F.col("ahead")).alias("start")
    ).mapInArrow(
        lay_out,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, source string",
    )
