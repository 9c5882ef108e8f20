"""Token ids in files of compressed planes.

The documents, in ascending doc_id, form one stream of ids, each document closed by the end id. The
stream is dealt over shards in order (a range partitioning), and every shard is cut into blocks of a
fixed number of ids. A block's 32-bit ids are transposed: plane k holds the k-th byte (or bit) of
every id, so the planes of the high bytes are nearly constant, and every plane is compressed with
zstandard on its own.

A file set is a folder with two tables: `blocks` holds one row per block (shard, number, place of its
first id in the shard, planes, and the documents that lie in it), `index` the blocks' places in the
whole stream and the sizes of their planes, without the planes. Blocks are read and checked alone, so
any range of ids needs only its own blocks. Both are Parquet, written by Spark's committers: a lost
executor's shard is written again, and any store that Spark reaches will do.

Null texts are empty, null doc_ids come first, rows that repeat a doc_id follow each other by text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from patronage.llm.encoding import Vocabulary, encoded_blocks
from patronage.llm.text import column_bytes

BLOCK_IDS, LEVEL = 1 << 16, 3
_BLOCK = (
    "shard int, block int, first bigint, n_ids int, planes array<binary>, plane_bytes array<int>, "
    "doc_ids array<bigint>, doc_starts array<bigint>, doc_sizes array<bigint>"
)


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Compressed planes of a block, lowest first; a plane of zeros is empty."""
    rows = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    planes = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1) if bits else rows.T
    pack = zstandard.ZstdCompressor(level=LEVEL)
    return [pack.compress(np.ascontiguousarray(p).tobytes()) if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], count: int) -> np.ndarray:
    """The ids of a block; 4 planes are bytes, 32 are bits."""
    unpack = zstandard.ZstdDecompressor()
    bits = len(planes) == 32
    width = -(-count // 8) if bits else count
    table = np.zeros((len(planes), width), dtype=np.uint8)
    for k, plane in enumerate(planes):
        if plane:
            table[k] = np.frombuffer(unpack.decompress(plane, max_output_size=width), dtype=np.uint8)
    if bits:
        table = np.packbits(np.unpackbits(table, axis=1)[:, :count].T, axis=1, bitorder="little").T
    return np.ascontiguousarray(table.T).view("<u4").reshape(-1)


class _Blocks:
    """Cuts a shard's stream into blocks."""

    def __init__(self, shard: int, bits: bool) -> None:
        self.shard, self.bits, self.number, self.first = shard, bits, 0, 0
        self.parts: list[np.ndarray] = []
        self.held = 0
        self.documents: list[tuple[int | None, int, int]] = []  # id, start in the shard, size

    def add(self, doc_id: int | None, ids: np.ndarray):
        self.documents.append((doc_id, self.first + self.held, len(ids)))
        self.parts.append(ids)
        self.held += len(ids)
        while self.held >= BLOCK_IDS:
            yield self.cut(BLOCK_IDS)

    def cut(self, count: int) -> pa.RecordBatch:
        stream = np.concatenate(self.parts)
        planes = to_planes(stream[:count], self.bits)
        keys, starts, sizes = zip(*self.documents)
        row = {
            "shard": [self.shard], "block": [self.number], "first": [self.first], "n_ids": [count],
            "planes": [planes], "plane_bytes": [[len(p) for p in planes]],
            "doc_ids": [list(keys)], "doc_starts": [list(starts)], "doc_sizes": [list(sizes)],
        }
        self.number, self.first, self.held = self.number + 1, self.first + count, self.held - count
        self.parts = [stream[count:]]
        self.documents = [d for d in self.documents if d[1] + d[2] > self.first]
        return pa.RecordBatch.from_pydict(row, schema=_SCHEMA)


_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("planes", pa.list_(pa.binary()))]
    + [("plane_bytes", pa.list_(pa.int32()))]
    + [(n, pa.list_(pa.int64())) for n in ("doc_ids", "doc_starts", "doc_sizes")]
)


def write_ids(documents: DataFrame, path: str, vocabulary: Vocabulary, end_id: int = 2, bits: bool = False) -> None:
    """Encodes all texts and writes the file set below `path`."""

    def encode(batches):
        shard = _Blocks(TaskContext.get().partitionId(), bits)
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            keys = batch.column(0).to_pylist()
            for low, _, ids, first in encoded_blocks(raw, offsets, vocabulary):
                for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    yield from shard.add(keys[low + k], np.append(ids[a:b], np.uint32(end_id)))
        if shard.held:
            yield shard.cut(shard.held)

    # a null or repeated id is spread over the shards by the beginning of its texts, in the order of the sort
    ordered = documents.select("doc_id", "text").repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, _BLOCK).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    spark = documents.sparkSession
    blocks = spark.read.parquet(f"{path}/blocks").select("shard", "block", "first", "n_ids", "plane_bytes")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = shards.select("shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    blocks.join(base, "shard").select(
        "shard", "block", "base", (F.col("base") + F.col("first")).alias("position"), "n_ids", "plane_bytes"
    ).write.parquet(f"{path}/index")


_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2), modulo that of crc32; bits in reflected order."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return out


def joined_crc(left: int, right: int, right_bytes: int) -> int:
    """crc32 of two byte strings after each other, from theirs and the length of the second."""
    shift, square, n = 1 << 31, 1 << 23, right_bytes  # x^0 and x^8
    while n:
        if n & 1:
            shift = _times(square, shift)
        square, n = _times(square, square), n >> 1
    return _times(shift, left) ^ right


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the decoded blocks."""

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = memoryview(from_planes(row["planes"], row["n_ids"])).cast("B")
                first, end = row["first"], row["first"] + row["n_ids"]
                out = []
                for key, start, size in zip(row["doc_ids"], row["doc_starts"], row["doc_sizes"]):
                    a, b = max(start, first), min(start + size, end)
                    out.append((row["shard"], start, key, size, a - start, b - a, zlib.crc32(ids[4 * (a - first) : 4 * (b - first)])))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if k == 0 else pa.int64()) for k, c in enumerate(columns)],
                    names=["shard", "start", "doc_id", "size", "offset", "length", "crc"],
                )

    def join(batches):
        for batch in batches:
            crc = []
            for parts in batch.column(4).to_pylist():
                parts = sorted((p["offset"], p["length"], p["crc"]) for p in parts)
                total = parts[0][2]
                for _, length, more in parts[1:]:
                    total = joined_crc(total, more, 4 * length)
                crc.append(total)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(crc, pa.int64())], names=["shard", "start", "doc_id", "n_tokens", "ids_crc32"]
            )

    pieces = spark.read.schema(_BLOCK).parquet(f"{path}/blocks").mapInArrow(
        decode, "shard int, start bigint, doc_id bigint, size bigint, offset bigint, length bigint, crc bigint"
    )
    whole = (
        pieces.groupBy("shard", "start", "doc_id", "size")
        .agg(F.collect_list(F.struct("offset", "length", "crc")).alias("parts"))
        .mapInArrow(join, "shard int, start bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint")
    )
    bases = spark.read.parquet(f"{path}/index").select("shard", "base").distinct()
    return whole.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_range(spark: SparkSession, path: str, start: int, count: int) -> DataFrame:
    """(position, id) of `count` ids from `start` on; only their blocks are read."""
    wanted = spark.read.parquet(f"{path}/index").where((F.col("position") < start + count) & (F.col("position") + F.col("n_ids") > start))
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks").select("shard", "block", "planes")

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n_ids"])
                place = row["position"] + np.arange(len(ids))
                held = (place >= start) & (place < start + count)
                yield pa.RecordBatch.from_arrays([pa.array(place[held]), pa.array(ids[held].astype(np.int64))], names=["position", "id"])

    return (
        blocks.join(wanted, ["shard", "block"]).select("planes", "n_ids", "position").mapInArrow(decode, "position bigint, id bigint")
    )
