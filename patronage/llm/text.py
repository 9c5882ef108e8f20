"""Words, hashes and scratch tables shared by the corpus operators.

Python code runs only inside `mapInArrow` and grouped functions. It works on the byte buffer of
an Arrow batch, a few megabytes at a time, so a task's memory is bounded by the block size and its
longest text, not by its partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from patronage.session import scratch_path

#: the white space of a word pattern `[^\x20\x09-\x0D]+`
SPACES = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 4 << 20
LONG_SPAN = 512

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_MULTIPLY = _U(0x9E3779B97F4A7C15)
_AGAIN = _U(0xD6E8FEB86659FD93)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet below the shared folder and continue from the file.

    Cuts the lineage, keeps pruning and statistics, and survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of jobs whose results are stored."""
    spark.sparkContext._jvm.System.gc()


def column_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string())
    _, offsets, data = array.buffers()
    places = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, places


def blocks(raw: np.ndarray, offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about `limit` bytes: first row, end row, bytes, offsets."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, high, raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first word of each row (one entry more than rows)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~IS_SPACE[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    opens, closes = edge[:-1].copy(), edge[1:].copy()
    opens[1:] |= ~solid[:-1]
    closes[:-1] |= ~solid[1:]
    starts = np.flatnonzero(solid & opens)
    ends = np.flatnonzero(solid & closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _AGAIN
    h = (h ^ (h >> _U(29))) * _MULTIPLY
    return h ^ (h >> _U(32))


def words_of(raw: np.ndarray) -> np.ndarray:
    """An unaligned view: entry i is the little-endian number of the 8 bytes from i on."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    return np.ndarray((len(raw) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes at a time for all spans at once."""
    lengths = ends - starts
    lanes = words_of(raw)
    h = lengths.astype(np.uint64) * _MULTIPLY
    h = mix(h ^ (lanes[starts] & _MASKS[np.minimum(lengths, 8)]))
    rest, lane = np.flatnonzero((lengths > 8) & (lengths <= LONG_SPAN)), 8
    while len(rest):
        x = lanes[starts[rest] + lane] & _MASKS[np.minimum(lengths[rest] - lane, 8)]
        h[rest] = mix(h[rest] * _MULTIPLY + x)
        lane += 8
        rest = rest[lengths[rest] > lane]
    for i in np.flatnonzero(lengths > LONG_SPAN):
        h[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def held_out(key: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the key as text has that remainder; a null key is never held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def hashed_sample(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """About `size` rows, at most twice as many, by a hash of the keys; all rows of a smaller table.

    Every task picks its own rows, so no task gathers more than the sample.
    """
    n = df.count()
    if n <= size:
        return df
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) < F.lit((size << 40) // n)).limit(2 * size)
