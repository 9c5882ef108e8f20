"""Centroid clustering of integer vectors by an equal-average equal-variance search.

Every vector of `size` components is turned into integers floor(scale * x). The centroids start as
the `k` vectors whose ids have the smallest seeded digest. In each round every vector goes to its nearest
centroid (squared Euclidean distance, the smaller number on ties), and every centroid with vectors becomes
their componentwise floor(sum / count). Afterwards the vectors are assigned once more.

The search keeps the centroids sorted by the sum of their components. It starts at a vector's own sum and
scans outward on both sides. With S the sum and R the length of what is left of a vector after its mean is taken
off, d(x, c) >= (S_x - S_c)^2 / size + (R_x - R_c)^2. The first term alone only grows along a side and ends the
scan of that side; both together reject a single centroid; the others are measured in integers. Both tests
reject only what is farther than the best so far, by more than the error of the arithmetic, so the result is
that of a full search, ties included.

The vectors are quantised once into a stored table. A round is one pass over it and one small aggregation: every
task adds up its own vectors exactly, so a cluster that holds most rows costs a task no more than another, and at
most `k` sums a task are shuffled. Only the `k` centroids reach the driver and, with the code, the tasks.

Rows are left out when the vector is null, has another number of components, or a component that is null or not
finite. Repeated rows, equal vectors and null ids count like others; a null id is never a start, and equal
digests are ordered by the vector. With fewer than `k` vectors that have an id there are fewer centroids; without
any, vectors have null cluster and distance. A centroid without vectors stays where it is, and may equal another: the
smaller number wins. Sums are exact for components of any size; a distance or an inertia beyond 2^63 - 1 is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from patronage.llm.text import store

#: components below this size leave room in 64 bits for the distance of vectors of up to 64 components
NEAR = 1 << 27
LIMB = 30
ROWS = 8192
LONGEST = (1 << 63) - 1


def quantised(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and the components as integers, of the rows with whole vectors.

    `near` holds them as ints; a vector with a component of `NEAR` or more has `far` instead, decimal numbers
    as text.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1).cast(pa.large_list(pa.float64()))
            offsets = lists.offsets.to_numpy()
            whole = np.flatnonzero((np.diff(offsets) == size) & ~np.asarray(lists.is_null()))
            values = lists.values.to_numpy(zero_copy_only=False)  # null becomes nan
            x = values[offsets[whole][:, None] + np.arange(size)] if len(whole) else np.zeros((0, size))
            good = np.isfinite(x).all(axis=1)
            whole, x = whole[good], x[good]
            small = (np.abs(x) < NEAR / scale).all(axis=1)
            near = np.floor(x[small] * scale).astype(np.int32).ravel()
            place = np.concatenate([[0], np.cumsum(np.where(small, size, 0))]).astype(np.int32)
            mask = pa.array(~small)
            text = [None if s else [str(_floor(float(v), scale)) for v in row] for s, row in zip(small, x)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(whole)),
                    pa.ListArray.from_arrays(pa.array(place), pa.array(near), mask=mask),
                    pa.array(text, pa.list_(pa.string())),
                ],
                names=["vec_id", "near", "far"],
            )

    ready = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return ready.mapInArrow(cut, f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, near array<int>, far array<string>")


def _floor(x: float, scale: int) -> int:
    whole = math.floor(x)
    return whole * scale + math.floor((x - whole) * scale)


@dataclass
class Search:
    """The centroids in order of their sums, and what the inequalities need."""

    centroids: list[list[int]]

    def __post_init__(self):
        self.sums = np.array([sum(c) for c in self.centroids], dtype=object)
        order = sorted(range(len(self.centroids)), key=lambda j: (self.sums[j], j))
        self.order = np.array(order, dtype=np.int64)
        self.small = all(abs(v) < NEAR for c in self.centroids for v in c)
        if self.small:
            self.table = np.array([self.centroids[j] for j in order], dtype=np.int64)
            self.sum = self.table.sum(axis=1)
            self.rest, self.error = _rest(self.table, self.sum)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest centroid, squared distance, and centroids measured, for rows of ints."""
        size, k, n = x.shape[1], len(self.order), len(x)
        total = x.sum(axis=1)
        rest, error = _rest(x, total)
        # the next centroid to look at on each side; out of range when a side is done
        up = np.searchsorted(self.sum, total)
        down = up - 1
        best = np.full(n, -1, dtype=np.int64)
        least = np.full(n, LONGEST, dtype=np.int64)
        measured = np.zeros(n, dtype=np.int32)
        open_rows = np.arange(n)
        while len(open_rows):
            u, d = up[open_rows], down[open_rows]
            far_up = np.where(u < k, np.abs(self.sum[np.minimum(u, k - 1)] - total[open_rows]), LONGEST)
            far_down = np.where(d >= 0, np.abs(total[open_rows] - self.sum[np.maximum(d, 0)]), LONGEST)
            rising = far_up < far_down
            gap = np.where(rising, far_up, far_down)
            # all that is left of a row is at least as far by its mean as this one
            live = (gap < LONGEST) & (gap.astype(np.float64) ** 2 * (1 - 1e-9) <= least[open_rows].astype(np.float64) * size)
            open_rows, rising, gap = open_rows[live], rising[live], gap[live]
            at = np.where(rising, up[open_rows], down[open_rows])
            up[open_rows] += rising
            down[open_rows] -= ~rising
            unlike = np.maximum(np.abs(rest[open_rows] - self.rest[at]) - error[open_rows] - self.error[at], 0)
            bound = gap.astype(np.float64) ** 2 / size + unlike**2
            try_ = bound * (1 - 1e-9) <= least[open_rows].astype(np.float64)
            rows, at = open_rows[try_], at[try_]
            apart = x[rows] - self.table[at]
            distance = np.einsum("ij,ij->i", apart, apart)
            measured[rows] += 1
            number = self.order[at]
            won = (distance < least[rows]) | ((distance == least[rows]) & (number < best[rows]))
            best[rows[won]], least[rows[won]] = number[won], distance[won]
        return best, least, measured

    def nearest_far(self, x: list[int]) -> tuple[int, int]:
        """The same for one vector of whole numbers of any size: scanned by the first inequality."""
        size, total = len(x), sum(x)
        least, best = None, -1
        for j in sorted(range(len(self.centroids)), key=lambda j: abs(self.sums[j] - total)):
            if least is not None and (self.sums[j] - total) ** 2 > least * size:
                break
            distance = sum((a - b) ** 2 for a, b in zip(x, self.centroids[j]))
            if least is None or (distance, j) < (least, best):
                least, best = distance, j
        return best, least


def _rest(x: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length of each vector less its mean, and a bound of the rounding error of that."""
    squares = np.einsum("ij,ij->i", x, x).astype(np.float64)
    return np.sqrt(np.maximum(squares - total.astype(np.float64) ** 2 / x.shape[1], 0)), np.sqrt(squares) * 2.0**-24


def _rows(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray | list[list[int]]]]:
    """Places of the rows and their vectors: runs of near ones, then the far ones."""
    near, far = batch.column("near"), batch.column("far")
    places = np.flatnonzero(~np.asarray(near.is_null()))
    values = near.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.int64)
    for low in range(0, len(places), ROWS):
        yield places[low : low + ROWS], values[low : low + ROWS]
    left = np.flatnonzero(np.asarray(near.is_null()))
    if len(left):
        yield left, [[int(v) for v in row] for row in far.take(pa.array(left)).to_pylist()]


def _assign(search: Search, x) -> tuple[np.ndarray, list, np.ndarray]:
    if isinstance(x, np.ndarray) and search.small:
        best, least, measured = search.nearest(x)
        return best, least.tolist(), measured
    found = [search.nearest_far([int(v) for v in row]) for row in x]
    return np.array([b for b, _ in found]), [d for _, d in found], np.full(len(found), len(search.order), dtype=np.int32)


def _limbs(total: int) -> list[int]:
    """A whole number in digits of `LIMB` bits, the last one signed and below 2^62."""
    out = []
    while abs(total) >= 1 << 62:
        out.append(total & ((1 << LIMB) - 1))
        total >>= LIMB
    return [*out, total]


def cluster_sums(ready: DataFrame, centroids: list[list[int]], size: int) -> dict[int, tuple[int, list[int]]]:
    """Rows and exact componentwise sum of every cluster that has vectors."""
    spark = ready.sparkSession
    search = spark.sparkContext.broadcast(Search(centroids))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        count = np.zeros(k, dtype=np.int64)
        total = [[0] * size for _ in range(k)]
        for batch in batches:
            for _, x in _rows(batch, size):
                best, _, _ = _assign(search.value, x)
                count += np.bincount(best, minlength=k)
                if isinstance(x, np.ndarray):
                    order = np.argsort(best, kind="stable")
                    present = np.flatnonzero(np.bincount(best, minlength=k))
                    firsts = np.searchsorted(best[order], present)
                    for j, part in zip(present, np.add.reduceat(x[order], firsts, axis=0)):
                        total[j] = [a + int(b) for a, b in zip(total[j], part)]
                else:
                    for j, row in zip(best, x):
                        total[j] = [a + b for a, b in zip(total[j], row)]
        out = []
        for j in np.flatnonzero(count).tolist():
            # place -1 holds the number of rows; two halves, so that the sum over all tasks cannot overflow
            for place, value in enumerate([int(count[j]), *total[j]], -1):
                out += [(j, place, limb, digit >> 31, digit & 0x7FFFFFFF) for limb, digit in enumerate(_limbs(value))]
        columns = list(zip(*out)) or [[], [], [], [], []]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["cluster", "place", "limb", "high", "low"])

    partial = ready.mapInArrow(add, "cluster int, place int, limb int, high bigint, low bigint")
    sums = partial.groupBy("cluster", "place", "limb").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    result: dict[int, tuple[int, list[int]]] = {}
    for r in sums.collect():  # k x size numbers, a few more where components are huge
        n, known = result.setdefault(r["cluster"], (0, [0] * size))
        value = ((r["high"] << 31) + r["low"]) << (LIMB * r["limb"])
        if r["place"] < 0:
            result[r["cluster"]] = (n + value, known)
        else:
            known[r["place"]] += value
    return result


def _start(ready: DataFrame, k: int, seed: int) -> list[list[int]]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = ready.where("vec_id is not null").select(digest.alias("digest"), "near", "far").orderBy("digest", "near", "far").limit(k).collect()
    return [[int(v) for v in (r["near"] if r["near"] is not None else r["far"])] for r in rows]


@dataclass
class Clustering:
    """Assigned vectors (vec_id, cluster, distance, measured) and the final centroids by number."""

    assigned: DataFrame
    centroids: list[list[int]]


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, seed: int = 1) -> Clustering:
    """Cluster the columns vec_id, embedding of `vectors`; `measured` counts the distances a search computed."""
    if size * (2 * NEAR) ** 2 > LONGEST:
        raise ValueError("at most 64 components leave room for exact distances")
    ready = store(quantised(vectors, size, scale), "quantised")
    centroids = _start(ready, k, seed)
    for _ in range(rounds if centroids else 0):
        for j, (n, total) in cluster_sums(ready, centroids, size).items():
            centroids[j] = [v // n for v in total]
    search = ready.sparkSession.sparkContext.broadcast(Search(centroids) if centroids else None)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if search.value is None:
                none = pa.nulls(batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), none.cast(pa.int32()), none.cast(pa.int64()), none.cast(pa.int32())], names=["vec_id", "cluster", "distance", "measured"]
                )
                continue
            for places, x in _rows(batch, size):
                best, least, measured = _assign(search.value, x)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(places)),
                        pa.array(best.astype(np.int32)),
                        pa.array([d if d <= LONGEST else None for d in least], pa.int64()),
                        pa.array(measured),
                    ],
                    names=["vec_id", "cluster", "distance", "measured"],
                )

    schema = f"vec_id {ready.schema['vec_id'].dataType.simpleString()}, cluster int, distance bigint, measured int"
    return Clustering(store(ready.mapInArrow(assign, schema), "assigned"), centroids)


def cluster_report(clustering: Clustering) -> DataFrame:
    """Every assigned vector with the inertia of its cluster and of all, and the digest of its centroid."""
    assigned = clustering.assigned
    sums = assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("lost")
    )
    known = {r["cluster"]: None if r["lost"] else int(r["total"]) for r in sums.collect()}  # one row a cluster
    whole = None if None in known.values() else sum(known.values())
    fits = lambda v: None if v is None or v > LONGEST else v
    table = [
        (j, fits(v), fits(whole), hashlib.sha256(",".join(map(str, clustering.centroids[j])).encode()).hexdigest())
        for j, v in known.items()
        if j is not None
    ]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return assigned.join(F.broadcast(assigned.sparkSession.createDataFrame(table, schema)), "cluster", "left").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _oracle(k: int, rounds: int, size: int, scale: int, seed: int) -> str:
    """All distances to all centroids in every round."""

    def assign(number: int) -> str:
        return f"""
a{number} AS (SELECT r, c, d FROM (
  SELECT p.r, e.c, sum((p.v - e.v) * (p.v - e.v)) AS d FROM points p JOIN c{number} e USING (j) GROUP BY p.r, e.c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""

    steps = [
        assign(i)
        + f""",
m{i} AS (SELECT c, j, floor(sum(v)::DOUBLE / count(*))::BIGINT AS v FROM a{i} JOIN points USING (r) GROUP BY c, j),
c{i + 1} AS (SELECT o.c, o.j, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN m{i} m USING (c, j))"""
        for i in range(rounds)
    ]
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
points AS (SELECT r, unnest(q) AS v, unnest(range(1, {size + 1})) AS j FROM kept),
starts AS (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), q) - 1 AS c, q FROM kept WHERE vec_id IS NOT NULL
  QUALIFY row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), q) <= {k}),
c0 AS (SELECT c, unnest(q) AS v, unnest(range(1, {size + 1})) AS j FROM starts),{",".join(steps)},{assign(rounds)},
digests AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, c::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN digests USING (c)
"""


#: sixteen centroids, three rounds, 64 components
ORACLE = _oracle(16, 3, 64, 64, 1)
