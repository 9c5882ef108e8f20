"""K-means segments, quality of a clustering, choice of k, and principal components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.functions.blocks import added, evened, packed, reduced
from patronage.operators.customers import CUSTOMER
from patronage.operators.scaling import standard_scale
from patronage.operators.segments import BEHAVIOUR
from patronage.session import materialize

SEED = 42
#: steps of one start at most, and the move of a centre below which it stands
MAX_ITERATIONS, TOLERANCE = 300, 1e-4


def behaviour_vectors(
    master: DataFrame, features: Sequence[str] = tuple(BEHAVIOUR), customer: str = CUSTOMER
) -> DataFrame:
    """Standard-scaled behaviour as a vector, one row per customer."""
    filled = master.select(customer, *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return assembler.transform(standard_scale(filled, features)).select(customer, "features")


@dataclass
class Centers:
    """The centres of one fit and its cost, the sum of squared distances to the nearest centre."""

    centers: np.ndarray
    cost: float

    def label(self, x: Column) -> Column:
        """Number of the nearest centre of an array column, the smallest on ties."""
        distances = F.array(*(_square_distance(x, F.array(*(F.lit(float(v)) for v in c))) for c in self.centers))
        return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For centres (fits, k, dimensions): nearest centre and squared distance, (rows, fits)."""
    fits, k, size = centers.shape
    flat = centers.reshape(-1, size)
    distance = (x * x).sum(axis=1)[:, None] - 2 * x @ flat.T + (flat * flat).sum(axis=1)
    distance = distance.reshape(len(x), fits, k)
    label = distance.argmin(axis=2)
    return label, np.maximum(np.take_along_axis(distance, label[:, :, None], axis=2)[:, :, 0], 0)


#: rows of a block that are measured at once, so that their distances stay in the cache of a core
AT_ONCE = 512
#: rows of all blocks up to which sums are taken row by row; a noise of their last digits may lead to another optimum
PLAIN = 1 << 14
#: rows up to which a step reads all of them: it costs little more than its job
MANY = 1 << 18
#: steps at its present speed for which a fit's rows are looked through once; that pays if at most one pair of row and
#: fit in `WORTH` may change its cluster meanwhile, else the next look is `WAIT` steps later
AHEAD, WORTH, WAIT = 10, 3, 8
#: open rows that are measured at once
OPEN_AT_ONCE = 16384


def _cluster_totals(x: np.ndarray, centers: np.ndarray, sums: bool) -> list[np.ndarray]:
    """For centres (fits, k, dimensions): cost of each fit, then rows (fits, k) and sums (fits, k, dimensions) of the
    clusters; a row belongs to the nearest centre, the first on ties.

    Distances less the square of the row are one product of the rows with all centres, the sums one product of a
    cluster's members with the rows. A row's square is the same for all centres and counts in the cost only.
    """
    fits, k, size = centers.shape
    flat = centers.transpose(1, 0, 2).reshape(-1, size)
    table = np.column_stack([-2 * flat, (flat * flat).sum(axis=1)])
    cost, total = np.zeros(fits), np.zeros((k, fits, size + 1))
    for low in range(0, len(x), AT_ONCE):
        rows = np.column_stack([x[low : low + AT_ONCE], np.ones(len(x[low : low + AT_ONCE]))])
        apart = (table @ rows.T).reshape(k, fits, -1)
        least = apart.min(axis=0)
        squares = (rows[:, :-1] ** 2).sum(axis=1)
        cost += np.maximum(least + squares, 0).sum(axis=1)
        if not sums:
            continue
        free = np.ones(least.shape, dtype=bool)
        for j in range(k):
            mine = (apart[j] == least) & free
            total[j] += mine.astype(np.float64) @ rows
            free &= ~mine
    return [cost, total[:, :, -1].T, total[:, :, :-1].transpose(1, 0, 2)] if sums else [cost]


def _counted_totals(x: np.ndarray, centers: np.ndarray, sums: bool) -> list[np.ndarray]:
    """`_cluster_totals` row by row, in the order of the rows."""
    fits, k, size = centers.shape
    label, distance = _nearest(x, centers)
    if not sums:
        return [distance.sum(axis=0)]
    place = (label + k * np.arange(fits)).ravel()
    count = np.bincount(place, minlength=fits * k)
    by_column = [np.bincount(place, np.repeat(v, fits), fits * k) for v in x.T]
    return [distance.sum(axis=0), count.reshape(fits, k), np.stack(by_column, axis=1).reshape(centers.shape)]


def _table(centers: np.ndarray) -> np.ndarray:
    """Factors of a row and a 1 that give its distances to all centres, less its square; by centre, then fit."""
    flat = centers.transpose(1, 0, 2).reshape(-1, centers.shape[2])
    return np.column_stack([-2 * flat, (flat * flat).sum(axis=1)])


def _first(apart: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether a centre (first axis) is the nearest, the first on ties."""
    mine, free = apart == least, np.ones(least.shape, dtype=bool)
    for own in mine:
        own &= free
        free ^= own
    return mine


def _split_totals(x: np.ndarray, centers: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums and counts (k, fits, dimensions + 1) of the rows that stay in their cluster, those of the others, and which
    are the others, (fits, rows).

    While no centre of a fit moves by more than `reach`, a distance changes by no more than that. A row stays if its
    two least distances differ by more than twice the reach and the error of their computation.
    """
    fits, k, size = centers.shape
    table, norm = _table(centers), np.sqrt((centers**2).sum(axis=2)).max(axis=1)
    stay, change = np.zeros((2, k, fits, size + 1))
    open_ = np.zeros((fits, len(x)), dtype=bool)
    for low in range(0, len(x), AT_ONCE):
        rows = np.column_stack([x[low : low + AT_ONCE], np.ones(len(x[low : low + AT_ONCE]))])
        apart = (table @ rows.T).reshape(k, fits, -1)
        squares = (rows[:, :-1] ** 2).sum(axis=1)
        least = apart.min(axis=0)
        mine = _first(apart, least)
        np.putmask(apart, mine, np.inf)
        between = np.sqrt(np.maximum(apart.min(axis=0) + squares, 0)) - np.sqrt(np.maximum(least + squares, 0))
        error = 1e-6 * (np.sqrt(squares) + norm[:, None])
        fixed = between > 2 * reach[:, None] + error
        open_[:, low : low + AT_ONCE] = ~fixed
        for j in range(k):
            stay[j] += (mine[j] & fixed).astype(np.float64) @ rows
            change[j] += (mine[j] & ~fixed).astype(np.float64) @ rows
    return stay, change, open_


def _open_totals(rows: np.ndarray, open_: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Sums and counts (k, fits, dimensions + 1) over the open rows of each fit; rows end with a 1."""
    fits, k, size = centers.shape
    table = _table(centers).reshape(k, fits, -1)
    total = np.zeros((k, fits, size + 1))
    for fit in range(fits):
        some = rows[np.flatnonzero(open_[fit])]
        apart = table[:, fit] @ some.T
        total[:, fit] = _first(apart, apart.min(axis=0)).astype(np.float64) @ some
    return total


class _Sums:
    """Counts and sums of the clusters of all fits, step by step, for centres that slow down.

    A look over all rows tells which can change their cluster while the centres stay within a reach of where they are;
    these are kept with the executors, with a bit for every fit. The sums of all others are added up once and hold
    until a centre has gone beyond the reach, so the steps in between read the kept rows only.
    """

    def __init__(self, blocks: RDD) -> None:
        self.blocks, self.wait = blocks, WAIT
        self.kept: RDD | None = None

    def __call__(self, current: dict[int, np.ndarray], ids: dict[int, np.ndarray], speed: dict[int, np.ndarray] | None) -> dict:
        """Count and sums (fits, k, ...) per k. `ids` numbers the fits, `speed` is how far their centres went last."""
        if self.kept is not None and self._within(current, ids):
            totals = self._few(current, ids)
        else:
            self.drop()
            self.wait -= 1
            totals = self._all(current) if speed is None or self.wait >= 0 else self._look(current, ids, speed)
        return {k: (t[:, :, -1].T, t[:, :, :-1].transpose(1, 0, 2)) for k, t in totals.items()}

    def drop(self) -> None:
        if self.kept is not None:
            self.kept.unpersist()
            self.shared.destroy()
            self.kept = None

    def _all(self, current: dict) -> dict:
        shared = self.blocks.context.broadcast(current)

        def add(rows: Iterator) -> Iterator:
            total = None
            for x, _ in rows:
                part = [_cluster_totals(x, c, True)[1:] for _, c in sorted(shared.value.items())]
                total = part if total is None else added(total, part)
            if total is not None:
                yield total

        merged = reduced(self.blocks.mapPartitions(add), added)
        shared.destroy()
        return {k: np.concatenate([s, n[:, :, None]], axis=2).transpose(1, 0, 2) for k, (n, s) in zip(sorted(current), merged)}

    def _look(self, current: dict, ids: dict, speed: dict) -> dict:
        self.ids, self.centers = ids, current
        self.reach = {k: AHEAD * speed[k] for k in current}
        shared = self.shared = self.blocks.context.broadcast((current, self.reach))

        def look(rows: Iterator) -> Iterator:
            centers, reach = shared.value
            total, pairs, opened, held, n = None, 0, 0, [], 0

            def joined():
                some = np.concatenate([x for x, _ in held])
                bits = [np.packbits(np.concatenate(o, axis=1), axis=1) for o in zip(*(o for _, o in held))]
                return None, np.column_stack([some, np.ones(len(some))]), bits

            for x, _ in rows:
                parts = [_split_totals(x, centers[k], reach[k]) for k in sorted(centers)]
                sums = [part[:2] for part in parts]
                total = sums if total is None else added(total, sums)
                pairs += sum(o.size for _, _, o in parts)
                opened += sum(int(o.sum()) for _, _, o in parts)
                some = np.any([o.any(axis=0) for _, _, o in parts], axis=0)
                held.append((x[some], [o[:, some] for _, _, o in parts]))
                n += int(some.sum())
                if n >= OPEN_AT_ONCE:
                    yield joined()
                    held, n = [], 0
            if n:
                yield joined()
            if total is not None:
                yield [total, pairs, opened], None, None

        self.kept = self.blocks.mapPartitions(look).persist(StorageLevel.MEMORY_AND_DISK)
        merged, pairs, opened = reduced(self.kept.filter(lambda part: part[0] is not None).map(lambda part: part[0]), added)
        self.stay = {k: stay for k, (stay, _) in zip(sorted(current), merged)}
        if opened * WORTH > pairs:
            self.drop()
            self.wait = WAIT
        return {k: stay + change for k, (stay, change) in zip(sorted(current), merged)}

    def _within(self, current: dict, ids: dict) -> bool:
        for k, c in current.items():
            at = np.searchsorted(self.ids[k], ids[k])
            gone = np.sqrt(((c - self.centers[k][at]) ** 2).sum(axis=2)).max(axis=1)
            if not (gone <= self.reach[k][at]).all():
                return False
        return True

    def _few(self, current: dict, ids: dict) -> dict:
        at = {k: np.searchsorted(self.ids[k], ids[k]) for k in current}
        known = sorted(self.ids)
        shared = self.blocks.context.broadcast((current, at))

        def add(parts: Iterator) -> Iterator:
            centers, places = shared.value
            total = [np.zeros((c.shape[1], c.shape[0], c.shape[2] + 1)) for _, c in sorted(centers.items())]
            for _, rows, bits in parts:
                if rows is None:
                    continue
                by_k = dict(zip(known, bits))
                for i, (k, c) in enumerate(sorted(centers.items())):
                    open_ = np.unpackbits(by_k[k][places[k]], axis=1, count=len(rows)).view(bool)
                    total[i] += _open_totals(rows, open_, c)
            yield total

        merged = reduced(self.kept.mapPartitions(add), added)
        shared.destroy()
        return {k: self.stay[k][:, at[k]] + t for k, t in zip(sorted(current), merged)}


def _seeds(blocks: RDD, k: int, starts: int, seed: int) -> np.ndarray:
    """k-means++ seeds of all starts, (starts, k, dimensions): one weighted draw of all starts a job.

    A row with squared distance d to the seeds so far gets a waiting time from an exponential distribution of
    rate d; the first of all rows is the seed, which is a draw in proportion to d. The first k of a start's seeds
    are the seeds it would have with fewer centres.
    """
    chosen: list[np.ndarray] = []
    for step in range(k):
        known = np.stack(chosen, axis=1) if chosen else None

        def draw(part: int, rows: Iterator, known=known, step=step) -> Iterator:
            best, who = np.full(starts, np.inf), None
            noise = np.random.default_rng([seed, step, part])
            for x, _ in rows:
                if not len(x):
                    continue
                weight = np.ones((len(x), starts)) if known is None else _nearest(x, known)[1]
                with np.errstate(divide="ignore"):
                    wait = noise.exponential(size=(len(x), starts)) / weight
                first = wait.argmin(axis=0)
                least = wait[first, np.arange(starts)]
                if who is None:
                    best, who = least, x[first]
                else:
                    won = least < best
                    best, who = np.where(won, least, best), np.where(won[:, None], x[first], who)
            yield best, who

        def sooner(a, b):
            if a[1] is None or b[1] is None:
                return a if b[1] is None else b
            won = b[0] < a[0]
            return np.where(won, b[0], a[0]), np.where(won[:, None], b[1], a[1])

        chosen.append(reduced(blocks.mapPartitionsWithIndex(draw), sooner)[1])
    return np.stack(chosen, axis=1)


def fit_kmeans(vectors: DataFrame, ks: Sequence[int], n_init: int = 50, seed: int = SEED, column: str = "x") -> dict[int, Centers]:
    """For every k the best of `n_init` starts by within-cluster cost, the first on ties.

    `vectors` has an array column. All starts and all k advance together: a step is one pass over the rows that adds
    up the clusters of every fit that still moves, so the number of jobs is that of the slowest fit; of a large table
    it reads the rows only that may have changed their cluster (`_Sums`). A centre without rows stays. A fit ends when
    no centre moves by more than `TOLERANCE`.
    """
    blocks = packed(vectors, column)
    rows = blocks.map(lambda block: len(block[0])).sum()
    large = rows > MANY
    totals = _cluster_totals if rows > PLAIN else _counted_totals
    seeds = _seeds(blocks, max(ks), n_init, seed)
    if large:
        blocks = evened(blocks)
    centers = {k: seeds[:, :k].copy() for k in ks}
    moving = {k: np.arange(n_init) for k in ks}
    spark = vectors.sparkSession.sparkContext

    def step(current: dict[int, np.ndarray], sums: bool):
        shared = spark.broadcast(current)

        def add(rows: Iterator) -> Iterator:
            total = None
            for x, _ in rows:
                part = [totals(x, c, sums) for _, c in sorted(shared.value.items())]
                total = part if total is None else added(total, part)
            if total is not None:
                yield total

        merged = reduced(blocks.mapPartitions(add), added)
        shared.destroy()
        return dict(zip(sorted(current), merged))

    sums, speed = _Sums(blocks), None
    for _ in range(MAX_ITERATIONS):
        current = {k: centers[k][moving[k]] for k in ks if len(moving[k])}
        if not current:
            break
        if large:
            found = sums(current, {k: moving[k] for k in current}, speed)
        else:
            found = {k: part[1:] for k, part in step(current, True).items()}
        speed = {}
        for k, (count, total) in found.items():
            old = current[k]
            count, total = count.reshape(len(old), k, 1), total.reshape(old.shape)
            new = np.where(count > 0, total / np.maximum(count, 1), old)
            centers[k][moving[k]] = new
            gone = ((new - old) ** 2).sum(axis=2).max(axis=1)
            moved = gone > TOLERANCE**2
            moving[k], speed[k] = moving[k][moved], np.sqrt(gone[moved])
    sums.drop()
    costs = step(centers, False)
    blocks.unpersist()
    best = {k: int(np.argmin(costs[k][0])) for k in ks}
    return {k: Centers(centers[k][best[k]], float(costs[k][0][best[k]])) for k in ks}


def _arrays(vectors: DataFrame) -> DataFrame:
    """The vectors as stored arrays: what the fits and the labelling read."""
    return materialize(vectors.withColumn("x", vector_to_array("features")))


def kmeans_segments(
    vectors: DataFrame, k: int = 5, n_init: int = 50, seed: int = SEED, customer: str = CUSTOMER
) -> DataFrame:
    """Cluster per customer. Clusters are numbered by size, ties by the first coordinate of
    the centre, so that the numbers do not depend on the start."""
    stored = _arrays(vectors)
    if stored.isEmpty():
        return stored.select(customer, F.lit(0).alias("cluster"), "features")
    model = fit_kmeans(stored, [k], n_init, seed)[k]
    predicted = materialize(stored.withColumn("prediction", model.label(F.col("x"))))
    sizes = {r["prediction"]: r["count"] for r in predicted.groupBy("prediction").count().collect()}
    order = sorted(range(k), key=lambda c: (-sizes.get(c, 0), *model.centers[c]))
    number = F.create_map(*(F.lit(x) for new, old in enumerate(order) for x in (old, new)))
    return predicted.select(customer, number[F.col("prediction")].cast("int").alias("cluster"), "features")


# ---- quality -------------------------------------------------------------------------------


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def _square_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


#: clusters of a clustering that are sent to the tasks at once
CLUSTERS = 4096


def _cluster_sums(labelled: DataFrame, dimensions: int, by: str) -> DataFrame:
    """Size, sum, sum of squares and centre of every cluster."""
    sums = F.array(*(F.sum(F.col("x")[i]) for i in range(dimensions)))
    grouped = labelled.groupBy(by, "label").agg(
        F.count("*").alias("n"), sums.alias("sums"), F.sum(_dot(F.col("x"), F.col("x"))).alias("squares")
    )
    return grouped.withColumn("center", F.transform("sums", lambda v: v / F.col("n")))


def _tables(clusters: DataFrame, by: str, columns: Sequence[str], name: str) -> DataFrame:
    """All given clusters of a clustering in one row."""
    return clusters.groupBy(by).agg(F.collect_list(F.struct(*columns)).alias(name))


def _against(points: DataFrame, clusters: DataFrame, by: str) -> DataFrame:
    """Points with their own cluster and the mean squared distance to the nearest other one, as far as these
    clusters tell; both are null for a point that has none among them."""
    x = F.col("x")
    far = F.transform(
        "clusters",
        lambda c: F.struct(
            c["label"].alias("label"),
            c["n"].alias("n"),
            (_dot(x, x) + (c["squares"] - 2 * _dot(x, c["sums"])) / c["n"]).alias("mean"),
            c["center"].alias("center"),
        ),
    )
    own = F.get(F.filter("far", lambda c: c["label"] == F.col("label")), F.lit(0))
    other = F.array_min(F.transform(F.filter("far", lambda c: c["label"] != F.col("label")), lambda c: c["mean"]))
    tables = _tables(clusters, by, ["label", "n", "sums", "squares", "center"], "clusters")
    return points.join(F.broadcast(tables), by, "left").withColumn("far", far).select(*points.columns, own.alias("_own"), other.alias("_other"))


def _overlap(a_spread: Column, a_center: Column, b: Column) -> Column:
    apart = F.nullif(F.sqrt(_square_distance(a_center, b["center"])), F.lit(0.0))
    return F.coalesce((a_spread + b["spread"]) / apart, F.lit(0.0))


def cluster_quality(labelled: DataFrame, dimensions: int, by: str = "k", at_once: int | None = None) -> DataFrame:
    """Silhouette (squared Euclidean), Davies-Bouldin index and inertia per clustering.

    `labelled` has columns `by`, `label` and `x` (array of doubles). Size, sum and sum of
    squares of a cluster give the mean squared distance of a point to all its members, so
    no pairs of points are formed. The clusters are counted first: up to `at_once` of a clustering go to the
    tasks in one broadcast table, more of them block by block, the nearest other cluster and the worst
    overlap being carried along. The work is rows times clusters, as the measures demand.
    """
    at_once = at_once or CLUSTERS
    most = labelled.select(by, "label").groupBy(by, "label").count().groupBy(by).count().agg(F.max("count")).first()[0] or 0
    clusters = _cluster_sums(labelled, dimensions, by)
    blocks = max(1, -(-most // at_once))
    slot = F.pmod(F.xxhash64("label"), F.lit(blocks))
    if blocks > 1:
        clusters = materialize(clusters)
    points = labelled.select(by, "label", "x")
    for block in range(blocks):
        met = _against(points, clusters.where(slot == block) if blocks > 1 else clusters, by)
        if block == 0:
            points = met.withColumnsRenamed({"_own": "own", "_other": "other"})
        else:
            points = met.withColumns({"own": F.coalesce("own", "_own"), "other": F.least("other", "_other")}).drop("_own", "_other")
        if blocks > 1:
            points = materialize(points)
    inner = F.greatest(F.col("own.mean"), F.lit(0.0)) * F.col("own.n") / F.nullif(F.col("own.n") - 1, F.lit(0))
    width = F.coalesce((F.col("other") - F.col("inner")) / F.nullif(F.greatest("inner", "other"), F.lit(0.0)), F.lit(0.0))
    measured = points.withColumns({"d2": _square_distance(F.col("x"), F.col("own.center")), "inner": inner})
    per_cluster = measured.groupBy(by, "label").agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("own.n") > 1, width).otherwise(0.0)).alias("width"),
        F.sum("d2").alias("d2"),
        F.avg(F.sqrt("d2")).alias("spread"),
        F.any_value("own.center").alias("center"),
    )
    totals = (F.sum("width") / F.sum("n")).alias("silhouette"), F.sum("d2").alias("inertia")
    if blocks == 1:
        summary = per_cluster.groupBy(by).agg(*totals, F.collect_list(F.struct("label", "spread", "center")).alias("c"))

        def worst(a: Column) -> Column:
            rest = F.filter("c", lambda b: b["label"] != a["label"])
            return F.array_max(F.transform(rest, lambda b: _overlap(a["spread"], a["center"], b)))

        total = F.aggregate(F.transform("c", worst), F.lit(0.0), lambda acc, v: acc + v)
        return summary.select(by, "silhouette", (total / F.size("c")).alias("db_index"), "inertia")
    per_cluster = materialize(per_cluster)
    rows = per_cluster.withColumn("worst", F.lit(None).cast("double"))
    for block in range(blocks):
        table = _tables(per_cluster.where(slot == block), by, ["label", "spread", "center"], "_c")
        rest = F.filter("_c", lambda b: b["label"] != F.col("label"))
        overlaps = F.array_max(F.transform(rest, lambda b: _overlap(F.col("spread"), F.col("center"), b)))
        rows = rows.join(F.broadcast(table), by, "left").withColumn("worst", F.greatest("worst", overlaps)).drop("_c")
        rows = materialize(rows)
    return rows.groupBy(by).agg(*totals, F.avg("worst").alias("db_index")).select(by, "silhouette", "db_index", "inertia")


def kmeans_k_search(
    vectors: DataFrame, dimensions: int, ks: Sequence[int] = range(2, 11), n_init: int = 50, seed: int = SEED
) -> DataFrame:
    """Quality of k-means for every k. All fits advance together, all clusterings are judged in one pass."""
    stored = _arrays(vectors)
    models = fit_kmeans(stored, list(ks), n_init, seed)
    choices = F.array(*(F.struct(F.lit(k).alias("k"), models[k].label(F.col("x")).alias("label")) for k in ks))
    labelled = materialize(stored.select("x", choices.alias("choices")))
    long = labelled.select("x", F.explode("choices").alias("c")).select("x", "c.*")
    return cluster_quality(long, dimensions)


# ---- choice of k (tables of a few rows) ----------------------------------------------------


def elbow_bend(metrics: DataFrame) -> DataFrame:
    """Absolute second difference of the inertia; null at both ends."""
    by_k = Window.orderBy("k")
    bend = F.abs((F.lag("inertia").over(by_k) - F.col("inertia")) - (F.col("inertia") - F.lead("inertia").over(by_k)))
    return metrics.withColumn("bend", bend)


def elbow_k(metrics: DataFrame) -> DataFrame:
    """The k where the inertia curve bends most, the smallest on ties."""
    return elbow_bend(metrics).where(F.col("bend").isNotNull()).agg(
        F.max_by("k", F.struct("bend", -F.col("k"))).alias("elbow_k"), F.max("bend").alias("bend")
    )


def k_metric_ranks(metrics: DataFrame) -> DataFrame:
    """Average ranks: silhouette from the highest, Davies-Bouldin index from the lowest."""

    def average_rank(order: Column, tied: str) -> Column:
        place = F.rank().over(Window.orderBy(order))
        return place + (F.count("*").over(Window.partitionBy(tied)) - 1) / 2

    return metrics.select(
        "k",
        "silhouette",
        "db_index",
        average_rank(F.desc("silhouette"), "silhouette").alias("silhouette_rank"),
        average_rank(F.asc("db_index"), "db_index").alias("db_rank"),
    )


def best_k(metrics: DataFrame) -> DataFrame:
    """k by silhouette, by Davies-Bouldin index and by elbow; the smallest k on ties."""
    return elbow_bend(metrics).agg(
        F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("by_silhouette"),
        F.min_by("k", F.struct("db_index", "k")).alias("by_db_index"),
        F.max_by("k", F.when(F.col("bend").isNotNull(), F.struct("bend", -F.col("k")))).alias("by_elbow"),
    )


# ---- principal components ------------------------------------------------------------------


def fit_pca(vectors: DataFrame, components: int = 2):
    """PCA of centred vectors; the scaled behaviour is centred already."""
    return PCA(k=components, inputCol="features", outputCol="projected").fit(vectors)


def _signs(matrix) -> list[float]:
    """Direction of each component: its largest loading is positive."""
    return [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in matrix.T]


def pca_loadings(model, features: Sequence[str], spark) -> DataFrame:
    """Loading of each feature on the components, and the share of variance explained."""
    matrix = model.pc.toArray()
    signed = matrix * _signs(matrix)
    rows = [(f, *map(float, signed[i])) for i, f in enumerate(features)]
    names = [f"PC{j + 1}" for j in range(signed.shape[1])]
    table = spark.createDataFrame(rows, "feature string, " + ", ".join(f"{n} double" for n in names))
    return table.withColumns(
        {f"{n}_variance": F.lit(float(v)) for n, v in zip(names, model.explainedVariance.toArray())}
    )


def pca_projection(model, clustered: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Customers and their cluster in the plane of the first two components."""
    signs = _signs(model.pc.toArray())
    point = vector_to_array("projected")
    return model.transform(clustered).select(
        customer, "cluster", *((point[j] * sign).alias(f"PC{j + 1}") for j, sign in enumerate(signs))
    )


def projected_centers(projection: DataFrame) -> DataFrame:
    """Cluster centres in the plane: the projection is linear, so means stay means."""
    return projection.groupBy("cluster").agg(F.avg("PC1").alias("PC1"), F.avg("PC2").alias("PC2"))
