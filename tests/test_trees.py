"""Side-by-side trees and logistic fits against plain Python and against their conditions of optimality."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.operators import clusters, logistic, trees
from patronage.operators.clusters import Centers, fit_kmeans
from patronage.session import scratch_path

ROW = "x array<double>, label double, weight double, fold int"


def rows_of(n, seed=1, size=4):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        x = [round(pick.gauss(0, 1), 2) for _ in range(size - 1)] + [float(pick.randrange(3))]
        y = float(x[0] * x[1] + x[3] + pick.gauss(0, 0.7) > 0.8)
        out.append((x, y, 1.0 + (i % 3) / 4, pick.randrange(3)))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return rows_of(500), spark.createDataFrame(rows_of(500), ROW).repartition(3).cache()


def plain_trees(rows, edges, fit):
    """One fit, row by row and split by split."""
    coded = [[int(sum(v > e for e in edges[j])) for j, v in enumerate(x)] for x, _, _, _ in rows]
    score = [0.0] * len(rows)
    grown = []
    for _ in range(fit.trees):
        g, h = [], []
        for (_, y, w, f), s in zip(rows, score):
            p = 1 / (1 + math.exp(-s))
            g.append(0.0 if f == fit.fold else w * (p - y))
            h.append(0.0 if f == fit.fold else w * p * (1 - p))

        def grow(members, depth):
            total, curve = sum(g[i] for i in members), sum(h[i] for i in members)
            best = (1e-9, None, None)
            if depth < fit.depth and curve >= 2 * trees.LEAST:
                for j in range(len(edges)):
                    for cut in range(len(edges[j])):
                        left = [i for i in members if coded[i][j] <= cut]
                        gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                        if hl < trees.LEAST or curve - hl < trees.LEAST:
                            continue
                        gain = gl**2 / (hl + 1) + (total - gl) ** 2 / (curve - hl + 1) - total**2 / (curve + 1)
                        if gain > best[0] + 1e-9:
                            best = (gain, j, cut)
            if best[1] is None:
                return {"value": -fit.step * total / (curve + 1)}
            _, j, cut = best
            return {
                "feature": j, "cut": cut,
                "sides": [grow([i for i in members if (coded[i][j] <= cut) == side], depth + 1) for side in (True, False)],
            }

        tree = grow(list(range(len(rows))), 0)
        for i, codes in enumerate(coded):
            node = tree
            while "value" not in node:
                node = node["sides"][int(codes[node["feature"]] > node["cut"])]
            score[i] += node["value"]
        grown.append(tree)
    return grown, score


FITS = [trees.Fit(3, 0.3, 3, 0), trees.Fit(2, 0.1, 2, 1), trees.Fit(3, 0.3, 4)]


@pytest.mark.parametrize("part_bytes", [trees.PART_BYTES, 700])
def test_trees_are_those_of_plain_python(spark, table, part_bytes, monkeypatch):
    """In one partition (several trees a job) and in three (a job a level, sums meet in a shuffle)."""
    monkeypatch.setattr(trees, "AHEAD", 2)
    monkeypatch.setattr(trees, "CUT", 2)
    monkeypatch.setattr(trees, "NODES", 3)
    rows, df = table
    edges = trees.bin_edges(df, "x", 4, bins=8)
    blocks = trees.coded_blocks(df, "x", ["label", "weight", "fold"], edges)
    forest = trees.Forest(blocks, len(rows), edges, FITS, part_bytes).grow()
    assert (forest.parts == 1) == (part_bytes == trees.PART_BYTES)
    areas = forest.fold_auc()
    x = np.array([r[0] for r in rows])
    for m, fit in enumerate(FITS):
        _, score = plain_trees(rows, edges, fit)
        codes = trees.encode(x, edges)
        assert len(forest.trees[m]) == fit.trees
        mine = sum(t.arrays()[3][trees.descend(codes, t.arrays(), fit.depth)] for t in forest.trees[m])
        assert np.allclose(mine, score, atol=1e-9)
        own = [(1 / (1 + math.exp(-s)), r[1]) for s, r in zip(score, rows) if r[3] == fit.fold]
        if own:
            pairs = [(a > b) + (a == b) / 2 for a, y in own for b, z in own if y == 1 and z == 0]
            assert abs(areas[m] - np.mean(pairs)) < 2e-3
        else:
            assert math.isnan(areas[m])
    forest.release()


def test_model_scores_and_storage(spark, table):
    rows, df = table
    edges = trees.bin_edges(df, "x", 4)
    forest = trees.Forest(trees.coded_blocks(df, "x", ["label", "weight", "fold"], edges), len(rows), edges, [trees.Fit(30, 0.3, 4)]).grow()
    model = trees.BoostedModel(edges, forest.trees[0], 4)
    scored = df.select("label", model.probability(F.col("x")).alias("p")).collect()
    good = [r["p"] for r in scored if r["label"] == 1]
    bad = [r["p"] for r in scored if r["label"] == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.9
    assert abs(model.importances().sum() - 1) < 1e-9 and model.splits().sum() == sum(f >= 0 for t in model.trees for f in t.feature)
    assert model.importances()[2] < model.importances()[0]  # the third feature is noise
    path = scratch_path(spark, "trees")
    model.save(spark, path)
    again = trees.BoostedModel.load(path, spark)
    assert df.select(again.probability(F.col("x")).alias("p")).exceptAll(df.select(model.probability(F.col("x")).alias("p"))).count() == 0


def test_constant_and_missing_values(spark):
    rows = [([1.0, float("nan"), 0.0], float(i % 2), 1.0, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, ROW)
    edges = trees.bin_edges(df, "x", 3)
    blocks = trees.coded_blocks(df, "x", ["label", "weight", "fold"], edges)
    forest = trees.Forest(blocks, len(rows), edges, [trees.Fit(2, 0.1, 3)]).grow()
    assert [len(t.feature) for t in forest.trees[0]] == [1, 1]  # nothing to split on


def test_logistic_fits_are_optimal(spark, table):
    rows, df = table
    fits = [logistic.Penalty(r, f) for r in (1e-6, 1e-3, 1.0) for f in (-1, 0, 1, 2)]
    blocks = logistic.training_blocks(df, "x")
    lines = logistic.fit_lines(blocks, 4, fits)
    areas = logistic.fold_auc(blocks, fits, lines)
    blocks.unpersist()
    x = np.array([[*r[0], 1.0] for r in rows])
    y, w, fold = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
    for fit, line, area in zip(fits, lines, areas):
        use = fold != fit.fold
        p = 1 / (1 + np.exp(-x[use] @ line.weights))
        ridge = np.array([1, 1, 1, 1, 0]) * fit.ridge
        gradient = x[use].T @ (w[use] * (p - y[use])) / w[use].sum() + ridge * line.weights
        assert np.abs(gradient).max() < 1e-6 and line.gradient < 1e-6
        if fit.fold < 0:
            assert math.isnan(area)
        else:
            q, z = x[~use] @ line.weights, y[~use]
            pairs = (q[z == 1][:, None] > q[z == 0]) + (q[z == 1][:, None] == q[z == 0]) / 2
            assert abs(area - pairs.mean()) < 2e-3


def test_separable_rows_end(spark):
    rows = [([float(i)], float(i > 20), 1.0, i % 2) for i in range(40)]
    blocks = logistic.training_blocks(spark.createDataFrame(rows, ROW), "x")
    lines = logistic.fit_lines(blocks, 1, [logistic.Penalty(1e-7), logistic.Penalty(1e-2)])
    assert all(line.gradient < 1e-6 for line in lines)


def test_kmeans_side_by_side(spark):
    """Clear groups are found, costs are those of the labels, and no fit is worse than a plain one of many starts."""
    pick = np.random.default_rng(5)
    x = np.concatenate([pick.normal(c, 0.2, (60, 2)) for c in ((0, 0), (5, 0), (0, 5), (9, 9))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, x array<double>").repartition(5)
    found = fit_kmeans(df, [2, 3, 4, 6], n_init=20, seed=1)
    for k, model in found.items():
        assert isinstance(model, Centers) and model.centers.shape == (k, 2)
        d = ((x[:, None] - model.centers[None]) ** 2).sum(axis=2)
        assert abs(d.min(axis=1).sum() - model.cost) < 1e-6 * max(1, model.cost)
        labels = {r["id"]: r["l"] for r in df.select("id", model.label(F.col("x")).alias("l")).collect()}
        assert [labels[i] for i in range(len(x))] == d.argmin(axis=1).tolist()
    assert found[2].cost > found[3].cost > found[4].cost > found[6].cost
    centers = sorted(tuple(c.round()) for c in found[4].centers)
    assert centers == [(0.0, 0.0), (0.0, 5.0), (5.0, 0.0), (9.0, 9.0)]


def test_kmeans_with_few_distinct_rows(spark):
    """One point that most rows hold, and fewer points than centres."""
    df = spark.createDataFrame([([1.0, 1.0],)] * 50 + [([2.0, 2.0],)] * 3, "x array<double>")
    found = fit_kmeans(df, [2, 4], n_init=5)
    assert found[2].cost == 0 and found[4].cost == 0


def test_kmeans_rows_that_may_change(spark, monkeypatch):
    """Most steps over many rows read only those that may change their cluster, and the fits are those of plain steps."""
    pick = np.random.default_rng(7)
    x = np.concatenate([pick.normal(c, 1.0, (1500, 3)) for c in ((0, 0, 0), (2, 0, 1), (0, 3, 0))])
    cores = spark.sparkContext.defaultParallelism
    df = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").repartition(cores + 1)
    parts, few, real = [], [], clusters._Sums._few
    monkeypatch.setattr(
        clusters._Sums, "_few", lambda self, *a: parts.append(self.blocks.getNumPartitions()) or few.append(self.kept.map(lambda p: 0 if p[1] is None else len(p[1])).sum()) or real(self, *a)
    )
    plain = fit_kmeans(df, [1, 5], n_init=3)
    assert not few
    monkeypatch.setattr(clusters, "PLAIN", 100)
    monkeypatch.setattr(clusters, "MANY", 100)
    found = fit_kmeans(df, [1, 5], n_init=3)
    assert len(few) > 10 and min(few) < len(x) / 2
    assert all(n % cores == 0 for n in parts)  # no core idles while another has one partition more
    for k in plain:
        assert np.allclose(found[k].centers, plain[k].centers, atol=1e-9) and math.isclose(found[k].cost, plain[k].cost, rel_tol=1e-9)


def test_kmeans_split_of_rows():
    """Rows said to stay do so wherever the centres go within their reach; equal and doubled centres keep their order."""
    pick = np.random.default_rng(8)
    x = np.concatenate([pick.integers(-3, 4, (700, 3)).astype(float), pick.normal(0, 2, (700, 3))])
    centers = pick.integers(-3, 4, (6, 4, 3)).astype(float)
    centers[0, 2], centers[1] = centers[0, 1], 0.0
    reach = np.array([0.0, 0.1, 0.0, 0.05, 0.3, 9.0])
    stay, change, open_ = clusters._split_totals(x, centers, reach)
    assert open_[1].all() and open_[5].all() and 0 < open_[3].mean() < 0.9
    rows = np.column_stack([x, np.ones(len(x))])
    for turn in range(20):
        way = pick.normal(size=centers.shape)
        moved = centers + (turn > 0) * way / np.sqrt((way**2).sum(axis=2, keepdims=True)) * reach[:, None, None]
        label = ((x[:, None, None] - moved) ** 2).sum(axis=3).argmin(axis=2)
        for fit in range(6):
            mine = (label[:, fit] == np.arange(4)[:, None]).astype(float)
            assert np.allclose((mine * ~open_[fit]) @ rows, stay[:, fit], atol=1e-9)
            if turn == 0:
                assert np.allclose((mine * open_[fit]) @ rows, change[:, fit], atol=1e-9)
        if turn == 0:
            assert np.allclose(clusters._open_totals(rows, open_, centers), change, atol=1e-9)


def test_sums_of_many_rows(monkeypatch):
    """Bundles of features and parents less siblings give the sums and the trees of a plain pass."""
    pick = np.random.default_rng(3)
    widths = [61, 3, 2, 40, 3, 5]
    codes = np.stack([pick.integers(0, w, 3000) for w in widths], axis=1).astype(np.uint8)
    label = (codes[:, 0] + 20 * codes[:, 1] * codes[:, 2] + pick.normal(0, 9, 3000) > 50).astype(float)
    g, h = pick.normal(size=3000), pick.random(3000)
    columns = trees.Columns(codes, widths)
    rows = np.sort(pick.choice(3000, 2000, replace=False))
    plain = columns.nodes(rows, np.zeros(2000, dtype=np.int64), g[rows], h[rows], 1)[:, 0]
    for many in (1, 1 << 20):  # bundles of up to 4096 cells and of up to 256
        monkeypatch.setattr(trees, "MANY", many)
        assert np.allclose(columns.one_node(rows, g[rows], h[rows]), plain, atol=1e-9)
    monkeypatch.undo()
    assert len(columns.bundled(256)) < len(widths) and len(columns.bundled(4096)) < len(columns.bundled(256))
    grown = []
    for many in (1 << 20, 20):
        monkeypatch.setattr(trees, "MANY", many)
        calls, real = [], trees.Columns.one_node
        monkeypatch.setattr(trees.Columns, "one_node", lambda self, r, *a, f=real, c=calls: c.append(len(r)) or f(self, r, *a))
        part = trees.Part(codes, label, np.ones(3000), np.arange(3000) % 5, np.zeros((3000, 1)), 2.0**40)
        found = trees.grow_here(part, trees.Columns(codes, widths), 0, trees.Fit(4, 0.3, 5, 2), 4)
        grown.append((found, part.score[:, 0]))
        monkeypatch.setattr(trees.Columns, "one_node", real)
        assert bool(calls) == (many == 20)
        if calls:
            nodes = sum(len(t.value) for t in found)
            assert len(calls) < nodes * 0.75  # of two siblings only the smaller is read
    assert grown[0][0] == grown[1][0] and (grown[0][1] == grown[1][1]).all()


def test_equal_gains_of_many_rows(spark, monkeypatch):
    """Features that part the rows alike: the first one is split, in any order and partitioning of the rows."""
    monkeypatch.setattr(trees, "PLAIN", 100)
    rows = [([x[0], x[3], x[0] ** 3, 2.0 * x[3], x[1]], y, w / 3, f) for x, y, w, f in rows_of(500)]
    grown = []
    for order, part_bytes in ((rows, trees.PART_BYTES), (rows[::-1], trees.PART_BYTES), (rows, 900)):
        df = spark.createDataFrame(order, ROW).repartition(3)
        edges = trees.bin_edges(df, "x", 5, bins=8)
        blocks = trees.coded_blocks(df, "x", ["label", "weight", "fold"], edges)
        forest = trees.Forest(blocks, 500, edges, [trees.Fit(3, 0.3, 5, 1)], part_bytes).grow()
        grown.append(forest.trees[0])
        forest.release()
    assert grown[0] == grown[1] == grown[2]
    assert not {2, 3} & {f for tree in grown[0] for f in tree.feature}


def test_one_partition_for_a_million_rows(spark):
    """A task a fit, so that cores do not wait for the group with most trees; the rows stay one partition up to 32 MB of codes."""
    edges = [np.arange(3.0)] * 32
    rows = spark.createDataFrame([([0.0] * 32, 1.0, 1.0, 0)], ROW)
    blocks = trees.coded_blocks(rows, "x", ["label", "weight", "fold"], edges)
    few = trees.Forest(blocks, 720_000, edges, [trees.Fit(2, 0.1, 2)] * 30)
    assert few.parts == 1 and sum(map(len, few.members)) == 30
    assert len(few.members) * 720_000 * 64 <= trees.COPIES
    many = trees.Forest(blocks, 4_300_000, edges, [trees.Fit(2, 0.1, 2)])
    assert many.parts == 5


def test_trees_of_folds_stay_with_the_executors(spark, table, monkeypatch):
    """The driver gets the trees that are asked for only, the scores of all fits are as before; a tree is typed arrays."""
    monkeypatch.setattr(trees, "AHEAD", 2)
    rows, df = table
    edges = trees.bin_edges(df, "x", 4, bins=8)
    blocks = trees.coded_blocks(df, "x", ["label", "weight", "fold"], edges)
    for part_bytes in (trees.PART_BYTES, 700):
        whole = trees.Forest(blocks, len(rows), edges, FITS, part_bytes).grow()
        some = trees.Forest(blocks, len(rows), edges, FITS, part_bytes, keep=[2]).grow()
        assert [len(t) for t in some.trees] == [0, 0, 3] and some.trees[2] == whole.trees[2]
        assert some.fold_auc()[:2] == whole.fold_auc()[:2]
        whole.release()
        some.release()
    assert all(column.itemsize <= 8 for column in (whole.trees[2][0].feature, whole.trees[2][0].value))


def test_many_fits_take_whole_rows(spark):
    """A task a fit, without a shuffle a level, for many fits over some partitions' worth of codes; all end in the same job."""
    edges = [np.arange(3.0)] * 32
    rows = spark.createDataFrame([([0.0] * 32, 1.0, 1.0, 0)] * 2, ROW)
    blocks = trees.coded_blocks(rows, "x", ["label", "weight", "fold"], edges)
    fits = [trees.Fit(n, 0.1, 2) for n in (200, 300, 500) for _ in range(6)]
    forest = trees.Forest(blocks, 4_300_000, edges, fits)
    assert forest.parts == 1 and len(forest.members) == 18
    assert trees.Forest(blocks, 4_300_000, edges, fits[:9]).parts == 5
    assert trees.Forest(blocks, 9_000_000, edges, fits).parts > trees.WHOLE


def test_cells_lie_bin_by_bin():
    """The cuts of nodes against feature by feature, with empty bins and equal gains."""
    pick = np.random.default_rng(4)
    widths = [3, 1, 7, 3, 5]
    columns = trees.Columns(np.zeros((1, 5), dtype=np.uint8), widths)
    sums = np.zeros((2, 19, 40))
    nodes = []
    for n in range(40):
        parts = [(pick.integers(-9, 9, w).astype(float), pick.integers(0, 3, w).astype(float)) for w in widths]
        for k in (0, 1):  # all features of a node have the same rows, and the fourth parts them like the first
            parts = [(g, h) if f != 3 else parts[0] for f, (g, h) in enumerate(parts)]
        nodes.append(parts)
        for f, part in enumerate(parts):
            for k in (0, 1):
                sums[k, columns.cells.of[f], n] = part[k]
    with np.errstate(all="ignore"):  # the made-up sums of a node differ from feature to feature
        splits = trees.best_splits(sums, widths)
    for parts, (gain, f, b, gl, hl, g, h) in zip(nodes, splits):
        total, curve = (part.sum() for part in parts[0])
        assert (g, h) == (total, curve)
        best = (-math.inf, 0, 0)
        for j, (x, y) in enumerate(parts):
            for c in range(len(x)):
                a, z = x[: c + 1].sum(), y[: c + 1].sum()
                if y[c] > 0 and z >= 1 and curve - z >= 1:
                    value = a * a / (z + 1) + (total - a) ** 2 / (curve - z + 1) - total**2 / (curve + 1)
                    if value > best[0] + 1e-12:
                        best = (value, j, c)
        if best[0] == -math.inf:
            assert gain == -math.inf
        else:
            assert math.isclose(gain, best[0], abs_tol=1e-9) and (f, b) == best[1:] and f != 3
            assert (gl, hl) == tuple(part[: b + 1].sum() for part in parts[f])


def test_scores_and_stored_trees_are_those_of_a_plain_walk(spark, table):
    """Rows fall through the columns as through `descend`; a stored model has the same trees, of any sizes."""
    rows, df = table
    edges = trees.bin_edges(df, "x", 4)
    codes = trees.encode(np.array([r[0] for r in rows]), edges)
    blocks = trees.coded_blocks(df, "x", ["label", "weight", "fold"], edges)
    grown = trees.Forest(blocks, len(rows), edges, [trees.Fit(6, 0.3, 5)]).grow().trees[0] + [trees.Tree()]
    columns = trees.Columns(codes, [len(e) + 1 for e in edges])
    for tree in grown:
        for depth in (0, 2, 5):
            assert (columns.fall(np.arange(500), tree.arrays(), depth) == trees.descend(codes, tree.arrays(), depth)).all()
    path = scratch_path(spark, "trees")
    trees.BoostedModel(edges, grown, 5).save(spark, path)
    again = trees.BoostedModel.load(path, spark)
    assert again.trees == grown and again.depth == 5 and len(grown[-1].value) == 1


def test_fits_advance_in_step(spark, table, monkeypatch):
    """Every fit takes its share of trees in every job."""
    rows, df = table
    edges = trees.bin_edges(df, "x", 4, bins=4)
    forest = trees.Forest(trees.coded_blocks(df, "x", ["label", "weight", "fold"], edges), len(rows), edges, [trees.Fit(7, 0.1, 2), trees.Fit(3, 0.1, 2)])
    monkeypatch.setattr(trees, "AHEAD", 3)
    jobs, real = [], trees.Forest._rounds_here
    monkeypatch.setattr(trees.Forest, "_rounds_here", lambda self, wanted: jobs.append(wanted) or real(self, wanted))
    forest.grow()
    assert jobs == [{0: 3, 1: 1}, {0: 2, 1: 1}, {0: 2, 1: 1}] and [len(t) for t in forest.trees] == [7, 3]


def test_cluster_totals_of_many_fits():
    """Sums of all fits against row by row, with equal centres and equal distances: the first centre has the row."""
    pick = np.random.default_rng(8)
    x = np.concatenate([pick.normal(size=(1100, 3)), np.zeros((5, 3))])
    centers = pick.normal(size=(7, 4, 3))
    centers[1, 2] = centers[1, 0]
    centers[2, :2] = [[1, 0, 0], [-1, 0, 0]]
    centers[2, 2:] = 50
    cost, count, total = clusters._cluster_totals(x, centers, True)
    for a, b in zip((cost, count, total), clusters._counted_totals(x, centers, True)):
        assert np.allclose(a, b)
    d = ((x[:, None, None] - centers[None]) ** 2).sum(axis=3)
    label = d.argmin(axis=2)
    assert np.allclose(cost, d.min(axis=2).sum(axis=0))
    for f in range(7):
        for j in range(4):
            assert count[f, j] == (label[:, f] == j).sum()
            assert np.allclose(total[f, j], x[label[:, f] == j].sum(axis=0))
    assert count[1, 2] == 0 and (count.sum(axis=1) == len(x)).all()
    assert np.allclose(clusters._cluster_totals(x, centers, False)[0], cost)
