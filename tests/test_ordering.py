"""Ranks, totals and quantiles against brute force, over several partitions and with hot values."""

import random

import numpy as np
import pytest

from patronage.operators.ordering import (
    exact_quantiles,
    global_rank,
    pick_places,
    quantile_table,
    quintile_bounds,
    quintile_of_rank,
    quintile_places,
    rank_features,
    running_totals,
    value_quantiles,
)
from pyspark.sql import functions as F


@pytest.fixture(autouse=True, params=["true", "false"])
def partitions(spark, request):
    """With and without merging small partitions: one partition or several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param)
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def table(spark, n=1000, seed=1):
    """A third of all rows share one value."""
    draw = random.Random(seed)
    rows = [(i, "ab"[draw.random() < 0.3], 5.0 if i % 3 == 0 else float(draw.randint(0, 40))) for i in range(n)]
    draw.shuffle(rows)
    return rows, spark.createDataFrame(rows, "id long, grp string, v double").repartition(6)


def test_global_rank(spark):
    rows, df = table(spark)
    expected = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    got = {r["id"]: (r["rank"], r["total"]) for r in global_rank(df, ["v", "id"]).collect()}
    assert got == {k: (rank, len(rows)) for k, rank in expected.items()}


def test_rank_within_groups(spark):
    rows, df = table(spark)
    for group in "ab":
        members = sorted((r for r in rows if r[1] == group), key=lambda r: (r[2], r[0]))
        got = {r["id"]: r["rank"] for r in global_rank(df, ["v", "id"], ["grp"]).where(F.col("grp") == group).collect()}
        assert got == {r[0]: i + 1 for i, r in enumerate(members)}


def test_running_totals(spark):
    rows, df = table(spark)
    counted = df.groupBy("grp", "v").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))
    got = {(r["grp"], r["v"]): r for r in running_totals(counted, ["v"], ["n", "ids"], ["grp"]).collect()}
    for (group, value), row in got.items():
        below = [r for r in rows if r[1] == group and r[2] < value]
        members = [r for r in rows if r[1] == group]
        assert row["n_before"] == len(below) and row["ids_before"] == sum(r[0] for r in below)
        assert row["n_total"] == len(members) and row["ids_total"] == sum(r[0] for r in members)
        assert row["position"] == len({r[2] for r in below}) + 1


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 60000])
def test_quantiles_equal_numpy(spark, n):
    rows, df = table(spark, n)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    values = [r[2] for r in rows]
    expected = [float(np.quantile(values, p)) for p in probs]
    assert exact_quantiles(df, ["v"], probs)["v"] == expected
    for frame in (quantile_table(rank_features(df, ["id"], ["v"]), probs), value_quantiles(df, ["v"], probs)):
        row = frame.first()
        assert [row[f"q{i}"] for i in range(len(probs))] == expected


def test_nulls_do_not_count(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0), (3, 6.0)], "id long, v double")
    assert exact_quantiles(df, ["v"], [0.5])["v"] == [5.0]


@pytest.mark.parametrize("n,expected", [(6, [1, 1, 2, 3, 4, 5]), (10, [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]), (1, [1])])
def test_quintiles_of_rank(spark, n, expected):
    df = spark.createDataFrame([(i, 1.0) for i in range(n)], "id long, v double")
    ranked = rank_features(df, ["id"], ["v"])
    bounds = quintile_bounds(pick_places(ranked, ["id"], quintile_places())["v"])
    scores = df.select("id", quintile_of_rank(F.col("v"), F.col("id"), bounds).alias("s")).orderBy("id").collect()
    assert [r["s"] for r in scores] == expected


def test_quintile_sizes_differ_by_one(spark):
    rows, df = table(spark, 997)
    ranked = rank_features(df, ["id"], ["v"])
    bounds = quintile_bounds(pick_places(ranked, ["id"], quintile_places())["v"])
    sizes = [r["count"] for r in df.groupBy(quintile_of_rank(F.col("v"), F.col("id"), bounds)).count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_rows_at_places_of_many_ties(spark, monkeypatch):
    """One value that half of the rows hold, nulls, nan, text keys: the rows of a full sort, by narrowing."""
    import math

    from patronage.operators import ordering

    monkeypatch.setattr(ordering, "FEW", 200)
    monkeypatch.setattr(ordering, "SAMPLED", 150)
    pick = random.Random(8)
    rows = [(f"k{i:05d}", 3.0 if i % 2 else round(pick.gauss(0, 4), 1)) for i in range(3000)]
    rows += [(f"n{i}", None) for i in range(40)] + [("x", math.nan), ("y", math.inf), ("z", -math.inf)]
    df = spark.createDataFrame(rows, "key string, v double").repartition(4).cache()
    order = sorted(((v, k) for k, v in rows if v is not None), key=lambda r: (math.isnan(r[0]), r[0] if not math.isnan(r[0]) else 0, r[1]))
    total = len(order)
    places = sorted({0, 1, total - 1, total - 2, *(total * i // 4 for i in range(4))})
    groups = lambda n: [[p, min(p + 1, n - 1)] for p in places]
    found = ordering.rows_at_places(df, {"pair": (["v", "key"], groups), "value": (["v"], groups), "none": (["v"], lambda n: [])})
    assert found["pair"].pop(-1) == (total,) and found["value"].pop(-1) == (total,) and found["none"] == {-1: (total,)}
    assert set(found["pair"]) == {min(p + d, total - 1) for p in places for d in (0, 1)}
    for place, row in found["pair"].items():
        assert repr(row) == repr(order[place])
    for place, row in found["value"].items():
        assert repr(row) == repr(order[place][:1])


def test_two_values_and_no_values(spark, monkeypatch):
    from patronage.operators import ordering

    monkeypatch.setattr(ordering, "FEW", 10)
    monkeypatch.setattr(ordering, "SAMPLED", 20)
    df = spark.range(1000).selectExpr("id AS key", "CAST(id % 2 AS DOUBLE) AS v", "CAST(NULL AS DOUBLE) AS w")
    found = ordering.rows_at_places(df, {"v": (["v"], lambda n: [[499, 500]]), "w": (["w"], lambda n: [[0]])})
    assert found == {"v": {-1: (1000,), 499: (0.0,), 500: (1.0,)}}
    assert ordering.exact_quantiles(df, ["v", "w"], [0.5]) == {"v": [0.5]}


def test_scores_do_not_exchange_the_table_by_range(spark, monkeypatch):
    from patronage.operators import ordering
    from patronage.operators.customers import add_rfm_scores

    monkeypatch.setattr(ordering, "FEW", 2000)
    rows = [(i, i % 90, 1 if i % 2 else i % 7, float(i % 2) or i / 3) for i in range(9000)]
    df = spark.createDataFrame(rows, "customer_id long, recency_days long, frequency long, total_spent double").cache()
    scored = add_rfm_scores(df, tiers=True)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Exchange" not in plan
    n = len(rows)
    for column, score in (("frequency", "F_score"), ("total_spent", "M_score")):
        at = 2 if column == "frequency" else 3
        order = sorted(rows, key=lambda r: (r[at], r[0]))
        expected = {r[0]: max(1, -(-(k * 5) // (n - 1))) for k, r in enumerate(order)}
        assert {r["customer_id"]: r[score] for r in scored.collect()} == expected
