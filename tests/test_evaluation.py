import math
import random

import pytest
from pyspark.sql import functions as F

from patronage.operators import evaluation as ev


@pytest.fixture(scope="module")
def cases():
    draw = random.Random(3)
    rows = []
    for i in range(600):
        y = int(draw.random() < 0.4)
        rows.append((i, y, round(min(1.0, max(0.0, draw.gauss(0.35 + 0.25 * y, 0.2))), 2), "ab"[i % 2]))
    return rows


@pytest.fixture(scope="module")
def scored(spark, cases):
    return spark.createDataFrame(cases, "id long, y int, p double, split string").repartition(5).persist()


def test_auc_counts_pairs(scored, cases):
    got = {r["split"]: r["auc"] for r in ev.roc_auc(scored, ["split"]).collect()}
    for split in "ab":
        pos = [p for _, y, p, s in cases if y and s == split]
        neg = [p for _, y, p, s in cases if not y and s == split]
        wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        assert math.isclose(got[split], wins / (len(pos) * len(neg)), rel_tol=1e-12)


def test_average_precision(scored, cases):
    total, recall_before = 0.0, 0.0
    positives = sum(y for _, y, _, _ in cases)
    for t in sorted({p for _, _, p, _ in cases}, reverse=True):
        chosen = [y for _, y, p, _ in cases if p >= t]
        recall = sum(chosen) / positives
        total += (recall - recall_before) * sum(chosen) / len(chosen)
        recall_before = recall
    assert math.isclose(ev.average_precision(scored).first()["avg_precision"], total, rel_tol=1e-12)


def test_roc_curve_ends_and_area(scored):
    points = sorted(ev.roc_curve(scored).collect(), key=lambda r: -r["threshold"])
    assert (points[0]["threshold"], points[0]["fpr"], points[0]["tpr"]) == (math.inf, 0.0, 0.0)
    assert (points[-1]["fpr"], points[-1]["tpr"]) == (1.0, 1.0)
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(points, points[1:]))
    assert math.isclose(area, ev.roc_auc(scored).first()["auc"], rel_tol=1e-9)
    assert len(points) <= ev.roc_curve(scored, drop_intermediate=False).count()


def test_threshold_counts_are_brute_force_counts(scored, cases):
    rows = ev.threshold_counts(scored, ev.SWEEP).collect()
    assert len(rows) == 91
    for r in rows:
        t = r["threshold"]
        assert r["tp"] == sum(y for _, y, p, _ in cases if p >= t)
        assert r["fp"] == sum(1 - y for _, y, p, _ in cases if p >= t)
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == len(cases)
    recalls = [r["recall"] for r in sorted(ev.threshold_curve(scored).collect(), key=lambda r: r["threshold"])]
    assert recalls == sorted(recalls, reverse=True)


def test_published_net_benefit(spark):
    """The worked example: 6044 hits, 1129 false alarms, 1003 misses."""
    counts = spark.createDataFrame([(6044, 1129, 1003, 1769)], "tp long, fp long, fn long, tn long")
    assert counts.select(ev.net_benefit().cast("bigint")).first()[0] == 1_630_502
    assert math.isclose(ev.DEFAULT_ASSUMPTIONS.lifetime_value, 560.7)
    rates = ev.with_rates(counts).first()
    assert (round(rates["precision"], 3), round(rates["recall"], 3), round(rates["f1"], 3)) == (0.843, 0.858, 0.85)


def test_published_negative_benefit_is_cut_towards_zero(spark):
    counts = spark.createDataFrame([(3869, 5, 3178, 2893)], "tp long, fp long, fn long, tn long")
    assert counts.select(ev.net_benefit().cast("bigint")).first()[0] == -360_210


def test_score_on_a_calibration_edge_belongs_below(spark):
    df = spark.createDataFrame([(1, 0, 0.1), (2, 1, 0.11), (3, 1, 1.0), (4, 0, 0.0)], "id int, y int, p double")
    assert {r["bin"]: r["customers"] for r in ev.calibration_curve(df).collect()} == {0: 2, 1: 1, 9: 1}


def test_histogram_is_a_density(scored):
    for y in (0, 1):
        rows = ev.score_histogram(scored).where(F.col("y") == y).collect()
        widths = sorted(r["lower"] for r in rows)
        assert max(r["bin"] for r in rows) == 49 and min(r["bin"] for r in rows) == 0
        n = sum(r["customers"] for r in rows)
        width = rows[0]["customers"] / (n * rows[0]["density"])
        assert math.isclose(sum(r["density"] * width for r in rows), 1.0, rel_tol=1e-9) and widths


def test_empty_tier_gets_the_assumed_rate(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.8)], "id int, y int, p double")
    rows = {r["name"]: (r["count"], r["percentage"], r["churnRate"]) for r in ev.risk_segmentation(df).collect()}
    assert rows == {"High Risk": (20, 100.0, 0.5), "Medium Risk": (0, 0.0, 0.34), "Low Risk": (0, 0.0, 0.08)}


def test_options_prefer_the_middle_on_ties(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.1)], "id int, y int, p double")
    best = [r["threshold"] for r in ev.threshold_options(df).collect() if r["recommended"]]
    assert best == [0.5]


def test_recommended_row_comes_from_the_report(scored):
    report = ev.threshold_report(scored)
    best = ev.best_threshold(ev.threshold_sweep(scored))
    row = ev.recommended_threshold(report, best).first()
    assert row["threshold"] == best.first()["threshold"]
    assert row["precision"] == row["truePositives"] / (row["truePositives"] + row["falsePositives"])


def test_identical_samples_do_not_drift(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 37).cast("double").alias("x"))
    assert abs(ev.psi_drift(df, df, "id", ["x"]).first()["psi"]) < 1e-12
    moved = df.withColumn("x", F.col("x") + 30)
    assert ev.psi_drift(df, moved, "id", ["x"]).first()["alert"] == 1
