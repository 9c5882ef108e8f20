from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.functions.expressions import rounded
from patronage.operators import churn, evaluation as ops
from patronage.queries.churn import SCALED, monthly_churn, scaling_input
from patronage.session import materialize
from patronage.sources.shop import load_scored, load_shop

SPLIT = ("split",)


def over_scores(operator, **options):
    """Query that applies an operator to the scored table, per split."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(operator(load_scored(spark, sf_dir), within=SPLIT, **options))

    return query


def risk_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.risk_segmentation(load_scored(spark, sf_dir))


def recommended_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = load_scored(spark, sf_dir)
    report = ops.threshold_report(scored, SPLIT)
    best = ops.best_threshold(ops.threshold_sweep(scored, SPLIT), SPLIT)
    return rounded(ops.recommended_threshold(report, best, SPLIT))


def churn_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.churn_kpis(risk_whole(spark, sf_dir), monthly_churn(spark, sf_dir)))


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = churn.stratified_split(churn.churn_labels(load_shop(spark, sf_dir).orders))
    return rounded(ops.class_weights(labels.where(F.col("split") == "train")))


def precision_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.precision_at_share(load_scored(spark, sf_dir), "id", 0.2, SPLIT))


def weekly_auc_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = load_shop(spark, sf_dir).orders.select(
        F.col("order_id").alias("id"), F.date_trunc("week", "order_purchase_timestamp").alias("week")
    )
    return rounded(ops.weekly_auc_alert(load_scored(spark, sf_dir).join(dates, "id")))


def psi_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = scaling_input(spark, sf_dir)
    base, current = (materialize(data.where(F.col("split") == s)) for s in ("train", "test"))
    return rounded(ops.psi_drift(base, current, "customer_id", SCALED))


QUERIES = {
    "roc_auc": over_scores(ops.roc_auc),
    "average_precision": over_scores(ops.average_precision),
    "roc_curve": over_scores(ops.roc_curve),
    "pr_curve": over_scores(ops.pr_curve),
    "classification_metrics": over_scores(ops.classification_metrics),
    "confusion_matrix": over_scores(ops.confusion_matrix),
    "model_metrics_by_split": over_scores(ops.model_metrics),
    "calibration_curve": over_scores(ops.calibration_curve),
    "score_histogram": over_scores(ops.score_histogram),
    "threshold_curve": over_scores(ops.threshold_curve),
    "threshold_sweep": over_scores(ops.threshold_sweep),
    "threshold_report": over_scores(ops.threshold_report),
    "threshold_options": over_scores(ops.threshold_options),
    "risk_segmentation": over_scores(ops.risk_segmentation),
    "business_impact": over_scores(ops.business_impact),
    "recommended_threshold": recommended_threshold,
    "churn_kpis": churn_kpis,
    "class_weights": class_weights,
    "precision_at_k": precision_at_k,
    "weekly_auc_alert": weekly_auc_alert,
    "psi_drift": psi_drift,
}
