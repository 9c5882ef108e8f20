"""Churn modelling from the feature table to the dashboard bundle."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from patronage.functions.expressions import round_half_even
from patronage.operators import churn, customers, evaluation, models, segments
from patronage.operators.models import Prepared, Trained
from patronage.session import materialize
from patronage.sources import files
from patronage.sources.shop import Shop


def _records(df: DataFrame, order: Sequence[str]) -> Column:
    """A small report as an array of structs, in the given order."""
    rows = df.agg(F.sort_array(F.collect_list(F.struct(F.struct(*order).alias("_key"), F.struct(*df.columns).alias("row")))).alias("rows"))
    return rows.select(F.transform("rows", lambda r: r["row"])).scalar()


def dashboard_bundle(
    shop: Shop, prepared: Prepared, trained: Sequence[Trained], tuned: Trained, generated_at: str | None = None
) -> DataFrame:
    """One JSON document with all dashboard tables; every part is a report of a few rows."""
    spark = prepared.data.sparkSession
    comparison = materialize(models.model_comparison([*trained, tuned], prepared))
    test = materialize(models.score_customers(tuned, prepared).where(F.col("split") == "test"))
    importance = segments.top_features(models.feature_importance(tuned, prepared, spark), 30)
    sweep = evaluation.threshold_sweep(test)
    labels = churn.churn_labels(shop.orders)
    spend = materialize(customers.spend_base(shop.orders, shop.items))
    tiers = segments.segment_churn(customers.value_segments(spend), labels)
    impact = evaluation.business_impact(test).drop("roi")
    compared = comparison.select(
        F.col("model").alias("name"),
        *(round_half_even(F.col(c), 3).alias(c) for c in ("trainAUC", "valAUC", "testAUC")),
        round_half_even(F.col("testF1"), 3).alias("f1"),
    )
    history = models.trial_history(spark, tuned).select("trial", round_half_even(F.col("auc"), 3).alias("auc"))
    stamp = generated_at or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    parts = {
        "generatedAt": F.lit(stamp),
        "modelComparison": _records(compared, ["name"]),
        "featureImportance": _records(
            importance.select("feature", "importance", (-F.col("importance")).alias("place")), ["place", "feature"]
        ),
        "optimizationHistory": _records(history, ["trial"]),
        "thresholdOptimization": _records(evaluation.threshold_report(test), ["threshold"]),
        "recommendedThreshold": evaluation.best_threshold(sweep).select("threshold").scalar(),
        "riskSegmentation": _records(evaluation.risk_segmentation(test), ["name"]),
        "businessImpact": impact.select(F.struct(*impact.columns)).scalar(),
        "monthlyMetrics": _records(churn.monthly_churn(shop.orders), ["month"]),
        "customerSegments": _records(tiers, ["name"]),
    }
    single = spark.range(1).select(*(value.alias(name) for name, value in parts.items()))
    return single.select(F.to_json(F.struct(*parts)).alias("bundle"))


def run(
    shop: Shop,
    output: str,
    trials: int = models.TRIALS,
    folds: int = 5,
    logistic_grid: Sequence[float] = models.LOGISTIC_GRID,
    gbt_grid: Sequence[dict] = models.GBT_GRID,
    ranges: dict = models.SEARCH_RANGES,
) -> Trained:
    """Train the baselines, tune the best kind, write results, importances, model and bundle."""
    dataset = materialize(churn.churn_dataset(shop))
    prepared = models.prepare(dataset)
    spark = dataset.sparkSession
    baselines = [
        models.train_logistic(prepared, logistic_grid, folds),
        models.train_gbt(prepared, gbt_grid, folds),
    ]
    best = models.model_comparison(baselines, prepared).where(F.col("is_best") == 1).first()["model"]
    tuned = models.tune_model(prepared, best, trials, ranges=ranges)
    files.write_csv(models.model_comparison([*baselines, tuned], prepared), f"{output}/model_results")
    files.write_csv(models.feature_importance(tuned, prepared, spark), f"{output}/feature_importance")
    models.save_model(tuned, f"{output}/model")
    bundle = dashboard_bundle(shop, prepared, baselines, tuned)
    bundle.write.mode("overwrite").text(f"{output}/dashboard")
    return tuned
