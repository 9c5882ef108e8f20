"""Evaluation and decision tables from scored customers (id, y, p and grouping columns).

Scores are counted per distinct value or per threshold interval first. Curves then run
over distinct scores in parallel, threshold tables over a fixed handful of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.functions.expressions import cascade, count_if, ratio, round_half_even
from patronage.operators.ordering import exact_quantiles, next_after, running_totals, thresholds_between, unpivot, value_quantiles


@dataclass(frozen=True)
class Assumptions:
    """Money per customer used to price a decision."""

    avg_order_value: float = 89
    annual_orders: float = 4.2
    lifetime_months: float = 18
    retention_cost: float = 25
    success_rate: float = 0.7
    base_factor: int = 10

    @property
    def lifetime_value(self) -> float:
        return self.avg_order_value * self.annual_orders * (self.lifetime_months / 12)


DEFAULT_ASSUMPTIONS = Assumptions()
SWEEP = thresholds_between(0.05, 0.95, 91)
CURVE = thresholds_between(0.0, 1.0, 100)
# fixed values: the three-way comparison prices a customer differently from the sweep
OPTION_THRESHOLDS = (0.3, 0.5, 0.7)
OPTION_VALUE, OPTION_COST, OPTION_SUCCESS = 500, 50, 0.3
# fixed values: name, lower bound, churn rate assumed for an empty tier, colour
RISK_TIERS = (
    ("High Risk", 0.7, 0.87, "#ef4444"),
    ("Medium Risk", 0.3, 0.34, "#f59e0b"),
    ("Low Risk", -math.inf, 0.08, "#10b981"),
)


# ---- curves over distinct scores -----------------------------------------------------------


def score_counts(scored: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    return scored.groupBy(*within, "p").agg(
        F.sum(F.col("y").cast("bigint")).alias("pos"), F.sum(1 - F.col("y").cast("bigint")).alias("neg")
    )


def score_curve(scored: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Distinct scores with the cases at or above (`tp`, `fp`) and strictly below each."""
    curve = running_totals(score_counts(scored, within), ["p"], ["pos", "neg"], within)
    return curve.withColumns(
        {"tp": F.col("pos_total") - F.col("pos_before"), "fp": F.col("neg_total") - F.col("neg_before")}
    )


def _auc(curve_pos: Column, neg: Column, neg_before: Column, positives: Column, negatives: Column) -> Column:
    below = F.sum(curve_pos * (neg_before + neg * 0.5))
    return below / F.nullif(F.max(positives).cast("double") * F.max(negatives), F.lit(0.0))


def ranking_metrics(scored: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve (ties count half) and average precision."""
    curve = score_curve(scored, within)
    return curve.groupBy(*within).agg(
        _auc(F.col("pos"), F.col("neg"), F.col("neg_before"), F.col("pos_total"), F.col("neg_total")).alias("auc"),
        F.sum(F.col("pos") / F.nullif(F.col("pos_total"), F.lit(0)) * F.col("tp") / (F.col("tp") + F.col("fp"))).alias(
            "avg_precision"
        ),
    )


def roc_auc(scored: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    auc = ranking_metrics(scored, within).drop("avg_precision")
    return auc.withColumn("rating", auc_rating(F.col("auc")))


def auc_rating(auc: Column) -> Column:
    return cascade([(auc > 0.85, F.lit("Excellent")), (auc > 0.75, F.lit("Good"))], F.lit("Fair"))


def average_precision(scored: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(scored, within).drop("auc")


def roc_curve(scored: DataFrame, within: Sequence[str] = (), drop_intermediate: bool = True) -> DataFrame:
    """Points (threshold, fpr, tpr), starting at an infinite threshold.

    A point on the straight line between its neighbours is dropped: the next lower score
    has the same counts.
    """
    within = list(within)
    curve = score_curve(scored, within)
    if drop_intermediate:
        lower = curve.select(
            *within,
            (F.col("position") + 1).alias("position"),
            F.col("pos").alias("_pos"),
            F.col("neg").alias("_neg"),
        )
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        bend = F.col("_pos").isNull() | (F.col("_pos") != F.col("pos")) | (F.col("_neg") != F.col("neg"))
        curve = curve.join(lower, [*within, "position"], "left").where(first | bend)
    points = curve.select(
        *within,
        F.col("p").alias("threshold"),
        (F.col("fp") / F.col("neg_total")).alias("fpr"),
        (F.col("tp") / F.col("pos_total")).alias("tpr"),
    )
    start = scored.groupBy(*within).agg(F.lit(math.inf).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def pr_curve(scored: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Points (threshold, precision, recall), ending at precision 1 and recall 0."""
    within = list(within)
    points = score_curve(scored, within).select(
        *within,
        F.col("p").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(F.col("pos_total") == 0, 1.0).otherwise(F.col("tp") / F.nullif(F.col("pos_total"), F.lit(0))).alias("recall"),
    )
    end = scored.groupBy(*within).agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


# ---- counts at one threshold ---------------------------------------------------------------


def confusion_counts(scored: DataFrame, within: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    chosen, churned = F.col("p") >= threshold, F.col("y") == 1
    return scored.groupBy(*within).agg(
        count_if(chosen & churned).alias("tp"),
        count_if(chosen & ~churned).alias("fp"),
        count_if(~chosen & churned).alias("fn"),
        count_if(~chosen & ~churned).alias("tn"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from counts, 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)}
    )


def classification_metrics(scored: DataFrame, within: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    counts = with_rates(confusion_counts(scored, within, threshold))
    right = F.col("tp") + F.col("tn")
    return counts.withColumn("accuracy", ratio(right, right + F.col("fp") + F.col("fn")))


def confusion_matrix(scored: DataFrame, within: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """Four cells, each with its share of the actual class."""
    cells = [("tn", 0, 0, "fp"), ("fp", 0, 1, "tn"), ("fn", 1, 0, "tp"), ("tp", 1, 1, "fn")]
    entries = [
        F.struct(
            F.lit(actual).alias("actual"),
            F.lit(predicted).alias("predicted"),
            F.col(name).alias("customers"),
            ratio(F.col(name), F.col(name) + F.col(other)).alias("share"),
        )
        for name, actual, predicted, other in cells
    ]
    return confusion_counts(scored, within, threshold).select(*within, F.inline(F.array(*entries)))


def model_metrics(scored: DataFrame, within: Sequence[str] = ("split",)) -> DataFrame:
    """One row per split: ranking and threshold metrics."""
    return (
        classification_metrics(scored, within)
        .drop("tp", "fp", "fn", "tn")
        .join(ranking_metrics(scored, within), list(within))
    )


def calibration_curve(scored: DataFrame, within: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """Mean score and churn rate per equal-width bin; a score on an edge belongs to the lower bin."""
    edges = thresholds_between(0.0, 1.0, bins + 1)[1:-1]
    binned = _interval(scored, next_after(edges)).withColumnRenamed("_b", "bin")
    return binned.groupBy(*within, "bin").agg(
        F.count("*").alias("customers"), F.avg("p").alias("mean_predicted"), F.avg("y").alias("fraction_positive")
    )


def score_histogram(scored: DataFrame, within: Sequence[str] = (), bins: int = 50) -> DataFrame:
    """Density of the scores of each class over equal-width bins between its extremes.

    The extremes are one row per group and class and are broadcast. The last bin
    includes its upper edge.
    """
    keys = [*within, "y"]
    extremes = scored.groupBy(*keys).agg(
        F.min("p").alias("_low"), F.max("p").alias("_high"), F.count("*").alias("_n")
    )
    low, high = F.col("_low"), F.col("_high")
    width = (high - low) / bins
    guess = F.least(F.floor((F.col("p") - low) * (F.lit(float(bins)) / F.nullif(high - low, F.lit(0.0)))), F.lit(bins - 1))
    guess = F.coalesce(guess, F.lit(0))
    index = (
        F.when(F.col("p") < low + F.col("_g") * width, F.col("_g") - 1)
        .when((F.col("p") >= low + (F.col("_g") + 1) * width) & (F.col("_g") < bins - 1), F.col("_g") + 1)
        .otherwise(F.col("_g"))
    )
    return (
        scored.join(F.broadcast(extremes), keys)
        .withColumn("_g", guess)
        .withColumn("bin", index.cast("int"))
        .groupBy(*keys, "bin", "_low", "_high", "_n")
        .agg(F.count("*").alias("customers"))
        .select(
            *keys,
            "bin",
            "customers",
            (low + F.col("bin") * width).alias("lower"),
            ratio(F.col("customers"), F.col("_n") * width).alias("density"),
        )
    )


# ---- counts at many thresholds -------------------------------------------------------------


def _interval(scored: DataFrame, edges: Sequence[float]) -> DataFrame:
    """Adds `_b`, the number of edges at or below the score."""
    bucketizer = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol="p", outputCol="_b")
    return bucketizer.transform(scored).withColumn("_b", F.col("_b").cast("int"))


def threshold_counts(scored: DataFrame, thresholds: Sequence[float], within: Sequence[str] = ()) -> DataFrame:
    """Confusion counts at every threshold.

    Customers are counted per interval between thresholds; a group then holds at most one
    more cell than there are thresholds, and the counts of a threshold are sums of cells.
    Customers and thresholds are never multiplied.
    """
    within = list(within)
    cells = (
        _interval(scored, thresholds)
        .groupBy(*within, "_b")
        .agg(F.sum(F.col("y").cast("bigint")).alias("pos"), F.sum(1 - F.col("y").cast("bigint")).alias("neg"))
        .groupBy(*within)
        .agg(F.collect_list(F.struct("_b", "pos", "neg")).alias("_cells"))
    )
    steps = cells.select(
        *within, "_cells", F.posexplode(F.array(*(F.lit(float(t)) for t in thresholds))).alias("_i", "threshold")
    )

    def total(field: str, above: bool) -> Column:
        part = F.filter("_cells", lambda c: c["_b"] > F.col("_i") if above else c["_b"] <= F.col("_i"))
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda acc, c: acc + c[field])

    return steps.select(
        *within,
        "threshold",
        total("pos", True).alias("tp"),
        total("neg", True).alias("fp"),
        total("pos", False).alias("fn"),
        total("neg", False).alias("tn"),
    )


def threshold_curve(scored: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 at 100 thresholds from 0 to 1."""
    return with_rates(threshold_counts(scored, CURVE, within)).select(*within, "threshold", "precision", "recall", "f1")


def net_benefit(assumptions: Assumptions = DEFAULT_ASSUMPTIONS) -> Column:
    """Saved revenue minus missed revenue minus the cost of contacting the chosen customers."""
    value = F.lit(assumptions.lifetime_value)
    saved = F.col("tp") * value * assumptions.success_rate
    return saved - F.col("fn") * value - (F.col("tp") + F.col("fp")) * F.lit(assumptions.retention_cost)


def threshold_sweep(
    scored: DataFrame, within: Sequence[str] = (), assumptions: Assumptions = DEFAULT_ASSUMPTIONS
) -> DataFrame:
    """91 thresholds from 0.05 to 0.95 with rates, counts and net benefit."""
    return (
        with_rates(threshold_counts(scored, SWEEP, within))
        .withColumn("net_benefit", net_benefit(assumptions))
        .withColumn("threshold", F.round("threshold", 2))
    )


def best_threshold(sweep: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The row with the highest net benefit per group, the lowest threshold on ties."""
    fields = [c for c in sweep.columns if c not in within]
    return (
        sweep.groupBy(*within)
        .agg(F.max_by(F.struct(*fields), F.struct("net_benefit", -F.col("threshold"))).alias("best"))
        .select(*within, "best.*")
    )


def threshold_report(
    scored: DataFrame, within: Sequence[str] = (), assumptions: Assumptions = DEFAULT_ASSUMPTIONS
) -> DataFrame:
    """The fixed thresholds 0.3 and 0.9 and the best one, labelled for the dashboard."""
    sweep = threshold_sweep(scored, within, assumptions)
    rows = sweep.where(F.col("threshold").isin(0.3, 0.9)).unionByName(best_threshold(sweep, within))
    return rows.select(
        *within,
        "threshold",
        *(round_half_even(F.col(c), 3).alias(c) for c in ("precision", "recall", "f1")),
        F.col("fp").alias("falsePositives"),
        F.col("fn").alias("falseNegatives"),
        F.col("tp").alias("truePositives"),
        F.col("tn").alias("trueNegatives"),
        F.col("net_benefit").cast("bigint").alias("netBenefit"),
        cascade(
            [
                (F.col("threshold") == 0.3, F.lit("Low Threshold")),
                (F.col("threshold") == 0.9, F.lit("High Threshold")),
            ],
            F.lit("Recommended"),
        ).alias("description"),
    )


def recommended_threshold(report: DataFrame, best: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The report row of the best threshold with precision and recall from its counts.

    `report` holds three rows per group; when the best threshold is missing there, the
    lowest one stands in.
    """
    wanted = best.select(*within, F.col("threshold").alias("_best"))
    fields = [c for c in report.columns if c not in within]
    joined = report.join(wanted, list(within)) if within else report.withColumn(
        "_best", best.select("threshold").scalar()
    )
    hit = (F.col("threshold") == F.col("_best")).cast("int")
    row = F.max_by(F.struct(*fields), F.struct(hit, -F.col("threshold")))
    tp, fp, fn = F.col("truePositives"), F.col("falsePositives"), F.col("falseNegatives")
    return (
        joined.groupBy(*within)
        .agg(row.alias("row"))
        .select(*within, "row.*")
        .select(
            *within,
            "threshold",
            "truePositives",
            "falsePositives",
            "falseNegatives",
            "trueNegatives",
            ratio(tp, tp + fp).alias("precision"),
            ratio(tp, tp + fn).alias("recall"),
        )
    )


def threshold_options(scored: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Net benefit at 0.3, 0.5 and 0.7; 0.5 is kept unless another is strictly better."""
    counts = threshold_counts(scored, OPTION_THRESHOLDS, within)
    net = F.col("tp") * OPTION_VALUE * OPTION_SUCCESS - (F.col("tp") + F.col("fp")) * OPTION_COST
    options = counts.withColumn("net_benefit", net)
    preference = F.when(F.col("threshold") == 0.5, 2).when(F.col("threshold") == 0.3, 1).otherwise(0)
    best = options.groupBy(*within).agg(
        F.max_by("threshold", F.struct("net_benefit", preference)).alias("_best")
    )
    joined = options.join(F.broadcast(best), list(within)) if within else options.withColumn(
        "_best", best.select("_best").scalar()
    )
    return joined.withColumn("recommended", (F.col("threshold") == F.col("_best")).cast("int")).drop("_best", "tn")


# ---- business tables -----------------------------------------------------------------------


def risk_tier(p: Column) -> Column:
    (high, high_from, *_), (medium, medium_from, *_), (low, *_) = RISK_TIERS
    return cascade([(p >= high_from, F.lit(high)), (p >= medium_from, F.lit(medium))], F.lit(low))


def risk_segmentation(
    scored: DataFrame, within: Sequence[str] = (), assumptions: Assumptions = DEFAULT_ASSUMPTIONS
) -> DataFrame:
    """Three tiers with size scaled to the customer base, share and actual churn rate."""
    tier = risk_tier(F.col("p"))
    aggregates = [F.count("*").alias("_n")]
    for i, (name, *_rest) in enumerate(RISK_TIERS):
        aggregates += [count_if(tier == name).alias(f"_n{i}"), F.avg(F.when(tier == name, F.col("y"))).alias(f"_r{i}")]
    entries = [
        F.struct(
            F.lit(name).alias("name"),
            (F.col(f"_n{i}") * assumptions.base_factor).alias("count"),
            round_half_even(F.col(f"_n{i}") / F.col("_n") * 100, 1).alias("percentage"),
            round_half_even(F.coalesce(F.col(f"_r{i}"), F.lit(assumed)), 2).alias("churnRate"),
            F.lit(colour).alias("color"),
        )
        for i, (name, _, assumed, colour) in enumerate(RISK_TIERS)
    ]
    return scored.groupBy(*within).agg(*aggregates).select(*within, F.inline(F.array(*entries)))


def business_impact(
    scored: DataFrame, within: Sequence[str] = (), assumptions: Assumptions = DEFAULT_ASSUMPTIONS
) -> DataFrame:
    """Money saved, spent and missed at threshold 0.5, scaled to the customer base."""
    counts = confusion_counts(scored, within)
    return impact_of_counts(counts, within, assumptions)


def impact_of_counts(
    counts: DataFrame, within: Sequence[str] = (), assumptions: Assumptions = DEFAULT_ASSUMPTIONS
) -> DataFrame:
    factor, value = assumptions.base_factor, F.lit(assumptions.lifetime_value)
    tp, fp, fn = (F.col(c) * factor for c in ("tp", "fp", "fn"))
    saved = tp * value * assumptions.success_rate
    cost = (tp + fp) * F.lit(float(assumptions.retention_cost))
    missed = fn * value
    net = saved - cost - missed
    return counts.select(
        *within,
        saved.cast("bigint").alias("revenueSaved"),
        cost.cast("bigint").alias("retentionCosts"),
        missed.cast("bigint").alias("missedRevenue"),
        net.cast("bigint").alias("netBenefit"),
        round_half_even(ratio(net, cost) * 100, 1).alias("roi"),
    )


def churn_kpis(risk: DataFrame, monthly: DataFrame) -> DataFrame:
    """Customers, high-risk customers, and the mean monthly churn rate."""
    return risk.agg(
        F.sum("count").alias("totalCustomers"),
        F.coalesce(F.sum(F.when(F.col("name") == "High Risk", F.col("count"))), F.lit(0)).alias("highRiskCustomers"),
    ).withColumn("avgChurnRate", monthly.agg(F.coalesce(F.avg("churnRate"), F.lit(0.0))).scalar())


def precision_at_share(scored: DataFrame, key: str, share: float = 0.2, within: Sequence[str] = ()) -> DataFrame:
    """Churn rate among the given share of customers with the highest scores.

    The cut is the linearly interpolated quantile of the scores; customers at the cut
    count as chosen. It is read off the distinct scores, so ties cost nothing.
    """
    within = list(within)
    cuts = value_quantiles(scored, ["p"], [1 - share], by=within).select(*within, F.col("q0").alias("cut"))
    chosen = scored.join(F.broadcast(cuts), within) if within else scored.withColumn("cut", cuts.select("cut").scalar())
    return (
        chosen.where(F.col("p") >= F.col("cut"))
        .groupBy(*within, "cut")
        .agg(F.count(key).alias("customers"), F.avg("y").alias("precision"))
    )


def class_weights(labels: DataFrame, label: str = "is_churned") -> DataFrame:
    """Balanced weight n / (2 n_class) of both classes and the ratio of negatives to positives."""
    counted = labels.agg(count_if(F.col(label) == 0).alias("_n0"), count_if(F.col(label) == 1).alias("_n1"))
    total = F.col("_n0") + F.col("_n1")
    entries = [
        F.struct(
            F.lit(c).alias("label"),
            F.col(f"_n{c}").alias("customers"),
            ratio(total, 2 * F.col(f"_n{c}")).alias("weight"),
            ratio(F.col("_n0"), F.col("_n1")).alias("positive_ratio"),
        )
        for c in (0, 1)
    ]
    return counted.select(F.inline(F.array(*entries)))


# ---- monitoring ----------------------------------------------------------------------------


def psi_drift(
    base: DataFrame, current: DataFrame, key: str, columns: Sequence[str], bins: int = 10, limit: float = 0.2
) -> DataFrame:
    """Population stability index per feature over the deciles of the base; alert above the limit.

    Equal decile edges collapse into one. An empty bin counts as a share of 0.0001.
    """
    inner = [i / bins for i in range(1, bins)]
    edges = {c: sorted(set(q)) for c, q in exact_quantiles(base, columns, inner).items()}
    bucket = reduce(
        lambda acc, c: acc.when(
            F.col("feature") == c,
            reduce(lambda a, e: a + (F.col("value") > F.lit(e)).cast("int"), edges[c], F.lit(0)),
        ),
        edges,
        F.when(F.lit(False), F.lit(0)),
    )
    sides = unpivot(base, [key], list(edges)).withColumn("_base", F.lit(1)).unionByName(
        unpivot(current, [key], list(edges)).withColumn("_base", F.lit(0))
    )
    counts = sides.groupBy("feature", bucket.alias("_bin")).agg(
        F.sum("_base").alias("_e"), F.sum(1 - F.col("_base")).alias("_a")
    )
    # at most `bins` cells per feature
    cells = counts.groupBy("feature").agg(
        F.collect_list(F.struct("_e", "_a")).alias("_cells"), F.sum("_e").alias("_en"), F.sum("_a").alias("_an")
    )
    expected = lambda c: F.greatest(c["_e"] / F.col("_en"), F.lit(1e-4))
    actual = lambda c: F.greatest(c["_a"] / F.col("_an"), F.lit(1e-4))
    psi = F.aggregate(
        "_cells", F.lit(0.0), lambda acc, c: acc + (actual(c) - expected(c)) * F.ln(actual(c) / expected(c))
    )
    return cells.select("feature", psi.alias("psi")).withColumn("alert", (F.col("psi") > limit).cast("int"))


def weekly_auc_alert(scored: DataFrame, week: str = "week", drop: float = 0.03) -> DataFrame:
    """AUC per week and an alert when it fell by more than `drop` of the week before."""
    weekly = ranking_metrics(scored, [week]).select(week, "auc")
    # one row per week
    before = F.lag("auc").over(Window.orderBy(week))
    return weekly.withColumn("previous_auc", before).withColumn(
        "alert", F.coalesce((F.col("auc") < F.col("previous_auc") * (1 - drop)).cast("int"), F.lit(0))
    )
