"""Named segments, their profiles and advice, cluster summaries and dashboard tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.functions.expressions import cascade, ratio, round_half_even, title_case
from patronage.operators.customers import CUSTOMER
from patronage.operators.ordering import unpivot, value_quantiles
from patronage.session import materialize

BEHAVIOUR = [
    "frequency",
    "avg_order_value",
    "tenure_days",
    "avg_installments",
    "payment_diversity",
    "avg_review_score",
    "review_rate",
    "category_diversity",
]

# fixed values: score codes of each segment; lists overlap and the first match wins
RFM_SEGMENTS = [
    ("Champions", "555 554 544 545 454 455 445"),
    ("Loyal Customers", "543 444 435 355 354 345 344 335"),
    ("Potential Loyalists", "512 511 422 421 412 411 311"),
    ("New Customers", "553 551 552 541 542 533 532 531 452 451"),
    ("Promising", "155 154 144 214 215 115 114"),
    ("Need Attention", "155 254 245 253 252 243 244 235 234 225 224 153 152"),
    ("About to Sleep", "331 321 231 241 251"),
    ("At Risk", "155 144 214 215 115 114 113"),
    ("Cannot Lose Them", "125 124 123 122 132 131 121 212 211"),
    ("Hibernating", "432 423 353 334 343 323 313"),
]
OTHER_RFM_SEGMENT = "Lost"

# fixed values: advice per segment
INSIGHTS = {
    "Champions": "Reward them. Can be early adopters for new products. Will promote your brand.",
    "Loyal Customers": "Upsell higher value products. Ask for reviews. Engage them.",
    "Potential Loyalists": "Offer membership or loyalty program. Recommend other products.",
    "New Customers": "Provide on-boarding support, give them early success, start building relationship.",
    "Promising": "Create brand awareness, offer free trials.",
    "Need Attention": "Make limited time offers. Recommend based on past purchases. Reactivate them.",
    "About to Sleep": "Share valuable resources, recommend popular products / renewals at discount, reconnect with them.",
    "At Risk": "Send personalized emails to reconnect, offer renewals, provide helpful resources.",
    "Cannot Lose Them": "Win them back via renewals or newer products, don't lose them to competition, talk to them.",
    "Hibernating": "Offer other product categories, special discounts, recreate brand value.",
    "Lost": "Revive interest with reach out campaign, ignore otherwise.",
}

# fixed values: display name and type of the five clusters
CLUSTER_NAMES = [
    (0, "Budget Conscious", "standard"),
    (1, "High-Value Premium", "premium"),
    (2, "Payment Diversified", "standard"),
    (3, "Dissatisfied Regular", "at-risk"),
    (4, "Low Engagement", "low-value"),
]

# fixed values: type, title, description, priority, colour
RECOMMENDATIONS = {
    "premium": (
        "High-Value Premium",
        "VIP programs, exclusive early access, premium support, flexible financing options. "
        "These customers drive profit.",
        "Short-term",
        "green",
    ),
    "at-risk": (
        "Dissatisfied Regular",
        "URGENT: Root cause analysis, quality improvements, proactive outreach, service recovery programs.",
        "Immediate",
        "red",
    ),
    "low-value": (
        "Low Engagement",
        "Onboarding improvements, product discovery features, personalized recommendations, win-back campaigns.",
        "Short-term",
        "orange",
    ),
}
STANDARD_HAPPY = (
    "Volume discounts, loyalty rewards, bundle deals. Happy customers who value good prices - your foundation."
)
STANDARD_OTHER = (
    "Payment innovation testing, cross-sell opportunities, financial service partnerships. Tech-savvy segment."
)


def _share(count: Column) -> Column:
    """Percentage of all rows; runs over the few rows of a summary."""
    return 100 * count / F.sum(count).over(Window.partitionBy(F.lit(1)))


# ---- segments by score code ----------------------------------------------------------------


def rfm_segment(code: Column) -> Column:
    return cascade(
        [(code.isin(codes.split()), F.lit(name)) for name, codes in RFM_SEGMENTS], F.lit(OTHER_RFM_SEGMENT)
    )


def rfm_segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn("RFM_segment", rfm_segment(F.col("RFM_score")))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their percentage, one digit. The total is a scalar subquery over the counts, so no
    task sees all values."""
    counts = df.groupBy(column).agg(F.count("*").alias("customers"))
    total = counts.agg(F.sum("customers")).scalar()
    return counts.withColumn("percentage", round_half_even(100 * F.col("customers") / total, 1))


def segment_profile(df: DataFrame, by: str, means: Sequence[str], extremes: Sequence[str] = ()) -> DataFrame:
    """Means, and for some measures minimum and maximum, per segment; two digits."""
    return df.groupBy(by).agg(
        *(round_half_even(F.avg(c), 2).alias(f"{c}_mean") for c in means),
        *(round_half_even(F.min(c).cast("double"), 2).alias(f"{c}_min") for c in extremes),
        *(round_half_even(F.max(c).cast("double"), 2).alias(f"{c}_max") for c in extremes),
    )


def segment_insights(segmented: DataFrame) -> DataFrame:
    """Advice for every segment that occurs, with its size."""
    advice = F.create_map(*(F.lit(x) for pair in INSIGHTS.items() for x in pair))
    return (
        segmented.groupBy("RFM_segment")
        .agg(F.count("*").alias("customers"))
        .withColumn("strategy", advice[F.col("RFM_segment")])
    )


def segment_churn(master: DataFrame, labels: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Spend tiers with size, mean order value, churn rate and a description."""
    description = F.concat(F.lit("Customers of the spend tier "), F.col("value_segment"))
    return (
        master.join(labels.select(customer, "is_churned"), customer, "left")
        .groupBy("value_segment")
        .agg(
            F.count("*").alias("count"),
            round_half_even(F.avg("avg_order_value"), 2).alias("avgOrderValue"),
            round_half_even(F.avg("is_churned"), 3).alias("churnRate"),
        )
        .withColumn("description", description)
        .withColumnRenamed("value_segment", "name")
    )


# ---- clusters ------------------------------------------------------------------------------


def segment_summary(clustered: DataFrame) -> DataFrame:
    """Size, share and mean behaviour of every cluster."""
    return (
        clustered.groupBy("cluster")
        .agg(
            F.count("*").alias("customers"),
            *(
                round_half_even(F.avg(source), 2).alias(name)
                for source, name in (
                    ("avg_order_value", "avgOrderValue"),
                    ("avg_installments", "avgInstallments"),
                    ("avg_review_score", "avgReviewScore"),
                    ("review_rate", "reviewRate"),
                    ("category_diversity", "categoryDiversity"),
                )
            ),
        )
        .withColumn("percentage", round_half_even(_share(F.col("customers")), 1))
    )


def behavioral_segments(clustered: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Names each cluster by comparing its profile with the mean of the cluster profiles.

    The profiles are one row per cluster and are broadcast back to the customers.
    """
    measures = ["frequency", "avg_order_value", "category_diversity"]
    profiles = clustered.groupBy("cluster").agg(*(F.avg(c).alias(f"_{c}") for c in measures))
    everything = Window.partitionBy(F.lit(1))
    above = {c: F.round(F.col(f"_{c}"), 8) > F.round(F.avg(f"_{c}").over(everything), 8) for c in measures}
    name = cascade(
        [
            (above["frequency"] & above["avg_order_value"], F.lit("High Frequency High Value")),
            (above["frequency"], F.lit("Frequent Buyers")),
            (above["avg_order_value"], F.lit("Big Spenders")),
            (above["category_diversity"], F.lit("Category Explorers")),
        ],
        F.lit("Occasional Shoppers"),
    )
    names = profiles.select("cluster", name.alias("behavioral_segment"))
    return clustered.join(F.broadcast(names), "cluster")


def cluster_statistics(
    clustered: DataFrame, customer: str = CUSTOMER, features: Sequence[str] = tuple(BEHAVIOUR)
) -> DataFrame:
    """Mean, exact median and spread per cluster and feature, and the side of the overall mean."""
    clustered = materialize(clustered.select("cluster", *features))
    keys = ["cluster", "feature"]
    moments = unpivot(clustered, ["cluster"], features).groupBy(*keys).agg(
        F.avg("value").alias("_mean"),
        F.stddev_samp("value").alias("std"),
        F.sum("value").alias("_sum"),
        F.count("value").alias("_n"),
    )
    medians = value_quantiles(clustered, features, [0.5], by=["cluster"]).select(*keys, F.col("q0").alias("median"))
    feature = Window.partitionBy("feature")
    overall = F.sum("_sum").over(feature) / F.sum("_n").over(feature)
    return (
        moments.withColumn("overall_mean", overall)
        .join(medians, keys)
        .select(
            *keys,
            round_half_even(F.col("_mean"), 3).alias("mean"),
            round_half_even(F.col("median"), 3).alias("median"),
            round_half_even(F.col("std"), 3).alias("std"),
            F.when(F.round("_mean", 8) > F.round("overall_mean", 8), "↑").otherwise("↓").alias("direction"),
        )
    )


def cluster_value_score(clustered: DataFrame) -> DataFrame:
    """0.4 frequency + 0.4 order value + 0.2 tenure of the cluster means; marks best and worst."""
    scored = clustered.groupBy("cluster").agg(
        F.count("*").alias("customers"),
        (F.avg("frequency") * 0.4 + F.avg("avg_order_value") * 0.4 + F.avg("tenure_days") * 0.2).alias("value_score"),
    )
    everything = Window.partitionBy(F.lit(1))
    best = F.min_by("cluster", F.struct(-F.col("value_score"), "cluster")).over(everything)
    worst = F.min_by("cluster", F.struct("value_score", "cluster")).over(everything)
    return scored.select(
        "*",
        F.when(F.col("cluster") == best, "high").when(F.col("cluster") == worst, "low").otherwise("middle").alias("role"),
    )


def cluster_revenue(clustered: DataFrame) -> DataFrame:
    """Estimated value per customer and year, and of the whole cluster."""
    return (
        clustered.groupBy("cluster")
        .agg(
            F.count("*").alias("customers"),
            (F.avg("avg_order_value") * F.avg("frequency")).alias("estimated_annual_value"),
        )
        .withColumn("total_value", F.col("estimated_annual_value") * F.col("customers"))
    )


def cluster_minmax(clustered: DataFrame, features: Sequence[str] = tuple(BEHAVIOUR)) -> DataFrame:
    """Cluster means scaled to 0..1 across the features of each cluster."""
    means = clustered.groupBy("cluster").agg(*(F.avg(c).alias(c) for c in features))
    values = F.array(*features)
    low, high = F.array_min(values), F.array_max(values)
    return means.select("cluster", *(((F.col(c) - low) / F.nullif(high - low, F.lit(0.0))).alias(c) for c in features))


# ---- dashboard -----------------------------------------------------------------------------


def cluster_labels(spark) -> DataFrame:
    return spark.createDataFrame(CLUSTER_NAMES, "cluster int, name string, type string")


def name_clusters(df: DataFrame) -> DataFrame:
    """Attaches display name and type; unknown clusters are `Cluster n`, standard."""
    joined = df.join(F.broadcast(cluster_labels(df.sparkSession)), "cluster", "left")
    return joined.withColumns(
        {
            "name": F.coalesce("name", F.concat(F.lit("Cluster "), F.col("cluster").cast("string"))),
            "type": F.coalesce("type", F.lit("standard")),
        }
    )


def half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def segment_enriched(summary: DataFrame) -> DataFrame:
    return name_clusters(summary).withColumns(
        {
            "annualValue": half_up(F.col("avgOrderValue")),
            "totalValue": half_up(F.col("customers") * F.col("avgOrderValue")),
        }
    )


def segment_kpis(enriched: DataFrame) -> DataFrame:
    """Customers, revenue, share of the first premium cluster, share of endangered clusters."""
    premium = F.min_by(
        "percentage", F.when(F.col("type") == "premium", F.col("cluster"))
    )
    return enriched.agg(
        F.sum("customers").alias("totalCustomers"),
        F.sum("totalValue").alias("totalRevenue"),
        F.coalesce(premium, F.lit(0.0)).alias("premiumPercentage"),
        F.coalesce(
            F.sum(F.when(F.col("type").isin("at-risk", "low-value"), F.col("percentage"))), F.lit(0.0)
        ).alias("atRiskPercentage"),
    )


def segment_radar(summary: DataFrame) -> DataFrame:
    """Measures of each cluster on a common scale of about 0 to 100."""
    return summary.select(
        F.concat(F.lit("Cluster "), F.col("cluster").cast("string")).alias("cluster"),
        half_up(F.col("avgOrderValue") / 400 * 100).alias("Order Value"),
        half_up(F.col("avgReviewScore") / 5 * 100).alias("Review Score"),
        half_up(F.col("avgInstallments") / 10 * 100).alias("Installments"),
        half_up(F.col("categoryDiversity") * 100).alias("Category Diversity"),
        half_up(F.col("reviewRate") * 100).alias("Review Rate"),
    )


def segment_recommendation(enriched: DataFrame) -> DataFrame:
    """Title, description, priority and colour by cluster type; standard clusters by review score."""
    kind = F.col("type")
    happy = F.when(F.col("avgReviewScore") > 4.5, STANDARD_HAPPY).otherwise(STANDARD_OTHER)
    standard = (F.col("name"), happy, F.lit("Long-term"), F.lit("blue"))
    columns = ("title", "description", "priority", "color")
    return enriched.select(
        "cluster",
        *(
            cascade([(kind == t, F.lit(texts[i])) for t, texts in RECOMMENDATIONS.items()], standard[i]).alias(column)
            for i, column in enumerate(columns)
        ),
    )


# ---- features as rows ----------------------------------------------------------------------


def feature_strength(train: DataFrame, features: Sequence[str], label: str = "is_churned") -> DataFrame:
    """Correlation of every feature with the label, one row per feature, in one pass.

    A feature without spread has none. The features are grouped as rows: a few sums per
    row compile to a small loop, unlike some hundred sums side by side.
    """
    spread = F.stddev_pop("value") * F.stddev_pop(label)
    return (
        unpivot(train, [label], features)
        .groupBy("feature")
        .agg(ratio(F.covar_pop("value", label), spread).alias("coefficient"))
        .withColumn("importance", F.abs(F.round("coefficient", 6)))
    )


def top_features(importance: DataFrame, n: int) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def importance_share(importance: DataFrame, n: int = 10) -> DataFrame:
    """Top features scaled by the largest importance."""
    top = top_features(importance, n)
    return top.withColumn(
        "normalizedImportance", F.col("importance") / F.max("importance").over(Window.partitionBy(F.lit(1)))
    )


# fixed values: advice for a feature whose name contains the word, first match wins
FEATURE_ADVICE = [
    (("recency",), "Monitor customer engagement frequency and implement re-engagement campaigns"),
    (("frequency",), "Focus on increasing purchase frequency through personalized recommendations"),
    (("monetary", "value"), "Implement value-based retention strategies and upselling programs"),
    (("days",), "Create time-based triggers for proactive customer outreach"),
]
OTHER_FEATURE_ADVICE = "Develop targeted interventions for this key risk factor"


def feature_advice(importance: DataFrame, n: int = 3) -> DataFrame:
    name = F.lower("feature")
    rules = []
    for words, text in FEATURE_ADVICE:
        hit = F.lit(False)
        for word in words:
            hit = hit | name.contains(word)
        rules.append((hit, F.lit(text)))
    return top_features(importance, n).select(
        title_case(F.col("feature")).alias("feature"),
        "importance",
        F.when(F.col("coefficient") > 0, "increases").otherwise("decreases").alias("impact"),
        cascade(rules, F.lit(OTHER_FEATURE_ADVICE)).alias("advice"),
    )
