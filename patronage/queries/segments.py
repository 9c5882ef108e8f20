from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.functions.expressions import rounded, title_case
from patronage.operators import churn, customers, segments as ops
from patronage.queries.customers import spend
from patronage.session import materialize
from patronage.sources.shop import load_shop


def rfm_segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.rfm_segments(customers.add_rfm_scores(spend(spark, sf_dir), tiers=True))


def rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm_segmented(spark, sf_dir).select("customer_id", "RFM_score", "RFM_segment")


def segment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.value_counts(rfm_segmented(spark, sf_dir), "RFM_segment")


def rfm_segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    scored = rfm_segmented(spark, sf_dir).join(
        customers.review_behavior(shop.reviews, shop.orders).select("customer_id", "avg_review_score"),
        "customer_id",
        "left",
    )
    measures = ["recency_days", "frequency", "total_spent", "avg_order_value", "avg_review_score"]
    return ops.segment_profile(scored.fillna(0.0, ["avg_review_score"]), "RFM_segment", measures)


def value_segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_profile(
        rfm_segmented(spark, sf_dir),
        "value_segment",
        ["total_spent", "frequency", "avg_order_value", "recency_days"],
        ["total_spent"],
    )


def segment_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_insights(rfm_segmented(spark, sf_dir))


def segment_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = churn.churn_labels(load_shop(spark, sf_dir).orders)
    return ops.segment_churn(rfm_segmented(spark, sf_dir), labels)


def labelled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers with a fixed cluster label, for the operators that take labels."""
    features = customers.customer_features(load_shop(spark, sf_dir))
    return features.withColumn("cluster", (F.col("customer_id") % 5).cast("int"))


def segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_summary(labelled_customers(spark, sf_dir))


def behavioral_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = ops.behavioral_segments(materialize(labelled_customers(spark, sf_dir)))
    return named.select("customer_id", "cluster", "behavioral_segment")


BEHAVIOURAL = ["frequency", "avg_order_value", "category_diversity", "payment_diversity", "avg_review_score", "total_spent"]


def labelled_segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of the behavioural segments over given cluster labels; `behavioral_segment_profile` fits its own."""
    named = ops.behavioral_segments(materialize(labelled_customers(spark, sf_dir)))
    return ops.segment_profile(named, "behavioral_segment", BEHAVIOURAL)


def cluster_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.cluster_statistics(labelled_customers(spark, sf_dir))


def cluster_value_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.cluster_value_score(labelled_customers(spark, sf_dir)))


def cluster_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.cluster_revenue(labelled_customers(spark, sf_dir)))


def cluster_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.cluster_minmax(labelled_customers(spark, sf_dir)))


def cluster_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = churn.churn_labels(load_shop(spark, sf_dir).orders)
    clustered = labels.select("customer_id", (F.col("customer_id") % 6).cast("int").alias("cluster"))
    return ops.name_clusters(clustered)


def segment_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_enriched(segment_summary(spark, sf_dir))


def segment_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.segment_kpis(segment_enriched(spark, sf_dir)))


def segment_radar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_radar(segment_summary(spark, sf_dir))


def segment_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_recommendation(segment_enriched(spark, sf_dir))


def strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of every churn feature with the label on the training customers."""
    train = churn.churn_dataset(load_shop(spark, sf_dir)).where(F.col("split") == "train")
    ignored = ("customer_id", "split", "is_churned", "days_since_last_order")
    return ops.feature_strength(train, [c for c in train.columns if c not in ignored])


def top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.top_features(strength(spark, sf_dir), 10).select("feature", "importance"))


def feature_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(strength(spark, sf_dir).select("feature", title_case(F.col("feature")).alias("title"), "importance"))


def feature_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.feature_advice(strength(spark, sf_dir)))


QUERIES = {
    "rfm_segments": rfm_segments,
    "segment_distribution": segment_distribution,
    "rfm_segment_profile": rfm_segment_profile,
    "value_segment_profile": value_segment_profile,
    "segment_insights": segment_insights,
    "segment_churn": segment_churn,
    "segment_summary": segment_summary,
    "behavioral_segments": behavioral_segments,
    "labelled_segment_profile": labelled_segment_profile,
    "cluster_statistics": cluster_statistics,
    "cluster_value_score": cluster_value_score,
    "cluster_revenue": cluster_revenue,
    "cluster_minmax": cluster_minmax,
    "cluster_names": cluster_names,
    "segment_enriched": segment_enriched,
    "segment_kpis": segment_kpis,
    "segment_radar": segment_radar,
    "segment_recommendation": segment_recommendation,
    "top_features": top_features,
    "feature_titles": feature_titles,
    "feature_advice": feature_advice,
}
