from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.functions.expressions import rounded
from patronage.operators import clusters as ops, customers, segments
from patronage.operators.scaling import standard_scale
from patronage.queries.segments import BEHAVIOURAL
from patronage.session import materialize
from patronage.sources.shop import load_shop, read_test_table

FEATURES = segments.BEHAVIOUR


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.behaviour_vectors(materialize(customers.customer_features(load_shop(spark, sf_dir))))


def kmeans_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.kmeans_segments(vectors(spark, sf_dir)).drop("features")


def kmeans_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.kmeans_k_search(vectors(spark, sf_dir), len(FEATURES))


def best_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choice of k over a table that SQL can compute too; `kmeans_k_search` yields the same table."""
    return ops.best_k(fixed_label_metrics(spark, sf_dir))


def fixed_label_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of the clusterings `customer_id mod k` for k = 2..10: the same table of k as
    the search yields, with labels that SQL can compute too."""
    shop = load_shop(spark, sf_dir)
    spend = materialize(customers.spend_base(shop.orders, shop.items))
    measures = ["frequency", "avg_order_value", "tenure_days"]
    scaled = standard_scale(spend, measures)
    long = scaled.select(
        F.array(*measures).alias("x"), "customer_id", F.explode(F.sequence(F.lit(2), F.lit(10))).alias("k")
    ).select("k", "x", (F.col("customer_id") % F.col("k")).alias("label"))
    return materialize(ops.cluster_quality(long, len(measures)))


def elbow_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.elbow_k(fixed_label_metrics(spark, sf_dir)))


def k_metric_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.k_metric_ranks(fixed_label_metrics(spark, sf_dir)))


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with their given labels as one clustering."""
    table = read_test_table(spark, sf_dir, "embeddings")
    return ops.cluster_quality(
        table.select(F.lit(0).alias("k"), "label", F.transform("embedding", lambda v: v.cast("double")).alias("x")), 64
    )


def davies_bouldin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(embedded(spark, sf_dir).select("db_index", "inertia"))


def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(embedded(spark, sf_dir).select("silhouette"))


def pca_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = ops.kmeans_segments(vectors(spark, sf_dir))
    return rounded(ops.pca_projection(ops.fit_pca(clustered), clustered))


def pca_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster centres in the plane of the components."""
    return rounded(ops.projected_centers(pca_projection(spark, sf_dir)))


def pca_loadings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.pca_loadings(ops.fit_pca(vectors(spark, sf_dir)), FEATURES, spark))


def behavioral_segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = materialize(customers.customer_features(load_shop(spark, sf_dir)))
    clustered = ops.kmeans_segments(ops.behaviour_vectors(features)).drop("features")
    named = segments.behavioral_segments(materialize(features.join(clustered, "customer_id")))
    return segments.segment_profile(named, "behavioral_segment", BEHAVIOURAL)


QUERIES = {
    "kmeans_segments": kmeans_segments,
    "kmeans_k_search": kmeans_k_search,
    "best_k": best_k,
    "elbow_k": elbow_k,
    "k_metric_ranks": k_metric_ranks,
    "davies_bouldin": davies_bouldin,
    "silhouette": silhouette,
    "pca_projection": pca_projection,
    "pca_centers": pca_centers,
    "pca_loadings": pca_loadings,
    "behavioral_segment_profile": behavioral_segment_profile,
}
