"""Batch jobs: each overwrites its output, so a repeated run gives the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from patronage.operators import churn, clusters, customers, segments
from patronage.session import materialize
from patronage.sources import files
from patronage.sources.shop import Shop


def build_customer_master(shop: Shop, output: str) -> None:
    """One row per customer, text columns as strings."""
    files.write_parquet(files.text_columns_as_strings(customers.customer_master(shop)), output)


def build_segments(master: DataFrame, output: str, k: int = 5, n_init: int = 50) -> None:
    """Clusters per customer, and their summary as JSON records."""
    assigned = clusters.kmeans_segments(clusters.behaviour_vectors(master), k, n_init).drop("features")
    assigned = materialize(assigned)
    files.write_parquet(assigned, f"{output}/customers")
    files.write_json_records(segments.segment_summary(master.join(assigned, customers.CUSTOMER)), f"{output}/summary")


def build_churn_dataset(shop: Shop, output: str) -> None:
    """Features and labels, one folder per split."""
    files.write_parquet(churn.churn_dataset(shop), output, by=["split"])


def load_churn_dataset(spark, path: str, split: str | None = None) -> DataFrame:
    """The stored dataset; naming a split reads only its folder."""
    dataset = spark.read.parquet(path)
    return dataset if split is None else dataset.where(F.col("split") == split)
