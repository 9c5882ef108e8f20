from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.functions.expressions import round_half_even, rounded
from patronage.operators import customers
from patronage.operators.ordering import value_quantiles
from patronage.queries.segments import segment_summary
from patronage.session import scratch_path
from patronage.sources import files, shop as adapters
from patronage.sources.shop import load_shop

ORDER_COLUMNS = (
    "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
)


def scan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    adapters.pin_utc(spark)
    return rounded(adapters.read_test_table(spark, sf_dir, "orders"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders written as CSV, converted to parquet with an explicit schema, read back."""
    source = scratch_path(spark, "orders-csv")
    files.write_csv(load_shop(spark, sf_dir).orders, source)
    return files.csv_to_parquet(spark, source, scratch_path(spark, "orders-parquet"), ORDER_COLUMNS)


def table_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.table_catalog(spark, sf_dir)


def coerce_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase dates as text, some of them unreadable, parsed back."""
    text = load_shop(spark, sf_dir).orders.select(
        "order_id",
        F.when(F.col("order_id") % 13 == 0, "not a date")
        .when(F.col("order_id") % 13 == 1, "2001-02-30 00:00:00")
        .otherwise(F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss"))
        .alias("order_purchase_timestamp"),
    )
    return files.coerce_timestamps(text, ["order_purchase_timestamp"])


def load_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return files.load_into_catalog(shop.tables(), "patronage_raw", f"{scratch_path(spark, 'warehouse')}")


def bucketed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer features over tables that are bucketed by order."""
    name = f"patronage_{uuid.uuid4().hex}"
    shop = files.load_bucketed(load_shop(spark, sf_dir).tables(), name, scratch_path(spark, "buckets"), buckets=8)
    return rounded(customers.customer_features(shop))


def null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with defaults per column."""
    reviews = load_shop(spark, sf_dir).reviews.select(
        "review_id", "review_score", F.col("review_comment_message").alias("text")
    )
    return reviews.fillna({"review_score": 0, "text": "none"})


def distinct_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_shop(spark, sf_dir).orders.select("customer_id").distinct()


def group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the payment values per payment type, with exact medians."""
    payments = load_shop(spark, sf_dir).payments
    value = F.col("payment_value")
    moments = payments.groupBy("payment_type").agg(
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.count(value).alias("count"),
        F.sum(value).alias("sum"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
    )
    medians = value_quantiles(payments, ["payment_value"], [0.5], by=["payment_type"])
    return rounded(moments.join(medians.select("payment_type", F.col("q0").alias("median")), "payment_type"))


def half_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = load_shop(spark, sf_dir).payments
    value = F.col("payment_value")
    return payments.select(
        "order_id",
        "payment_sequential",
        *(round_half_even(value, d).alias(f"round_{d}") for d in (1, 2, 3)),
    )


def orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.date_format("order_purchase_timestamp", "yyyy-MM")
    return load_shop(spark, sf_dir).orders.groupBy(month.alias("month")).agg(F.count("*").alias("orders"))


def segment_summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster summary as JSON records, written and read back."""
    target = scratch_path(spark, "segment-summary")
    summary = segment_summary(spark, sf_dir)
    files.write_json_records(summary, target)
    return spark.read.schema(summary.schema).json(target)


QUERIES = {
    "scan_orders": scan_orders,
    "csv_roundtrip": csv_roundtrip,
    "table_catalog": table_catalog,
    "coerce_timestamps": coerce_timestamps,
    "bucketed_features": bucketed_features,
    "load_tables": load_tables,
    "null_fill": null_fill,
    "distinct_customers": distinct_customers,
    "group_stats": group_stats,
    "half_even_round": half_even,
    "orders_by_month": orders_by_month,
    "segment_summary_json": segment_summary_json,
}
