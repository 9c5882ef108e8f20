from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.functions.expressions import rounded
from patronage.operators import customers as ops
from patronage.operators.ordering import global_rank, value_quantiles
from patronage.session import materialize
from patronage.sources.shop import load_shop


def rfm_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.rfm_base(load_shop(spark, sf_dir).orders)


def order_value_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.order_value_join(shop.orders, shop.items))


def monetary(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.monetary(shop.orders, shop.items))


def monetary_price_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return ops.monetary_price_only(shop.orders, shop.items)


def payment_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return ops.payment_behavior(shop.payments, shop.orders)


def preferred_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payment_behavior(spark, sf_dir).select("customer_id", "preferred_payment_type")


def payment_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payment_behavior(spark, sf_dir).select("customer_id", "payment_diversity")


def review_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.review_behavior(shop.reviews, shop.orders))


def items_with_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    joined = ops.items_with_category(shop.items, shop.products, shop.categories)
    return rounded(
        joined.select(
            "order_id",
            "order_item_id",
            "product_id",
            "price",
            "product_category_name",
            "product_category_name_english",
        )
    )


def category_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return ops.category_behavior(shop.items, shop.products, shop.categories, shop.orders)


def preferred_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_behavior(spark, sf_dir).select("customer_id", "preferred_category")


def geo_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.geo_info(load_shop(spark, sf_dir).customers)


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.customer_master(load_shop(spark, sf_dir)))


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return materialize(ops.spend_base(shop.orders, shop.items))


def rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ops.add_rfm_scores(spend(spark, sf_dir))
    return scored.select("customer_id", "R_score", "F_score", "M_score", "RFM_score")


def rfm_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm_scores(spark, sf_dir).select("customer_id", "RFM_score")


def value_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = ops.value_segments(spend(spark, sf_dir))
    return rounded(tiers.select("customer_id", "total_spent", "value_segment"))


def spend_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    totals = ops.spend_base(shop.orders, shop.items).select("customer_id", "total_spent")
    ranked = global_rank(totals, ["total_spent", "customer_id"])
    return rounded(ranked.select("customer_id", "total_spent", F.col("rank").alias("spend_rank")))


def spend_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    totals = materialize(ops.spend_base(shop.orders, shop.items).select("total_spent"))
    table = value_quantiles(totals, ["total_spent"], [0.25, 0.5, 0.75, 0.9])
    return rounded(table.select(*(F.col(f"q{i}").alias(f"q{p}") for i, p in enumerate((25, 50, 75, 90)))))


def cltv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.cltv_summary(shop.orders, shop.items))


def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = load_shop(spark, sf_dir).reviews
    return ops.quality_checks(
        reviews,
        "order_id",
        ["order_id", "review_score", "review_comment_message"],
        {"review_score": (1, 4)},
    )


QUERIES = {
    "rfm_base": rfm_base,
    "order_value_join": order_value_join,
    "monetary": monetary,
    "monetary_price_only": monetary_price_only,
    "payment_behavior": payment_behavior,
    "preferred_payment_type": preferred_payment_type,
    "payment_diversity": payment_diversity,
    "review_behavior": review_behavior,
    "items_with_category": items_with_category,
    "category_behavior": category_behavior,
    "preferred_category": preferred_category,
    "geo_info": geo_info,
    "customer_master": customer_master,
    "rfm_scores": rfm_scores,
    "rfm_code": rfm_code,
    "value_segment": value_segment,
    "global_rank": spend_rank,
    "spend_quantiles": spend_quantiles,
    "cltv_summary": cltv_summary,
    "quality_checks": quality_checks,
}
