from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.functions.expressions import floor_days, plus_days, plus_months, polarity_class, rounded
from patronage.functions.joins import lookup_join
from patronage.operators import churn as ops
from patronage.operators.scaling import robust_scale, standard_scale
from patronage.session import materialize
from patronage.sources.shop import load_shop


def lexicon(reviews: DataFrame) -> DataFrame:
    """The polarity that the scores of the reviews give to their words, as a stored table."""
    return materialize(ops.learn_lexicon(reviews))


def learned_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon(load_shop(spark, sf_dir).reviews)


def lexicon_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from four fifths of the reviews, held against the others."""
    reviews = load_shop(spark, sf_dir).reviews
    learned = lexicon(reviews.where(~ops.held_out_reviews()))
    return rounded(ops.lexicon_agreement(reviews.where(ops.held_out_reviews()), learned))


def churn_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.churn_labels(load_shop(spark, sf_dir).orders)


def churn_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = churn_labels(spark, sf_dir)
    return rounded(
        labels.agg(
            F.count("*").alias("customers"),
            F.avg("is_churned").alias("churn_rate"),
            F.max("last_purchase").alias("latest_purchase"),
        )
    )


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.stratified_split(churn_labels(spark, sf_dir)).select("customer_id", "is_churned", "split")


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.class_balance(ops.stratified_split(churn_labels(spark, sf_dir))))


def delivered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.delivered_orders(load_shop(spark, sf_dir).orders)


def date_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    when = F.col("order_purchase_timestamp")
    return load_shop(spark, sf_dir).orders.select(
        "order_id",
        floor_days("order_delivered_customer_date", "order_estimated_delivery_date").alias("days_late"),
        plus_days(when, 1).alias("next_day"),
        plus_months(when, -6).alias("half_year_before"),
    )


def delivery_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.delivery_features(load_shop(spark, sf_dir).orders))


def delivery_features_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.delivery_features(load_shop(spark, sf_dir).orders, variant="module"))


def delivery_promise_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.delivery_promise_features(load_shop(spark, sf_dir).orders))


def winsorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ops.delivery_promise_features(load_shop(spark, sf_dir).orders)
    return rounded(ops.winsorize(features, ops.LATENESS).select("customer_id", *ops.LATENESS))


def log_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ops.delivery_promise_features(load_shop(spark, sf_dir).orders)
    logged = ops.log_ratios(features, ops.LATENESS_RATIOS)
    return rounded(logged.select("customer_id", *(f"{c}_log" for c in ops.LATENESS_RATIOS)))


def customer_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    features = ops.delivery_promise_features(shop.orders)
    return rounded(ops.customer_spine(shop.customers, features))


def delivery_features_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.delivery_features_scaled(shop.orders, shop.customers))


def describe_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ops.delivery_promise_features(load_shop(spark, sf_dir).orders)
    return rounded(ops.describe_features(features, features.columns[1:]))


def review_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.review_features(shop.reviews, shop.orders, lexicon=lexicon(shop.reviews)))


def review_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.review_sentiment(shop.reviews, shop.orders, lexicon(shop.reviews)))


def review_sentiment_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.review_sentiment(shop.reviews, shop.orders, lexicon(shop.reviews), scaled=True))


def sentiment_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = load_shop(spark, sf_dir).reviews
    polarity = ops.review_polarity(reviews, lexicon(reviews))
    tone = polarity_class(F.col("polarity"))
    return polarity.groupBy(F.coalesce(tone, F.lit("none")).alias("sentiment_class")).agg(
        F.count("*").alias("reviews")
    )


def historical_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = ops.historical_window(load_shop(spark, sf_dir).orders)
    return window.select("order_id", "customer_id", "order_purchase_timestamp")


def _historical(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.rfm_historical(shop.orders, shop.items, shop.payments, **options))


def rfm_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _historical(spark, sf_dir)


def rfm_historical_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _historical(spark, sf_dir, variant="module")


def rfm_historical_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _historical(spark, sf_dir, dedupe=True)


def rfm_shipping_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.rfm_shipping_features(shop.orders, shop.items, shop.payments))


def payment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.payment_features(shop.payments, shop.orders))


def payment_features_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.payment_features(shop.payments, shop.orders, variant="module"))


def payment_complexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    return rounded(ops.payment_complexity(shop.payments, shop.orders))


def cancellation_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.cancellation_features(load_shop(spark, sf_dir).orders))


def semi_join_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of the orders of the test customers."""
    return of_test_orders(spark, sf_dir, "reviews", "review_id", "order_id", "review_score")


def semi_join_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the orders of the test customers."""
    return rounded(of_test_orders(spark, sf_dir, "items", "order_id", "order_item_id", "product_id", "price"))


def semi_join_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments of the orders of the test customers."""
    return rounded(of_test_orders(spark, sf_dir, "payments", "order_id", "payment_sequential", "payment_type", "payment_value"))


def of_test_orders(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    test = stratified_split(spark, sf_dir).where(F.col("split") == "test")
    orders = lookup_join(shop.orders.select("order_id", "customer_id"), test, "customer_id", "left_semi")
    return lookup_join(getattr(shop, table).select(*columns), orders, "order_id", "left_semi")


def churn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.churn_features(load_shop(spark, sf_dir)))


def churn_features_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second feature set as a whole, with the mean polarity of the reviews."""
    shop = load_shop(spark, sf_dir)
    return rounded(ops.churn_features(shop, variant="module", lexicon=lexicon(shop.reviews)))


def cancellation_features_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.cancellation_features(load_shop(spark, sf_dir).orders, variant="module"))


def churn_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.churn_dataset(load_shop(spark, sf_dir)))


def constant_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values per feature on the training split, and whether the feature is constant."""
    dataset = materialize(ops.churn_dataset(load_shop(spark, sf_dir)))
    ignored = ("customer_id", "split", "is_churned", "days_since_last_order")
    columns = [c for c in dataset.columns if c not in ignored]
    train = dataset.where(F.col("split") == "train")
    constant = ops.constant_features(train, columns)
    spread = train.agg(*(F.min(c).cast("double").alias(c) for c in columns)).unpivot([], columns, "feature", "minimum")
    return rounded(spread.withColumn("is_constant", F.col("feature").isin(*constant).cast("int") if constant else F.lit(0)))


SCALED = ["payment_value", "delivery_days_diff_mean", "delivery_actual_days_mean", "cancellation_ratio"]


def scaling_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = load_shop(spark, sf_dir)
    spine = ops.stratified_split(ops.churn_labels(shop.orders)).select("customer_id", "split")
    return materialize(
        spine.join(ops.payment_features(shop.payments, shop.orders), "customer_id", "left")
        .join(ops.delivery_features(shop.orders), "customer_id", "left")
        .join(ops.cancellation_features(shop.orders), "customer_id", "left")
        .fillna(0)
        .select("customer_id", "split", *SCALED)
    )


def standard_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = scaling_input(spark, sf_dir)
    return rounded(standard_scale(data, SCALED, fit_on=data.where(F.col("split") == "train")))


def robust_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(robust_scale(scaling_input(spark, sf_dir), ["customer_id"], SCALED))


def null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = load_shop(spark, sf_dir).reviews
    return ops.null_rates(reviews, ["review_id", "order_id", "review_score", "review_comment_message"])


def order_delivery_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.order_delivery_features(load_shop(spark, sf_dir).orders)


def monthly_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.monthly_churn(load_shop(spark, sf_dir).orders)


QUERIES = {
    "churn_labels": churn_labels,
    "churn_rate": churn_rate,
    "stratified_split": stratified_split,
    "class_balance": class_balance,
    "delivered_orders": delivered_orders,
    "date_arithmetic": date_arithmetic,
    "delivery_features": delivery_features,
    "delivery_features_module": delivery_features_module,
    "delivery_promise_features": delivery_promise_features,
    "winsorize": winsorize,
    "log_ratios": log_ratios,
    "customer_spine": customer_spine,
    "delivery_features_scaled": delivery_features_scaled,
    "describe_features": describe_features,
    "review_features": review_features,
    "learned_lexicon": learned_lexicon,
    "lexicon_agreement": lexicon_agreement,
    "review_sentiment": review_sentiment,
    "review_sentiment_scaled": review_sentiment_scaled,
    "sentiment_class": sentiment_class,
    "historical_window": historical_window,
    "rfm_historical": rfm_historical,
    "rfm_historical_module": rfm_historical_module,
    "rfm_historical_deduped": rfm_historical_deduped,
    "rfm_shipping_features": rfm_shipping_features,
    "payment_features": payment_features,
    "payment_features_module": payment_features_module,
    "payment_complexity": payment_complexity,
    "cancellation_features": cancellation_features,
    "semi_join_split": semi_join_split,
    "semi_join_items": semi_join_items,
    "semi_join_payments": semi_join_payments,
    "churn_features": churn_features,
    "churn_features_module": churn_features_module,
    "cancellation_features_module": cancellation_features_module,
    "churn_dataset": churn_dataset,
    "constant_features": constant_features,
    "standard_scale": standard_scaled,
    "robust_scale": robust_scaled,
    "null_rates": null_rates,
    "order_delivery_features": order_delivery_features,
    "monthly_churn": monthly_churn,
}
