"""Customer features: recency, frequency, spend, payment, review, category, place.

Every block returns one row per customer. Line-level tables are first reduced to one
row per order (or per order and category), so a heavy order, product or customer is
collapsed on the map side before any shuffle or join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from patronage.functions.expressions import (
    cascade,
    count_above,
    count_if,
    fill_missing,
    floor_days,
    plus_days,
    ratio,
    round_half_even,
)
from patronage.functions.joins import lookup_join
from patronage.operators.ordering import (
    exact_quantiles,
    quantile_groups,
    quantiles_from,
    quintile_bounds,
    quintile_groups,
    quintile_of_rank,
    rows_at_places,
)
from patronage.session import materialize
from patronage.sources.shop import Shop

CUSTOMER = "customer_id"
SPEND_TIERS = [(0.9, "VIP"), (0.75, "High Value"), (0.5, "Medium Value"), (0.25, "Low Value")]
LOWEST_TIER = "Entry Level"


def latest_purchase(orders: DataFrame) -> Column:
    """The last purchase of the whole table, as a scalar subquery over one column."""
    return orders.agg(F.max("order_purchase_timestamp")).scalar()


def rfm_aggregates() -> list[Column]:
    when = F.col("order_purchase_timestamp")
    return [F.min(when).alias("first_order"), F.max(when).alias("last_order"), F.count(when).alias("frequency")]


def rfm_measures(orders: DataFrame) -> list[Column]:
    """Columns over `rfm_aggregates`; recency counts to the day after the last purchase of all."""
    analysis_date = plus_days(latest_purchase(orders), 1)
    return [
        F.col("first_order"),
        F.col("last_order"),
        F.col("frequency"),
        floor_days(analysis_date, F.col("last_order")).alias("recency_days"),
        floor_days("last_order", "first_order").alias("tenure_days"),
    ]


def rfm_base(orders: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """First and last order, number of orders, days since the last one, days between both."""
    grouped = orders.where(F.col(customer).isNotNull()).groupBy(customer).agg(*rfm_aggregates())
    return grouped.select(customer, *rfm_measures(orders))


def order_values(items: DataFrame) -> DataFrame:
    """Price, freight and their sum per order."""
    return (
        items.groupBy("order_id")
        .agg(F.sum("price").alias("total_price"), F.sum("freight_value").alias("total_freight"))
        .fillna(0.0, subset=["total_price", "total_freight"])
        .withColumn("total_value", F.col("total_price") + F.col("total_freight"))
    )


def order_value_join(orders: DataFrame, items: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Orders that have items, with their values. Both sides have one row per order."""
    return orders.select("order_id", customer).join(order_values(items), "order_id")


def monetary_aggregates() -> list[Column]:
    """Over one row per order; orders without items have no values and do not count."""
    return [
        F.sum("total_value").alias("total_spent"),
        F.avg("total_value").alias("avg_order_value"),
        F.sum("total_freight").alias("total_freight"),
        F.avg("total_freight").alias("avg_freight"),
    ]


def monetary(orders: DataFrame, items: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Spend including freight; the average order value counts price plus freight."""
    joined = order_value_join(orders, items, customer).where(F.col(customer).isNotNull())
    return joined.groupBy(customer).agg(*monetary_aggregates())


def monetary_price_only(orders: DataFrame, items: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Second definition of the averages: `avg_order_value` is the mean of the price alone."""
    means = (
        order_value_join(orders, items, customer)
        .where(F.col(customer).isNotNull())
        .groupBy(customer)
        .agg(
            F.sum("total_price").alias("total_price"),
            F.avg("total_price").alias("avg_order_value"),
            F.sum("total_freight").alias("total_freight"),
            F.avg("total_freight").alias("avg_freight"),
            F.sum("total_value").alias("total_spent"),
            F.avg("total_value").alias("avg_total_value"),
        )
    )
    return means.select(customer, *(round_half_even(F.col(c), 2).alias(c) for c in means.columns[1:]))


def _most_frequent(value: str, weight: str, fallback: str) -> Column:
    """Value with the largest weight, the smallest value on ties, nulls ignored."""
    best = F.min(F.when(F.col(value).isNotNull(), F.struct(-F.col(weight), F.col(value))))
    return F.coalesce(best[value], F.lit(fallback))


def order_payments(payments: DataFrame) -> DataFrame:
    """One row per order: instalments, values, payments and the number of their types."""
    grouped = payments.groupBy("order_id").agg(
        F.max("payment_installments").alias("install_max"),
        F.sum("payment_installments").alias("sum_inst"),
        F.count("payment_installments").alias("n_inst"),
        F.sum("payment_value").alias("sum_value"),
        F.count("payment_value").alias("n_value"),
        F.max("payment_sequential").alias("n_methods"),
        F.count_distinct("payment_type").alias("n_types"),
    )
    return grouped.withColumns(
        {
            "install_mean": F.col("sum_inst") / F.nullif(F.col("n_inst"), F.lit(0)),
            "paid": F.coalesce("sum_value", F.lit(0.0)),
            "value_mean": F.col("sum_value") / F.nullif(F.col("n_value"), F.lit(0)),
        }
    )


def payment_behavior(
    payments: DataFrame, orders: DataFrame, customer: str = CUSTOMER, fallback: str = "unknown"
) -> DataFrame:
    """Preferred type, mean instalments, total paid and number of types.

    Payments are counted per order and type, then per customer and type, whatever the number of
    types. Payments without an order have no customer and drop out.
    """
    owners = orders.where(F.col(customer).isNotNull()).select("order_id", customer)
    per_order = payments.groupBy("order_id", "payment_type").agg(
        F.count("*").alias("n"),
        F.sum("payment_installments").alias("installments"),
        F.count("payment_installments").alias("n_installments"),
        F.sum("payment_value").alias("value"),
    )
    return (
        per_order.join(owners, "order_id")
        .groupBy(customer, "payment_type")
        .agg(*(F.sum(c).alias(c) for c in ("n", "installments", "n_installments", "value")))
        .groupBy(customer)
        .agg(
            _most_frequent("payment_type", "n", fallback).alias("preferred_payment_type"),
            round_half_even(F.sum("installments") / F.nullif(F.sum("n_installments"), F.lit(0)), 2).alias(
                "avg_installments"
            ),
            round_half_even(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("total_payment_value"),
            F.count("payment_type").alias("payment_diversity"),
        )
    )


def order_reviews(reviews: DataFrame) -> DataFrame:
    """Scores and texts per order."""
    return reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score"),
        F.count("review_score").alias("n_scores"),
        F.count("review_comment_message").alias("n_texts"),
        F.min("review_score").alias("worst_score"),
        count_if(F.col("review_score") <= 2).alias("n_bad"),
    )


def review_aggregates() -> list[Column]:
    return [
        F.sum("score").alias("_score"),
        F.coalesce(F.sum("n_scores"), F.lit(0)).alias("review_count"),
        F.coalesce(F.sum("n_texts"), F.lit(0)).alias("reviews_with_text"),
        F.count("order_purchase_timestamp").alias("_orders"),
    ]


def review_measures() -> list[Column]:
    return [
        (F.col("_score") / F.nullif(F.col("review_count"), F.lit(0))).alias("avg_review_score"),
        F.col("review_count"),
        F.col("reviews_with_text"),
        round_half_even(ratio(F.col("review_count"), F.col("_orders")), 2).alias("review_rate"),
    ]


def review_behavior(reviews: DataFrame, orders: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Mean score, scores given, reviews with text, scores per order.

    The rate can exceed 1, because an order may have several reviews.
    """
    return (
        orders.where(F.col(customer).isNotNull())
        .select("order_id", customer, "order_purchase_timestamp")
        .join(order_reviews(reviews), "order_id", "left")
        .groupBy(customer)
        .agg(*review_aggregates())
        .select(customer, *review_measures())
    )


def product_categories(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Product with its translated category, null where there is none."""
    return products.select("product_id", "product_category_name").join(
        categories.select("product_category_name", "product_category_name_english"),
        "product_category_name",
        "left",
    )


def items_with_category(items: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Every item with the category of its product."""
    return lookup_join(items, product_categories(products, categories), "product_id")


def category_counts(
    items: DataFrame, products: DataFrame, categories: DataFrame, orders: DataFrame, customer: str = CUSTOMER
) -> DataFrame:
    """Items per customer and category, counted per order before the customer is joined."""
    # lines of one order and product are combined before they meet the products
    lines = items.groupBy("order_id", "product_id").agg(F.count("*").alias("n"))
    per_order = (
        items_with_category(lines, products, categories)
        .groupBy("order_id", "product_category_name_english")
        .agg(F.sum("n").alias("n"))
    )
    return (
        per_order.join(orders.select("order_id", customer), "order_id")
        .where(F.col(customer).isNotNull())
        .groupBy(customer, "product_category_name_english")
        .agg(F.sum("n").alias("n"))
    )


def category_behavior(
    items: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    orders: DataFrame,
    customer: str = CUSTOMER,
    fallback: str = "other",
) -> DataFrame:
    """Number of categories and the preferred one."""
    return (
        category_counts(items, products, categories, orders, customer)
        .groupBy(customer)
        .agg(
            F.count("product_category_name_english").alias("category_diversity"),
            _most_frequent("product_category_name_english", "n", fallback).alias("preferred_category"),
        )
    )


def geo_info(customers: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """City and state per customer; of a key that repeats, the least."""
    least = F.min(F.struct("customer_city", "customer_state"))
    return (
        customers.groupBy(customer).agg(least.alias("place"))
        .select(customer, "place.customer_city", "place.customer_state")
    )


def customer_features(shop: Shop, customer: str = CUSTOMER) -> DataFrame:
    """All blocks on the customers that have orders; missing values become 0 or "0".

    Orders, item values and review counts meet once, one row per order, and give the recency,
    spend and review blocks in a single grouping. Every block is hash partitioned by customer,
    so assembling them adds no shuffle.
    """
    facts = (
        shop.orders.where(F.col(customer).isNotNull())
        .select("order_id", customer, "order_purchase_timestamp")
        .join(order_values(shop.items), "order_id", "left")
        .join(order_reviews(shop.reviews), "order_id", "left")
    )
    spent = ["total_spent", "avg_order_value", "total_freight", "avg_freight"]
    base = (
        facts.groupBy(customer)
        .agg(*rfm_aggregates(), *monetary_aggregates(), *review_aggregates())
        .select(customer, *rfm_measures(shop.orders), *spent, *review_measures())
    )
    payment = payment_behavior(shop.payments, shop.orders, customer)
    review = ["avg_review_score", "review_count", "reviews_with_text", "review_rate"]
    blocks = [
        payment,
        category_behavior(shop.items, shop.products, shop.categories, shop.orders, customer),
        geo_info(shop.customers, customer),
    ]
    joined = reduce(lambda left, right: left.join(right, customer, "left"), blocks, base)
    # payments stand before reviews
    first = [c for c in base.columns if c not in review]
    order = [*first, *payment.columns[1:], *review, *(c for block in blocks[1:] for c in block.columns[1:])]
    return fill_missing(joined.select(*order), keep=(customer, "first_order", "last_order"))


def spend_base(orders: DataFrame, items: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Recency, frequency and spend only: the input of scores and tiers."""
    facts = (
        orders.where(F.col(customer).isNotNull())
        .select("order_id", customer, "order_purchase_timestamp")
        .join(order_values(items), "order_id", "left")
    )
    grouped = facts.groupBy(customer).agg(*rfm_aggregates(), *monetary_aggregates())
    spent = ["total_spent", "avg_order_value", "total_freight", "avg_freight"]
    return grouped.select(customer, *rfm_measures(orders), *spent).fillna(0.0, subset=spent)


def add_rfm_scores(features: DataFrame, customer: str = CUSTOMER, tiers: bool = False) -> DataFrame:
    """R, F and M scores 1..5, their code, and on request the spend tier.

    R counts the recency quintile edges below the value (equal edges collapse into one
    score step). F and M are quintiles of the first-come rank, ties in customer order.
    `features` is read several times: materialise it when it is expensive.
    """
    recency, spend = [0.2, 0.4, 0.6, 0.8], [p for p, _ in SPEND_TIERS]
    narrow = features.select(
        customer, "frequency", F.col("recency_days").cast("double").alias("recency_days"), F.col("total_spent").cast("double").alias("total_spent")
    )
    picked = rows_at_places(
        narrow,
        {
            "recency_days": (["recency_days"], quantile_groups(recency)),
            "frequency": (["frequency", customer], quintile_groups),
            "total_spent": (["total_spent", customer], quintile_groups),
            "spend": (["total_spent"], quantile_groups(spend if tiers else [])),
        },
    )
    if not picked:  # no customers
        empty = {"R_score": "int", "F_score": "int", "M_score": "int", "RFM_score": "string"}
        empty |= {"value_segment": "string"} if tiers else {}
        return features.withColumns({c: F.lit(None).cast(kind) for c, kind in empty.items()})
    edges = quantiles_from(picked["recency_days"], recency)
    bounds = {feature: quintile_bounds(picked[feature]) for feature in ("frequency", "total_spent")}
    key = F.col(customer)
    scored = features.withColumns(
        {
            "R_score": F.lit(5) - count_above(F.col("recency_days"), edges),
            "F_score": quintile_of_rank(F.col("frequency"), key, bounds["frequency"]),
            "M_score": quintile_of_rank(F.col("total_spent"), key, bounds["total_spent"]),
        }
    ).withColumn("RFM_score", rfm_code(F.col("R_score"), F.col("F_score"), F.col("M_score")))
    if not tiers:
        return scored
    limits = quantiles_from(picked["spend"], spend)
    return scored.withColumn("value_segment", spend_tier(F.col("total_spent"), limits))


def rfm_code(r: Column, f: Column, m: Column) -> Column:
    return F.concat(r.cast("string"), f.cast("string"), m.cast("string"))


def spend_tier(spent: Column, limits: list[float]) -> Column:
    names = [name for _, name in SPEND_TIERS]
    return cascade([(spent >= F.lit(limit), F.lit(name)) for limit, name in zip(limits, names)], F.lit(LOWEST_TIER))


def value_segments(features: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Spend tier of every customer from the quartiles and the ninth decile of spend."""
    limits = exact_quantiles(features, ["total_spent"], [p for p, _ in SPEND_TIERS]).get("total_spent")
    if limits is None:  # no customers
        return features.withColumn("value_segment", F.lit(LOWEST_TIER))
    return features.withColumn("value_segment", spend_tier(F.col("total_spent"), limits))


def customer_master(shop: Shop, customer: str = CUSTOMER) -> DataFrame:
    """One row per customer with all features, scores and the spend tier.

    The features are written once to the checkpoint folder; ranking reads them from there.
    """
    return add_rfm_scores(materialize(customer_features(shop, customer)), customer, tiers=True)


def cltv_summary(orders: DataFrame, items: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Lifetime-value input: repeat orders, days between first and last order, days since
    the first order, mean order value."""
    return spend_base(orders, items, customer).select(
        customer,
        (F.col("frequency") - 1).alias("frequency"),
        F.col("tenure_days").alias("recency"),
        floor_days(latest_purchase(orders), F.col("first_order")).alias("age"),
        F.col("avg_order_value").alias("mean_value"),
    )


def quality_checks(df: DataFrame, key: str, not_null: list[str], ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Number of rows that break a rule: one row per check."""
    per_key = df.groupBy(key).agg(
        F.count("*").alias("n"),
        *(count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null),
        *(count_if(~F.col(c).between(lo, hi)).alias(f"range_{c}") for c, (lo, hi) in ranges.items()),
    )
    checks = [f"null_{c}" for c in not_null] + [f"range_{c}" for c in ranges] + ["duplicate_key"]
    totals = per_key.agg(
        *(F.sum(c).alias(c) for c in checks[:-1]),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_key"),
    )
    return totals.unpivot([], checks, "check", "violations").withColumn(
        "passed", (F.col("violations") == 0).cast("int")
    )
