"""Churn labels, split and feature blocks, one row per customer.

Orders carry their customer's split as a column, so the features of all splits come
from one pass. Lines are reduced to one row per order before they meet the orders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.functions.expressions import (
    count_if,
    flag,
    floor_days,
    plus_months,
    polarity_class,
    ratio,
    round_half_even,
)
from patronage.functions.joins import lookup_join
from patronage.operators.customers import CUSTOMER, latest_purchase, order_payments, order_reviews
from patronage.operators.ordering import exact_quantiles, unpivot, value_quantiles
from patronage.operators.scaling import robust_scale
from patronage.session import materialize
from patronage.sources.shop import Shop

SEED = 42
CHURN_MONTHS = 6
SPLITS = ("train", "val", "test")

# fixed values: learned on the training split; used when no thresholds are given
DEFAULT_THRESHOLDS = {"hist_value": 50.0, "hist_freq": 1.0}


# ---- labels and split ----------------------------------------------------------------------


def label_measures(orders: DataFrame, months: int = CHURN_MONTHS) -> list[Column]:
    """Columns over the last purchase of a customer."""
    latest = latest_purchase(orders)
    return [
        flag(F.col("last_purchase") < plus_months(latest, -months)).alias("is_churned"),
        floor_days(latest, F.col("last_purchase")).alias("days_since_last_order"),
    ]


def churn_labels(orders: DataFrame, customer: str = CUSTOMER, months: int = CHURN_MONTHS) -> DataFrame:
    """Churned means: no purchase in the last `months` months of the whole table."""
    return (
        orders.where(F.col(customer).isNotNull())
        .groupBy(customer)
        .agg(F.max("order_purchase_timestamp").alias("last_purchase"))
        .select(customer, "last_purchase", *label_measures(orders, months))
    )


def stratified_split(
    labels: DataFrame, customer: str = CUSTOMER, seed: int = SEED, test: float = 0.1, val: float = 0.1
) -> DataFrame:
    """Adds the split: in every class the given shares of the customers, to within one customer.

    The customers of a class are ranked by a digest of seed and key. Only the digests at the two cuts
    are looked up, per class; every row is then compared with the cuts of its own class.
    """
    digest = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}-"), F.col(customer).cast("string"))), 1, 13), 16, 10)
    numbered = materialize(labels.withColumn("_digest", digest.cast("double")))
    cuts = value_quantiles(numbered, ["_digest"], [test, test + val], by=["is_churned"]).collect()
    split = F.lit("train")
    for row in cuts:
        own = F.col("is_churned").eqNullSafe(F.lit(row["is_churned"]))
        inside = F.when(F.col("_digest") <= F.lit(row["q0"]), "test").when(F.col("_digest") <= F.lit(row["q1"]), "val")
        split = F.when(own, inside.otherwise("train")).otherwise(split)
    return numbered.withColumn("split", split).drop("_digest")


def customer_splits(orders: DataFrame, customer: str = CUSTOMER, seed: int = SEED) -> DataFrame:
    """Label, last purchase and split of every customer."""
    return stratified_split(churn_labels(orders, customer), customer, seed)


def class_balance(labels: DataFrame) -> DataFrame:
    """Customers, churned customers and churn rate per split."""
    return labels.groupBy("split").agg(
        F.count("*").alias("customers"),
        F.sum("is_churned").alias("churned"),
        F.avg("is_churned").alias("churn_rate"),
    )


# ---- delivery ------------------------------------------------------------------------------


def is_delivered() -> Column:
    """Delivered, with both the delivery and the promised date."""
    return (
        (F.col("order_status") == "delivered")
        & F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull()
    )


def delivered_orders(orders: DataFrame) -> DataFrame:
    return orders.where(is_delivered())


def delivery_days() -> dict[str, Column]:
    """Days late, days taken and days promised of an order, null unless it was delivered."""
    return {
        "days_diff": F.when(is_delivered(), floor_days("order_delivered_customer_date", "order_estimated_delivery_date")),
        "actual_days": F.when(is_delivered(), floor_days("order_delivered_customer_date", "order_purchase_timestamp")),
        "promised_days": F.when(is_delivered(), floor_days("order_estimated_delivery_date", "order_purchase_timestamp")),
    }


# names of the same delivery measures in the two feature sets
FLOW_DELIVERY = {
    "diff_mean": "delivery_days_diff_mean",
    "actual_mean": "delivery_actual_days_mean",
    "actual_std": "delivery_actual_days_std",
    "late": "delivery_late_ratio",
    "slow": "delivery_slow_ratio",
    "very_slow": "delivery_very_slow_ratio",
    "often_late": "delivery_consistently_late",
    "often_slow": "delivery_frequently_slow",
    "any_very_slow": "delivery_has_very_slow",
    "uneven": "delivery_inconsistent",
    "score": "delivery_dissatisfaction_score",
    "unhappy": "delivery_likely_dissatisfied",
    "fast": "delivery_speed_fast",
    "normal": "delivery_speed_normal",
    "slowish": "delivery_speed_slow",
    "slowest": "delivery_speed_very_slow",
}
MODULE_DELIVERY = {
    **FLOW_DELIVERY,
    "uneven": "delivery_inconsistent_delivery",
    "score": "delivery_dissatisfaction",
}


def delivery_aggregates() -> list[Column]:
    return [
        F.avg("days_diff").alias("_diff"),
        F.avg("actual_days").alias("_actual"),
        F.stddev_samp("actual_days").alias("_spread"),
        F.count("days_diff").alias("_delivered"),
        count_if(F.col("days_diff") > 0).alias("_late"),
        count_if(F.col("actual_days") > 7).alias("_slow"),
        count_if(F.col("actual_days") > 14).alias("_very_slow"),
    ]


def delivery_measures(variant: str = "flow") -> list[Column]:
    """Columns over `delivery_aggregates`. Flags read the rounded means."""
    share = {name: F.col(f"_{name}") / F.nullif(F.col("_delivered"), F.lit(0)) for name in ("late", "slow", "very_slow")}
    mean, spread = round_half_even(F.col("_actual"), 2), round_half_even(F.col("_spread"), 2)
    score = share["late"] * 0.3 + share["slow"] * 0.4 + share["very_slow"] * 0.3
    measures = {
        "diff_mean": round_half_even(F.col("_diff"), 2),
        "actual_mean": mean,
        "actual_std": F.coalesce(spread, F.lit(0.0)) if variant == "flow" else spread,
        **share,
        "often_late": flag(share["late"] > 0.5),
        "often_slow": flag(share["slow"] > 0.3),
        "any_very_slow": flag(share["very_slow"] > 0),
        "uneven": flag(spread > 5),
        "score": score,
        "unhappy": flag(score > 0.3),
        "fast": flag(mean <= 3),
        "normal": flag((mean > 3) & (mean <= 7)),
        "slowish": flag((mean > 7) & (mean <= 14)),
        "slowest": flag(mean > 14),
    }
    names = FLOW_DELIVERY if variant == "flow" else MODULE_DELIVERY
    return [measures[measure].alias(name) for measure, name in names.items()]


def delivery_features(orders: DataFrame, customer: str = CUSTOMER, variant: str = "flow") -> DataFrame:
    """Lateness against the promise, speed, and flags derived from both.

    The spread of a single delivery is 0 in the `flow` variant and unknown in the
    `module` variant, with the same flag.
    """
    return (
        delivered_orders(orders)
        .where(F.col(customer).isNotNull())
        .withColumns(delivery_days())
        .groupBy(customer)
        .agg(*delivery_aggregates())
        .select(customer, *delivery_measures(variant))
    )


def delivery_promise_features(orders: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Mean and worst lateness, promised time, shares of late, very late and long promises."""
    return (
        delivered_orders(orders)
        .where(F.col(customer).isNotNull())
        .withColumns(delivery_days())
        .groupBy(customer)
        .agg(
            round_half_even(F.avg("days_diff"), 2).alias("delivery_days_diff_mean"),
            F.max("days_diff").alias("delivery_days_diff_max"),
            round_half_even(F.avg("actual_days"), 2).alias("delivery_delivery_actual_days_mean"),
            round_half_even(F.avg("promised_days"), 2).alias("delivery_delivery_promised_days_mean"),
            F.count("order_id").alias("delivery_order_id_count"),
            (count_if(F.col("days_diff") > 0) / F.count("*")).alias("delivery_late_ratio"),
            (count_if(F.col("days_diff") > 5) / F.count("*")).alias("delivery_very_late_ratio"),
            (count_if(F.col("promised_days") > 20) / F.count("*")).alias("delivery_long_promise_ratio"),
        )
    )


LATENESS = ["delivery_days_diff_mean", "delivery_days_diff_max"]
LATENESS_RATIOS = ["delivery_late_ratio", "delivery_very_late_ratio", "delivery_long_promise_ratio"]


def winsorize(df: DataFrame, columns: list[str], limit: float = 30.0) -> DataFrame:
    """Cap values at plus and minus `limit`; unknown values stay unknown."""
    return df.withColumns(
        {
            c: F.when(F.col(c) > limit, limit).when(F.col(c) < -limit, -limit).otherwise(F.col(c).cast("double"))
            for c in columns
        }
    )


def log_ratios(df: DataFrame, columns: list[str], eps: float = 1e-3) -> DataFrame:
    """Adds `<name>_log`, the logarithm shifted so that 0 stays defined."""
    return df.withColumns({f"{c}_log": F.ln(F.col(c) + F.lit(eps)) for c in columns})


def customer_spine(customers: DataFrame, features: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Every customer once, with 0 where it has no features."""
    return customers.select(customer).distinct().join(features, customer, "left").fillna(0)


def delivery_features_scaled(orders: DataFrame, customers: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Promise features capped, logged, spread over all customers and robust-scaled.

    The number of deliveries is dropped. All other columns are scaled.
    """
    features = delivery_promise_features(orders, customer).drop("delivery_order_id_count")
    cleaned = log_ratios(winsorize(features, LATENESS), LATENESS_RATIOS)
    spread = materialize(customer_spine(customers, cleaned, customer))
    return robust_scale(spread, [customer], [c for c in spread.columns if c != customer])


# ---- reviews -------------------------------------------------------------------------------


def score_aggregates() -> list[Column]:
    """Over the review counts of each order."""
    return [
        F.sum("score").alias("_score"),
        F.sum("n_scores").alias("_scores"),
        F.min("worst_score").alias("review_review_score_min"),
        F.sum("n_bad").alias("_bad"),
    ]


def score_measures() -> list[Column]:
    scores = F.nullif(F.col("_scores"), F.lit(0))
    mean = round_half_even(F.col("_score") / scores, 2)
    return [
        mean.alias("review_review_score_mean"),
        F.col("review_review_score_min"),
        (F.col("_bad") / scores).alias("review_bad_ratio"),
        flag(mean < 3.5).alias("review_dissatisfied"),
    ]


def review_features(
    reviews: DataFrame,
    orders: DataFrame,
    customer: str = CUSTOMER,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Mean and worst score, share of scores up to 2, flag for a mean below 3.5.

    Scores are summed per order first. With a lexicon the mean polarity of the review
    texts is added.
    """
    scored = reviews.dropna(subset=["review_score"])
    owners = orders.where(F.col(customer).isNotNull()).select("order_id", customer)
    result = (
        order_reviews(scored)
        .join(owners, "order_id")
        .groupBy(customer)
        .agg(*score_aggregates())
        .select(customer, *score_measures())
    )
    if lexicon is None:
        return result
    return result.join(review_sentiment_mean(scored, owners, lexicon, customer), customer, "left")


def review_sentiment_mean(
    scored: DataFrame, owners: DataFrame, lexicon: DataFrame, customer: str = CUSTOMER
) -> DataFrame:
    """Mean polarity of the written reviews of each customer."""
    return (
        review_polarity(scored, lexicon)
        .join(owners, "order_id")
        .groupBy(customer)
        .agg(F.avg("polarity").alias("review_sentiment_mean"))
    )


#: weight of the prior in words, and the number of deviations from no difference that a word of the lexicon needs
PRIOR_WORDS, CERTAIN = 500.0, 1.96


def learn_lexicon(reviews: DataFrame, prior: float = PRIOR_WORDS, certain: float = CERTAIN) -> DataFrame:
    """Words that set reviews with a score of 4 or more apart from those with 2 or less: word, high, low, polarity.

    The measure is the difference of the log odds of a word in both, with a Dirichlet prior of `prior` words in the
    proportions of all these reviews; a word belongs to the lexicon when it differs from none by `certain`
    deviations. Polarity is that difference on a scale from -1 to 1. Words are counted where the reviews lie, so
    one row a word and partition is shuffled; the counts are stored.
    """
    score = F.col("review_score")
    words = F.explode(F.split(F.lower("review_comment_message"), r"[^\p{L}]+"))
    said = reviews.where((score >= 4) | (score <= 2)).select((score >= 4).cast("int").alias("high"), words.alias("word"))
    counts = materialize(
        said.where(F.col("word") != "").groupBy("word").agg(F.sum("high").alias("high"), F.sum(1 - F.col("high")).alias("low"))
    )
    total = counts.agg(F.struct(*(F.sum(side).cast("double").alias(side) for side in ("high", "low")))).scalar()
    share = F.lit(prior) * (F.col("high") + F.col("low")) / (total["high"] + total["low"])

    def odds(side: str) -> Column:
        seen = F.col(side) + F.col("share")
        return F.log(seen / F.nullif(total[side] + prior - seen, F.lit(0.0)))

    difference = odds("high") - odds("low")
    deviation = F.sqrt(1 / (F.col("high") + F.col("share")) + 1 / (F.col("low") + F.col("share")))
    measured = counts.withColumn("share", share).withColumns({"difference": difference, "deviation": deviation})
    polarity = F.round(2 / (1 + F.exp(-F.col("difference"))) - 1, 6)
    certainly = F.abs("difference") >= F.lit(certain) * F.col("deviation")
    return measured.where(certainly).select("word", "high", "low", polarity.alias("polarity"))


def lexicon_agreement(reviews: DataFrame, lexicon: DataFrame) -> DataFrame:
    """How often the sign of a review's polarity agrees with its score, over clear scores and known words."""
    score = F.col("review_score")
    judged = review_polarity(reviews.where((score >= 4) | (score <= 2)), lexicon)
    agrees = (F.col("polarity") > 0) == (score >= 4)
    known = F.col("polarity") != 0
    return judged.agg(
        F.count("*").alias("reviews"),
        F.count_if(known).alias("with_polarity"),
        F.count_if(known & agrees).alias("agreeing"),
        (F.count_if(known & agrees) / F.nullif(F.count_if(known), F.lit(0))).alias("agreement"),
    )


def held_out_reviews(key: str = "review_id", folds: int = 5) -> Column:
    """A fifth of the reviews by a digest of their id."""
    digest = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return digest % folds == 0


def review_polarity(reviews: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Mean polarity of the lexicon words in each review text, 0 when none occurs.

    Texts are split into words where they lie. With a broadcast lexicon the words of a
    review stay in its partition, and the partial aggregation shuffles one small row per
    review. A review is identified by review and order, because review ids may repeat. The
    mean is rounded to ten digits: the order of summation must not decide on which side of
    a class limit it falls.
    """
    words = F.explode_outer(F.split(F.lower("review_comment_message"), r"[^\p{L}]+"))
    spoken = reviews.dropna(subset=["review_comment_message"]).select(
        "review_id", "order_id", "review_score", words.alias("word")
    )
    return (
        lookup_join(spoken, lexicon.select("word", "polarity"), "word")
        .groupBy("review_id", "order_id")
        .agg(
            F.max("review_score").alias("review_score"),
            F.coalesce(F.round(F.avg("polarity"), 10), F.lit(0.0)).alias("polarity"),
        )
    )


def review_sentiment(
    reviews: DataFrame, orders: DataFrame, lexicon: DataFrame, customer: str = CUSTOMER, scaled: bool = False
) -> DataFrame:
    """Sentiment of written reviews, and how often it contradicts the score, for every
    customer with orders."""
    owners = orders.where(F.col(customer).isNotNull()).select("order_id", customer)
    tagged = review_polarity(reviews, lexicon).withColumn("tone", polarity_class(F.col("polarity")))
    score = F.col("review_score")
    mismatch = ((score >= 4) & (F.col("tone") == "negative")) | ((score <= 2) & (F.col("tone") == "positive"))
    grouped = (
        tagged.join(owners, "order_id")
        .groupBy(customer)
        .agg(
            F.count("*").alias("n"),
            round_half_even(F.avg("review_score"), 3).alias("review_score_mean"),
            F.min("review_score").alias("review_score_min"),
            round_half_even(F.avg("polarity"), 3).alias("sentiment_mean"),
            round_half_even(F.stddev_samp("polarity"), 3).alias("sentiment_std"),
            count_if(mismatch).alias("n_mismatch"),
            count_if(F.col("tone") == "negative").alias("n_negative"),
        )
        .withColumns(
            {
                "has_review": F.lit(1),
                "negative_ratio": F.col("n_negative") / F.col("n"),
                "mismatch_ratio": F.col("n_mismatch") / F.col("n"),
            }
        )
        .drop("n", "n_mismatch", "n_negative")
    )
    result = customer_spine(orders.where(F.col(customer).isNotNull()), grouped, customer)
    if not scaled:
        return result
    numbers = [c for c in result.columns if c not in (customer, "has_review")]
    return robust_scale(materialize(result), [customer], numbers)


# ---- spend in the historical window --------------------------------------------------------


def in_window(orders: DataFrame, months: int = CHURN_MONTHS, splits: DataFrame | None = None) -> Column:
    """From `2 * months` to `months` months before the last purchase, both ends included.

    With `splits` the last purchase is that of the row's own split (column `split`), as when every
    split is built alone. The dates are one scalar subquery.
    """
    when = F.col("order_purchase_timestamp")

    def between(latest: Column) -> Column:
        end = plus_months(latest, -months)
        return (when >= plus_months(end, -months)) & (when <= end)

    if splits is None:
        return between(latest_purchase(orders))
    last = F.struct(*(F.max(F.when(F.col("split") == name, F.col("last_purchase"))).alias(name) for name in SPLITS))
    latest = splits.agg(last).scalar()
    return reduce(lambda a, b: a | b, ((F.col("split") == name) & between(latest[name]) for name in SPLITS))


def historical_window(orders: DataFrame, months: int = CHURN_MONTHS) -> DataFrame:
    return orders.where(in_window(orders, months))


def order_lines(items: DataFrame) -> DataFrame:
    """Item rows, price and freight per order."""
    return items.groupBy("order_id").agg(
        F.count("*").alias("n_items"),
        F.sum("price").alias("price"),
        F.sum("freight_value").alias("freight"),
        F.count("freight_value").alias("n_freight"),
    )


def order_repeats(dedupe: bool) -> Column:
    """How often an order counts: once per item row (at least once), or once with `dedupe`."""
    return F.lit(1).cast("bigint") if dedupe else F.greatest(F.coalesce("n_items", F.lit(0)), F.lit(1)).cast("bigint")


HISTORY_NAMES = {
    "flow": ("rfm_hist_monthly_orders", "rfm_hist_payment_value_mean"),
    "module": ("rfm_hist_monthly_orders", "rfm_hist_spend_mean"),
}


def history_aggregates(inside: Column, dedupe: bool = False) -> list[Column]:
    """Over one row per order with its lines and payments, for the orders where `inside` holds.

    Payments were joined per item row in the original measure, so an order with three
    items counts three times, in spend too. The repeats are computed from the number of
    items instead of being produced by a join; `dedupe=True` counts orders once.
    """
    repeats, paid = order_repeats(dedupe), F.col("paid")

    def total(x: Column) -> Column:
        return F.sum(F.when(inside, x))

    return [
        total(repeats).alias("_rows"),
        total(paid * repeats).alias("_paid"),
        total(F.when(paid.isNotNull(), repeats)).alias("_paid_rows"),
        total(F.col("freight")).alias("_freight"),
        total(F.col("price")).alias("_price"),
    ]


def history_measures(variant: str = "flow", months: int = CHURN_MONTHS) -> list[Column]:
    """Columns over `history_aggregates`; `_spend` is null for customers without such orders."""
    monthly = F.col("_rows") / F.lit(months)
    spend = F.coalesce("_paid", F.lit(0.0))
    freight, price = (round_half_even(F.coalesce(c, F.lit(0.0)), 2) for c in ("_freight", "_price"))
    monthly_name, spend_name = HISTORY_NAMES[variant]
    return [
        (round_half_even(monthly, 2) if variant == "module" else monthly).alias(monthly_name),
        round_half_even(F.col("_paid") / F.nullif(F.col("_paid_rows"), F.lit(0)), 2).alias(spend_name),
        ratio(freight, price).alias("rfm_hist_shipping_ratio"),
        F.when(F.col("_rows").isNotNull(), round_half_even(spend, 2)).alias("_spend"),
    ]


def learn_thresholds(history: DataFrame, customer: str = CUSTOMER) -> dict[str, float]:
    """Upper quartiles of spend and order rate among the training customers with history."""
    train = history.where((F.col("split") == "train") & F.col("_spend").isNotNull())
    found = exact_quantiles(train, ["_spend", "rfm_hist_monthly_orders"], [0.75])
    if not found:
        return dict(DEFAULT_THRESHOLDS)
    return {"hist_value": found["_spend"][0], "hist_freq": found["rfm_hist_monthly_orders"][0]}


def flag_history(history: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    return history.withColumns(
        {
            "rfm_hist_was_valuable": flag(F.col("_spend") > F.lit(thresholds["hist_value"])),
            "rfm_hist_was_frequent": flag(F.col("rfm_hist_monthly_orders") > F.lit(thresholds["hist_freq"])),
        }
    ).drop("_spend")


def rfm_historical(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    customer: str = CUSTOMER,
    thresholds: dict[str, float] | None = None,
    variant: str = "flow",
    dedupe: bool = False,
    by_split: bool = True,
    seed: int = SEED,
) -> DataFrame:
    """Historical window features; thresholds are learned on the training split if not given."""
    splits = customer_splits(orders, customer, seed) if by_split else None
    rows = orders.where(F.col(customer).isNotNull())
    if by_split:
        rows = rows.join(splits.select(customer, "split"), customer)
    else:
        rows = rows.withColumn("split", F.lit("train"))
    history = (
        rows.where(in_window(orders, splits=splits))
        .select("order_id", customer, "split")
        .join(order_lines(items), "order_id", "left")
        .join(order_payments(payments), "order_id", "left")
        .groupBy(customer)
        .agg(F.max("split").alias("split"), *history_aggregates(F.lit(True), dedupe))
        .select(customer, "split", *history_measures(variant))
    )
    if thresholds is None:
        history = materialize(history)
        thresholds = learn_thresholds(history, customer)
    return flag_history(history, thresholds).drop("split")


def rfm_shipping_features(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    customer: str = CUSTOMER,
    dedupe: bool = False,
    scaled: bool = True,
) -> DataFrame:
    """Recency, spend and shipping share over all orders, with fixed and learned flags.

    Repeats per item row as in `history_aggregates`.
    """
    features = (
        orders.where(F.col(customer).isNotNull())
        .select("order_id", customer, "order_purchase_timestamp")
        .join(order_lines(items), "order_id", "left")
        .join(order_payments(payments), "order_id", "left")
        .groupBy(customer)
        .agg(
            F.max("order_purchase_timestamp").alias("last_purchase"),
            *history_aggregates(F.lit(True), dedupe),
            F.sum("n_freight").alias("_n_freight"),
        )
        .select(
            customer,
            F.col("_rows").alias("frequency"),
            round_half_even(F.coalesce("_paid", F.lit(0.0)), 2).alias("total_spend"),
            round_half_even(F.col("_paid") / F.nullif(F.col("_paid_rows"), F.lit(0)), 2).alias("avg_order_value"),
            round_half_even(F.col("_freight") / F.nullif(F.col("_n_freight"), F.lit(0)), 2).alias("avg_shipping"),
            floor_days(latest_purchase(orders), F.col("last_purchase")).alias("recency_days"),
        )
        .withColumn("shipping_ratio", ratio(F.col("avg_shipping"), F.col("avg_order_value")))
    )
    features = materialize(features)
    # without customers there is nothing to learn and nothing to flag
    upper, top = exact_quantiles(features, ["shipping_ratio"], [0.75, 0.9]).get("shipping_ratio", (0.0, 0.0))
    limits = {"5pct": 0.05, "10pct": 0.1, "15pct": 0.15, "20pct": 0.2, "75pct": upper, "90pct": top}
    flagged = features.withColumns(
        {f"ship_above_{name}": flag(F.col("shipping_ratio") > F.lit(limit)) for name, limit in limits.items()}
    )
    numbers = ["recency_days", "frequency", "total_spend", "avg_order_value", "avg_shipping", "shipping_ratio"]
    return robust_scale(flagged, [customer], numbers) if scaled else flagged


# ---- payments ------------------------------------------------------------------------------


# source column and name of the payment means; the first and the type mean feed the flags
PAYMENT_MEANS = {
    "flow": {"install_max": "payment_installments", "n_types": "payment_type", "paid": "payment_value"},
    "module": {
        "install_max": "payment_install_max_mean",
        "install_mean": "payment_install_mean_mean",
        "n_types": "payment_type_nunique_mean",
        "value_mean": "payment_payment_mean_mean",
    },
}


def payment_aggregates(variant: str = "flow") -> list[Column]:
    return [F.avg(source).alias(f"_mean_{source}") for source in PAYMENT_MEANS[variant]]


def payment_measures(variant: str = "flow") -> list[Column]:
    means = {source: round_half_even(F.col(f"_mean_{source}"), 2) for source in PAYMENT_MEANS[variant]}
    return [
        *(means[source].alias(name) for source, name in PAYMENT_MEANS[variant].items()),
        flag(means["install_max"] > 6).alias("payment_high_installments"),
        flag(means["n_types"] > 1).alias("payment_multiple_types"),
    ]


def payment_features(
    payments: DataFrame, orders: DataFrame, customer: str = CUSTOMER, variant: str = "flow"
) -> DataFrame:
    """Means over orders of the largest instalment count, number of types and value, two flags."""
    return (
        orders.where(F.col(customer).isNotNull())
        .select("order_id", customer)
        .join(order_payments(payments), "order_id", "left")
        .groupBy(customer)
        .agg(*payment_aggregates(variant))
        .select(customer, *payment_measures(variant))
    )


def payment_complexity(payments: DataFrame, orders: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Shares of orders with several methods, several types or many instalments, and a
    stress score from them. Shares are over the orders that have payments."""
    flags = order_payments(payments).select(
        "order_id",
        flag(F.col("n_methods") > 1).alias("methods"),
        flag(F.col("n_types") > 1).alias("types"),
        flag(F.col("install_max") > 6).alias("high"),
        "install_max",
    )
    return (
        orders.where(F.col(customer).isNotNull())
        .select("order_id", customer)
        .join(flags, "order_id", "left")
        .groupBy(customer)
        .agg(
            F.avg("methods").alias("pm_mean_methods"),
            F.avg("types").alias("pm_mean_types"),
            F.avg("high").alias("pm_mean_high_inst"),
            F.avg("install_max").alias("pm_mean_max_inst"),
            F.count("order_id").alias("num_orders"),
            F.coalesce(F.sum("methods"), F.lit(0)).alias("_methods"),
        )
        .select(
            customer,
            "pm_mean_methods",
            "pm_mean_types",
            "pm_mean_high_inst",
            "pm_mean_max_inst",
            "num_orders",
            (F.col("_methods") / F.when(F.col("num_orders") == 0, 1).otherwise(F.col("num_orders"))).alias(
                "complex_payment_ratio"
            ),
            round_half_even(
                F.col("pm_mean_high_inst") * 0.4
                + F.col("pm_mean_methods") * 0.3
                + (F.col("pm_mean_max_inst") / 12) * 0.3,
                3,
            ).alias("financial_stress_score"),
        )
    )


# ---- cancellations -------------------------------------------------------------------------

CANCELLATION_NAMES = {
    "flow": ("cancellation_ratio", "has_cancellations"),
    "module": ("cancel_ratio", "cancel_has_cancel"),
}


def cancellation_aggregates() -> list[Column]:
    return [F.count("order_id").alias("_orders"), count_if(F.col("order_status") == "canceled").alias("_canceled")]


def cancellation_measures(variant: str = "flow") -> list[Column]:
    share, any_canceled = CANCELLATION_NAMES[variant]
    return [
        ratio(F.col("_canceled"), F.col("_orders")).alias(share),
        flag(F.col("_canceled") > 0).alias(any_canceled),
    ]


def cancellation_features(orders: DataFrame, customer: str = CUSTOMER, variant: str = "flow") -> DataFrame:
    """Share of canceled orders and whether there is one."""
    grouped = orders.where(F.col(customer).isNotNull()).groupBy(customer).agg(*cancellation_aggregates())
    return grouped.select(customer, *cancellation_measures(variant))


# ---- assembly ------------------------------------------------------------------------------


def churn_dataset(
    shop: Shop,
    customer: str = CUSTOMER,
    thresholds: dict[str, float] | None = None,
    variant: str = "flow",
    seed: int = SEED,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """All feature blocks, the label and days since the last order for every customer with
    orders, and the customer's split; 0 where a block has nothing.

    Reviews, items and payments are reduced to one row per order, meet the orders once,
    and a single grouping by customer yields all blocks. The grouped rows are
    materialised when the thresholds have to be learned from them.
    """
    owners = shop.orders.where(F.col(customer).isNotNull())
    splits = customer_splits(shop.orders, customer, seed)
    facts = (
        owners.join(splits.select(customer, "split"), customer)
        .withColumns({**delivery_days(), "_inside": in_window(shop.orders, splits=splits)})
        .select("order_id", customer, "split", "order_status", "order_purchase_timestamp", "days_diff", "actual_days", "_inside")
        .join(order_reviews(shop.reviews), "order_id", "left")
        .join(order_lines(shop.items), "order_id", "left")
        .join(order_payments(shop.payments), "order_id", "left")
    )
    grouped = (
        facts.groupBy(customer)
        .agg(
            F.max("order_purchase_timestamp").alias("last_purchase"),
            F.max("split").alias("split"),
            *delivery_aggregates(),
            *score_aggregates(),
            *history_aggregates(F.col("_inside")),
            *payment_aggregates(variant),
            *cancellation_aggregates(),
        )
        .select(
            customer,
            "split",
            *delivery_measures(variant),
            *score_measures(),
            *history_measures(variant),
            *payment_measures(variant),
            *cancellation_measures(variant),
            *label_measures(shop.orders),
        )
    )
    if lexicon is not None:
        scored = shop.reviews.dropna(subset=["review_score"])
        sentiment = review_sentiment_mean(scored, owners.select("order_id", customer), lexicon, customer)
        grouped = grouped.join(sentiment, customer, "left")
    if thresholds is None:
        grouped = materialize(grouped)
        thresholds = learn_thresholds(grouped, customer)
    return flag_history(grouped, thresholds).fillna(0)


def churn_features(shop: Shop, customer: str = CUSTOMER, **options) -> DataFrame:
    """The feature blocks without label and recency."""
    return churn_dataset(shop, customer, **options).drop("is_churned", "days_since_last_order")


def order_delivery_features(orders: DataFrame) -> DataFrame:
    """Per delivered order: days promised, taken and late, purchase month and weekday, late label."""
    return delivered_orders(orders).withColumns(delivery_days()).select(
        "order_id",
        "promised_days",
        "actual_days",
        "days_diff",
        F.month("order_purchase_timestamp").alias("purchase_month"),
        F.dayofweek("order_purchase_timestamp").alias("purchase_weekday"),
        flag(F.col("days_diff") > 0).alias("is_late"),
    )


# ---- reports on features -------------------------------------------------------------------


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of nulls per column, three digits; one pass."""
    rates = df.agg(*(round_half_even(F.avg(F.isnull(c).cast("int")), 3).alias(c) for c in columns))
    return rates.unpivot([], columns, "column", "null_rate")


def describe_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, spread, extremes and exact quartiles, one row per feature."""
    df = materialize(df.select(*columns))
    moments = unpivot(df, [], columns).groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = value_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "feature", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75")
    )
    return moments.join(quartiles, "feature")


def constant_features(train: DataFrame, columns: list[str]) -> list[str]:
    """Columns with at most one distinct value (nulls do not count): minimum equals maximum."""
    row = train.agg(
        *(F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in columns)
    ).first()
    return [c for c in columns if row[c]]


def model_features(dataset: DataFrame, customer: str = CUSTOMER) -> list[str]:
    """Feature columns that vary on the training split."""
    ignored = {customer, "split", "is_churned", "days_since_last_order"}
    columns = [c for c in dataset.columns if c not in ignored]
    constant = set(constant_features(dataset.where(F.col("split") == "train"), columns))
    return [c for c in columns if c not in constant]


def monthly_churn(orders: DataFrame, customer: str = CUSTOMER, months: int = CHURN_MONTHS) -> DataFrame:
    """Monthly churn and retention from the orders themselves.

    At the end of a month a customer has churned when the last order so far is more than
    `months` months old. Orders are reduced to first and last per customer and month, so
    the window over a customer never holds more rows than there are months. A gap longer
    than `months` is one lapse and one return event; events are counted per month and
    accumulated over the months, which are as many rows as the period is long.
    """
    when = F.col("order_purchase_timestamp")
    monthly = (
        orders.where(F.col(customer).isNotNull() & when.isNotNull())
        .groupBy(customer, F.trunc(when, "month").alias("month"))
        .agg(F.min(when).alias("first_order"), F.max(when).alias("last_order"))
    )
    by_customer = Window.partitionBy(customer).orderBy("month")
    lapse = plus_months(F.col("last_order"), months)
    steps = monthly.select(
        "month",
        (F.lag("month").over(by_customer).isNull()).alias("is_new"),
        F.lead("first_order").over(by_customer).alias("next_order"),
        lapse.alias("lapse"),
    ).where(F.col("is_new") | F.col("next_order").isNull() | (F.col("next_order") > F.col("lapse")))
    gone = F.col("next_order").isNull() | (F.col("next_order") > F.col("lapse"))
    events = steps.select(
        F.explode(
            F.array(
                F.struct(F.col("month").alias("month"), F.col("is_new").cast("int").alias("joined"), F.lit(0).alias("churned")),
                F.struct(
                    F.trunc("lapse", "month").alias("month"), F.lit(0).alias("joined"), gone.cast("int").alias("churned")
                ),
                F.struct(
                    F.trunc("next_order", "month").alias("month"),
                    F.lit(0).alias("joined"),
                    F.when(F.col("next_order").isNotNull() & gone, -1).otherwise(0).alias("churned"),
                ),
            )
        ).alias("event")
    ).select("event.*")
    counted = events.groupBy("month").agg(F.sum("joined").alias("joined"), F.sum("churned").alias("churned"))
    calendar = orders.agg(
        F.explode(
            F.sequence(
                F.trunc(F.min("order_purchase_timestamp"), "month"),
                F.trunc(F.max("order_purchase_timestamp"), "month"),
                F.make_ym_interval(F.lit(0), F.lit(1)),
            )
        ).alias("month")
    )
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return (
        calendar.join(counted, "month", "left")
        .select(
            F.date_format("month", "yyyy-MM").alias("month"),
            F.sum(F.coalesce("joined", F.lit(0))).over(so_far).alias("totalCustomers"),
            F.sum(F.coalesce("churned", F.lit(0))).over(so_far).alias("churnedCustomers"),
        )
        .withColumn("churnRate", round_half_even(F.col("churnedCustomers") / F.col("totalCustomers"), 3))
        .withColumn("retentionRate", round_half_even(1 - F.col("churnedCustomers") / F.col("totalCustomers"), 3))
    )
