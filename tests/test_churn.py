import pytest
from pyspark.sql import functions as F

from patronage.functions.joins import lookup_join
from patronage.operators import churn as c
from patronage.sources.shop import load_shop
from shop_data import order, same, shop

SF_DIR = "/root/testdata/sf0.001"


def by_customer(df):
    return {r["customer_id"]: r.asDict() for r in df.collect()}


def test_label_cutoff_is_exclusive(spark):
    orders = shop(
        spark,
        orders=[
            order("1", "latest", "2018-08-31 10:00:00"),
            order("2", "edge", "2018-02-28 10:00:00"),
            order("3", "gone", "2018-02-28 09:59:59"),
        ],
    ).orders
    rows = by_customer(c.churn_labels(orders))
    assert [rows[k]["is_churned"] for k in ("latest", "edge", "gone")] == [0, 0, 1]
    assert rows["gone"]["days_since_last_order"] == 184


def test_delivery_of_one_order(spark):
    orders = shop(
        spark,
        orders=[
            order("1", "x", "2018-01-01 00:00:00", "2018-01-10 09:00:00", "2018-01-10 10:00:00"),
            order("2", "x", "2018-01-01 00:00:00", None, "2018-01-10"),
            order("3", "y", "2018-01-01 00:00:00", "2018-01-05", "2018-01-10", status="shipped"),
        ],
    ).orders
    rows = by_customer(c.delivery_features(orders))
    assert set(rows) == {"x"}
    x = rows["x"]
    assert (x["delivery_days_diff_mean"], x["delivery_actual_days_mean"], x["delivery_actual_days_std"]) == (-1.0, 9.0, 0.0)
    assert (x["delivery_late_ratio"], x["delivery_slow_ratio"], x["delivery_inconsistent"]) == (0.0, 1.0, 0)
    assert x["delivery_dissatisfaction_score"] == 0.4 and x["delivery_likely_dissatisfied"] == 1
    module = by_customer(c.delivery_features(orders, variant="module"))["x"]
    assert module["delivery_actual_days_std"] is None and module["delivery_inconsistent_delivery"] == 0


def history_shop(spark, price=5.0):
    return shop(
        spark,
        orders=[order("1", "x", "2018-01-15"), order("2", "y", "2018-08-31")],
        items=[{"order_id": "1", "product_id": p, "price": price, "freight_value": 1.0} for p in "abc"],
        payments=[{"order_id": "1", "payment_type": "a", "payment_value": 10.0}],
    )


def test_spend_repeats_per_item_unless_deduped(spark):
    data = history_shop(spark)
    inputs = (data.orders, data.items, data.payments)
    limits = {"hist_value": 20.0, "hist_freq": 0.2}
    rows = by_customer(c.rfm_historical(*inputs, thresholds=limits, by_split=False))
    assert set(rows) == {"x"}
    assert rows["x"]["rfm_hist_monthly_orders"] == 0.5 and rows["x"]["rfm_hist_payment_value_mean"] == 10.0
    assert rows["x"]["rfm_hist_was_valuable"] == 1 and rows["x"]["rfm_hist_shipping_ratio"] == 0.2
    once = by_customer(c.rfm_historical(*inputs, thresholds=limits, by_split=False, dedupe=True))["x"]
    assert once["rfm_hist_monthly_orders"] == 1 / 6 and once["rfm_hist_was_valuable"] == 0


def test_shipping_ratio_without_price(spark):
    data = history_shop(spark, price=0.0)
    rows = by_customer(
        c.rfm_historical(data.orders, data.items, data.payments, thresholds=dict(c.DEFAULT_THRESHOLDS), by_split=False)
    )
    assert rows["x"]["rfm_hist_shipping_ratio"] == 0.0


def test_default_thresholds_when_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "customer_id string, split string, _spend double, rfm_hist_monthly_orders double")
    assert c.learn_thresholds(empty) == c.DEFAULT_THRESHOLDS


def test_customer_without_anything_gets_zeros(spark):
    data = shop(spark, orders=[order("1", "x", "2018-01-01", status="canceled")])
    row = by_customer(c.churn_dataset(data, thresholds=dict(c.DEFAULT_THRESHOLDS)))["x"]
    numbers = {k: v for k, v in row.items() if k not in ("customer_id", "split")}
    assert numbers.pop("cancellation_ratio") == 1.0 and numbers.pop("has_cancellations") == 1
    assert set(numbers.values()) == {0}


@pytest.mark.parametrize("variant", ["flow", "module"])
def test_dataset_equals_the_blocks(spark, variant):
    data = load_shop(spark, SF_DIR)
    dataset = c.churn_dataset(data, variant=variant)
    blocks = [
        c.delivery_features(data.orders, variant=variant),
        c.review_features(data.reviews, data.orders),
        c.rfm_historical(data.orders, data.items, data.payments, variant=variant),
        c.payment_features(data.payments, data.orders, variant=variant),
        c.cancellation_features(data.orders, variant=variant),
    ]
    joined = dataset.select("customer_id", "split", "is_churned", "days_since_last_order")
    for block in blocks:
        joined = joined.join(block, "customer_id", "left")
    same(dataset, joined.fillna(0))


def test_dataset_invariants(spark):
    dataset = c.churn_dataset(load_shop(spark, SF_DIR)).toPandas()
    assert dataset.customer_id.is_unique and len(dataset) == 150
    for column in dataset.columns:
        if column.endswith("_ratio") and column != "rfm_hist_shipping_ratio":
            assert dataset[column].between(0, 1).all(), column
    speed = [x for x in dataset.columns if x.startswith("delivery_speed_")]
    delivered = dataset[dataset.delivery_actual_days_mean != 0]
    assert (delivered[speed].sum(axis=1) == 1).all()
    assert set(dataset.split) <= set(c.SPLITS)


def test_split_shares(spark):
    """In every class, also a rare one, to within one customer."""
    keys = spark.range(20000).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % 500 == 3).cast("int").alias("is_churned"))
    counts = {(r["is_churned"], r["split"]): r["count"] for r in c.stratified_split(keys).groupBy("is_churned", "split").count().collect()}
    for label, n in ((0, 19960), (1, 40)):
        assert abs(counts[label, "test"] - n / 10) <= 1 and abs(counts[label, "val"] - n / 10) <= 1
        assert sum(counts[label, s] for s in c.SPLITS) == n


def test_sentiment_without_known_words(spark):
    lexicon = spark.createDataFrame([("good", 0.7), ("bad", -0.7)], "word string, polarity double")
    data = shop(
        spark,
        orders=[order("1", "x", "2018-01-01"), order("2", "y", "2018-01-01")],
        reviews=[
            {"review_id": "a", "order_id": "1", "review_score": 1, "review_comment_message": "GOOD, good thing"},
            {"review_id": "b", "order_id": "1", "review_score": 5, "review_comment_message": "???"},
            {"review_id": "a", "order_id": "2", "review_score": 5, "review_comment_message": "bad"},
        ],
    )
    rows = by_customer(c.review_sentiment(data.reviews, data.orders, lexicon))
    assert (rows["x"]["sentiment_mean"], rows["x"]["mismatch_ratio"], rows["x"]["negative_ratio"]) == (0.35, 0.5, 0.0)
    assert (rows["y"]["sentiment_mean"], rows["y"]["mismatch_ratio"], rows["y"]["negative_ratio"]) == (-0.7, 1.0, 1.0)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_salted_lookup_equals_broadcast(spark, how):
    """A third of the facts have one key; keys without a match and null keys included."""
    facts = spark.range(900).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k")
    )
    lookup = spark.range(0, 30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = lookup_join(facts, lookup, "k", how)
    large = lookup_join(facts, lookup, "k", how, salts=4)
    columns = small.columns
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.select(*columns).collect()))


def test_winsorize_keeps_unknown(spark):
    df = spark.createDataFrame([(None,), (50.0,), (-50.0,), (3.0,)], "x double")
    assert [r["x"] for r in c.winsorize(df, ["x"]).collect()] == [None, 30.0, -30.0, 3.0]


def test_monthly_churn_of_a_returning_customer(spark):
    orders = shop(
        spark,
        orders=[
            order("1", "x", "2018-01-10"),
            order("2", "x", "2018-10-05"),
            order("3", "y", "2018-03-01"),
            order("4", "y", "2018-03-20"),
        ],
    ).orders
    rows = {r["month"]: (r["totalCustomers"], r["churnedCustomers"]) for r in c.monthly_churn(orders).collect()}
    assert len(rows) == 10
    assert rows["2018-01"] == (1, 0) and rows["2018-06"] == (2, 0)
    assert rows["2018-07"] == (2, 1)  # x bought last in January
    assert rows["2018-09"] == (2, 2)  # y bought last on 20 March
    assert rows["2018-10"] == (2, 1)  # x is back
