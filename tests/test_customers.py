from pyspark.sql import functions as F

from patronage.operators import customers as c, segments
from patronage.sources.shop import Shop
from shop_data import order, same, shop


def by_customer(df):
    return {r["customer_id"]: r for r in df.collect()}


def test_preferred_payment_is_the_smallest_of_the_most_frequent(spark):
    data = shop(
        spark,
        orders=[order("1", "x", "2018-01-01"), order("2", "y", "2018-01-01")],
        payments=[{"order_id": "1", "payment_type": t} for t in ("b", "a", None, None, None)]
        + [{"order_id": "2", "payment_type": None, "payment_value": 3.0}],
    )
    rows = by_customer(c.payment_behavior(data.payments, data.orders))
    assert (rows["x"]["preferred_payment_type"], rows["x"]["payment_diversity"]) == ("a", 2)
    assert (rows["y"]["preferred_payment_type"], rows["y"]["payment_diversity"]) == ("unknown", 0)
    assert rows["y"]["total_payment_value"] == 3.0 and rows["y"]["avg_installments"] is None


def test_review_without_score_counts_as_text(spark):
    data = shop(
        spark,
        orders=[order("1", "x", "2018-01-01")],
        reviews=[
            {"review_id": "r", "order_id": "1", "review_comment_message": "good"},
            {"review_id": "s", "order_id": "1", "review_score": 4},
            {"review_id": "t", "order_id": "1", "review_score": 5},
        ],
    )
    row = by_customer(c.review_behavior(data.reviews, data.orders))["x"]
    assert (row["avg_review_score"], row["review_count"], row["reviews_with_text"], row["review_rate"]) == (4.5, 2, 1, 2.0)


def test_features_without_items_payments_reviews(spark):
    data = shop(
        spark,
        orders=[order("1", "x", "2018-01-01 10:00:00"), order("2", "x", "2018-01-03 09:00:00"), order("3", None, "2018-01-05")],
        customers=[{"customer_id": "x"}],
    )
    row = by_customer(c.customer_features(data))["x"]
    assert (row["frequency"], row["recency_days"], row["tenure_days"]) == (2, 2, 1)
    assert row["total_spent"] == 0 and row["avg_review_score"] == 0 and row["review_rate"] == 0
    assert row["preferred_payment_type"] == "0" and row["customer_city"] == "0"


def test_single_pass_equals_the_blocks(spark):
    from patronage.sources.shop import load_shop

    data: Shop = load_shop(spark, "/root/testdata/sf0.001")
    together = c.customer_features(data)
    apart = (
        c.rfm_base(data.orders)
        .join(c.monetary(data.orders, data.items), "customer_id", "left")
        .join(c.review_behavior(data.reviews, data.orders), "customer_id", "left")
        .fillna(0)
    )
    columns = [name for name in apart.columns if name in together.columns]
    same(together.select(*columns), apart.select(*columns))


def test_category_of_unknown_product(spark):
    data = shop(
        spark,
        orders=[order("1", "x", "2018-01-01"), order("2", "y", "2018-01-01")],
        items=[{"order_id": "1", "product_id": p} for p in ("p", "q", "q", "z")] + [{"order_id": "2", "product_id": "z"}],
        products=[{"product_id": "p", "product_category_name": "um"}, {"product_id": "q", "product_category_name": "dois"}],
        categories=[
            {"product_category_name": "um", "product_category_name_english": "one"},
            {"product_category_name": "dois", "product_category_name_english": "two"},
        ],
    )
    rows = by_customer(c.category_behavior(data.items, data.products, data.categories, data.orders))
    assert (rows["x"]["category_diversity"], rows["x"]["preferred_category"]) == (2, "two")
    assert (rows["y"]["category_diversity"], rows["y"]["preferred_category"]) == (0, "other")


def test_scores_with_text_keys_and_equal_recency(spark):
    features = spark.createDataFrame(
        [(f"c{i}", 10 if i < 5 else i, 1 + i % 2, float(i)) for i in range(10)],
        "customer_id string, recency_days long, frequency long, total_spent double",
    )
    rows = c.add_rfm_scores(features, tiers=True).collect()
    assert all(1 <= r[s] <= 5 for r in rows for s in ("R_score", "F_score", "M_score"))
    assert {r["customer_id"]: r["M_score"] for r in rows}["c9"] == 5
    assert {r["customer_id"]: r["value_segment"] for r in rows}["c9"] == "VIP"
    assert all(r["RFM_score"] == f"{r['R_score']}{r['F_score']}{r['M_score']}" for r in rows)


def test_overlapping_segment_codes(spark):
    codes = spark.createDataFrame([("155",), ("113",), ("111",), ("555",)], "RFM_score string")
    found = [r["RFM_segment"] for r in segments.rfm_segments(codes).collect()]
    assert found == ["Promising", "At Risk", "Lost", "Champions"]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 9)], "k int, v int")
    rows = {r["check"]: r["violations"] for r in c.quality_checks(df, "k", ["v"], {"v": (1, 5)}).collect()}
    assert rows == {"null_v": 1, "range_v": 1, "duplicate_key": 1}


def test_table_without_columns_of_other_key_name(spark):
    data = shop(spark, orders=[order("1", "x", "2018-01-01")])
    renamed = data.orders.withColumnRenamed("customer_id", "buyer")
    assert c.rfm_base(renamed, "buyer").select(F.col("buyer")).first()[0] == "x"
