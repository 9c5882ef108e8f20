"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry
from patronage.operators import churn, customers
from patronage.sources.shop import load_shop

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def one_task_windows(text: str) -> list[str]:
    """Windows that get all rows in one task; an ordered window has a sort before its exchange."""
    return re.findall(r"Window .*\n(?:.*\bSort .*\n)?.*Exchange SinglePartition", text)


def test_ordered_one_task_windows_are_seen(spark):
    from pyspark.sql import Window, functions as F

    df = spark.range(10)
    assert one_task_windows(plan(df.withColumn("n", F.row_number().over(Window.orderBy("id")))))
    assert not one_task_windows(plan(df.withColumn("n", F.row_number().over(Window.partitionBy(F.col("id") % 3).orderBy("id")))))


HEAVY = [
    "payment_behavior",
    "review_behavior",
    "category_behavior",
    "delivery_features",
    "payment_features",
    "payment_complexity",
    "order_value_join",
    "threshold_sweep",
    "risk_segmentation",
    "group_stats",
    "spend_quantiles",
    "value_segment",
    "customer_master",
    "churn_dataset",
    "review_sentiment",
    "semi_join_items",
]


@pytest.mark.parametrize("name", HEAVY)
def test_no_python_no_product_no_one_task_window(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text
    assert not one_task_windows(text)


@pytest.mark.parametrize("build", [customers.customer_features, lambda s: churn.churn_dataset(s, thresholds=dict(churn.DEFAULT_THRESHOLDS))])
def test_feature_jobs(spark, build):
    text = plan(build(load_shop(spark, SF_DIR)))
    assert "CartesianProduct" not in text and "Python" not in text and "NestedLoop" not in text
    # every grouping of lines is combined before its shuffle
    assert text.count("partial_sum") >= 2


def test_columns_are_pruned_and_filters_pushed(spark):
    data = load_shop(spark, SF_DIR)
    text = plan(customers.order_values(data.items))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_tax:double>" in text
    window = plan(data.orders.where("order_purchase_timestamp >= timestamp'2000-01-01'").select("order_id"))
    assert "GreaterThanOrEqual(o_orderdate" in window


def test_ranking_reads_balanced_partitions(spark):
    """A value that a third of the rows share does not end up in one partition."""
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.rand(1)).alias("v"))
        spread = df.repartitionByRange("v", "id").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in spread) < 9000 / 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_bucketed_tables_meet_without_a_shuffle_by_order(spark):
    import uuid

    from patronage.session import scratch_path
    from patronage.sources import files

    tables = load_shop(spark, SF_DIR).tables()
    shop = files.load_bucketed(tables, f"buckets_{uuid.uuid4().hex}", scratch_path(spark, "buckets"), buckets=4)
    bucketed, plain = plan(customers.customer_features(shop)), plan(customers.customer_features(load_shop(spark, SF_DIR)))
    by_order = r"hashpartitioning\((?:order_id|l_orderkey|o_orderkey)#\d+L?(?: AS order_id)?,"
    assert re.search(by_order, plain) and not re.search(by_order, bucketed)
    assert "Bucketed: true" in bucketed


@pytest.mark.parametrize("name", ["roc_curve", "pr_curve"])
def test_running_totals_stay_in_their_partitions(spark, name):
    """The ordered rows are read in the buckets of their partitions: no window of a curve has an exchange by partition."""
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "Bucketed: true" in text
    assert not re.search(r"hashpartitioning\(_part#", text)


def test_buckets_grow_with_the_tables(spark):
    """A bucket, which one task reads, holds a bounded number of rows."""
    import uuid

    from patronage.session import scratch_path
    from patronage.sources import files

    orders = spark.range(1000).selectExpr("id AS order_id", "id % 50 AS customer_id")
    items = spark.range(4000).selectExpr("id % 1000 AS order_id", "CAST(id AS DOUBLE) AS price")

    def tasks(buckets, **most):
        shop = files.load_bucketed({"orders": orders, "items": items}, f"buckets_{uuid.uuid4().hex}", scratch_path(spark, "buckets"), buckets, **most)
        assert shop.orders.count() == 1000 and shop.items.count() == 4000
        text = shop.items.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
        return int(re.search(r"SelectedBucketsCount: \d+ out of (\d+)", text).group(1))

    assert tasks(4, most=500) == 8
    assert tasks(4) == 4
