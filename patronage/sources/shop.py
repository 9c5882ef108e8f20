"""The shop tables every operator takes, and an adapter from the TPC-H-like test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from patronage.session import pin_utc
from patronage.sources.schemas import RAW_TABLES


class Shop:
    """Named input tables, each opened when it is first used.

    The tables are those of `SHOP_TABLES`.
    The key types are whatever the source delivers.
    """

    def __init__(self, **sources: DataFrame | Callable[[], DataFrame]) -> None:
        self._sources = sources

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._sources:
            raise AttributeError(name)
        source = self._sources[name]
        table = source if isinstance(source, DataFrame) else source()
        setattr(self, name, table)
        return table

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self._sources}


SHOP_TABLES = ("orders", "items", "payments", "reviews", "customers", "products", "categories", "sellers", "geolocation")


def read_shop(spark: SparkSession, folder: str) -> Shop:
    """Shop tables stored as one parquet folder per table, read with their fixed schemas."""
    pin_utc(spark)

    def opened(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.schema(RAW_TABLES[name]).parquet(f"{folder}/{name}")

    return Shop(**{name: opened(name) for name in SHOP_TABLES})


# columns of the test tables; naive timestamps are read as UTC
TEST_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp"
    ),
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def read_test_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A fixed schema spares the job that would read the footer."""
    return spark.read.schema(TEST_TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


def adapt_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_test_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        """CASE WHEN o_orderkey % 20 = 0 THEN 'canceled'
                WHEN o_orderstatus = 'P' THEN 'shipped'
                ELSE 'delivered' END AS order_status""",
        "o_orderdate AS order_purchase_timestamp",
        """CASE WHEN o_orderkey % 17 <> 0
                THEN o_orderdate + (o_orderkey % 23) * INTERVAL 1 DAY + (o_orderkey % 24) * INTERVAL 1 HOUR
           END AS order_delivered_customer_date""",
        """o_orderdate + (4 + 3 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) * INTERVAL 1 DAY
           AS order_estimated_delivery_date""",
    )


def adapt_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_test_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "l_extendedprice AS price",
        "l_extendedprice * l_tax AS freight_value",
    )


def adapt_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_test_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS payment_sequential",
        """CASE WHEN l_returnflag = 'A' THEN 'credit_card' WHEN l_returnflag = 'N' THEN 'boleto'
                WHEN l_linestatus = 'F' THEN 'voucher' ELSE 'debit_card' END AS payment_type""",
        "1 + CAST(l_quantity AS INTEGER) % 12 AS payment_installments",
        "l_extendedprice * (1 - l_discount) AS payment_value",
    )


def adapt_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_test_table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    texts = read_test_table(spark, sf_dir, "documents").select("doc_id", "text")
    return events.join(texts, events.event_id == texts.doc_id, "left").selectExpr(
        "event_id AS review_id",
        "CASE WHEN event_id % 7 = 1 THEN event_id - 1 ELSE event_id END AS order_id",
        """CASE WHEN event_type = 'error' THEN NULL
                ELSE 1 + least(4, CAST(floor(value / 20) AS INTEGER)) END AS review_score""",
        "text AS review_comment_message",
        "ts AS review_creation_date",
    )


def adapt_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_test_table(spark, sf_dir, "customer")
    nation = read_test_table(spark, sf_dir, "nation")
    region = read_test_table(spark, sf_dir, "region")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
        .selectExpr(
            "c_custkey AS customer_id",
            "c_name AS customer_unique_id",
            "c_nationkey AS customer_zip_code_prefix",
            "n_name AS customer_city",
            "r_name AS customer_state",
        )
    )


def adapt_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_test_table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_brand END AS product_category_name",
    )


def adapt_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read_test_table(spark, sf_dir, "part")
        .where("p_brand <> 'Brand#13'")
        .selectExpr(
            "p_brand AS product_category_name",
            "'category_' || substr(p_brand, 7) AS product_category_name_english",
        )
        .distinct()
    )


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_test_table(spark, sf_dir, "nation")
    region = read_test_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left")


def adapt_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_test_table(spark, sf_dir, "supplier")
    places = _places(spark, sf_dir)
    return supplier.join(places, supplier.s_nationkey == places.n_nationkey, "left").selectExpr(
        "s_suppkey AS seller_id",
        "s_nationkey AS seller_zip_code_prefix",
        "n_name AS seller_city",
        "r_name AS seller_state",
    )


def adapt_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir).selectExpr(
        "n_nationkey AS geolocation_zip_code_prefix",
        "CAST(n_nationkey * 5 - 60 AS DOUBLE) AS geolocation_lat",
        "CAST(n_nationkey * 10 - 120 AS DOUBLE) AS geolocation_lng",
        "n_name AS geolocation_city",
        "r_name AS geolocation_state",
    )


def load_shop(spark: SparkSession, sf_dir: str) -> Shop:
    """Shop tables derived from the driver's parquet files."""
    pin_utc(spark)
    adapters = {
        "orders": adapt_orders,
        "items": adapt_items,
        "payments": adapt_payments,
        "reviews": adapt_reviews,
        "customers": adapt_customers,
        "products": adapt_products,
        "categories": adapt_categories,
        "sellers": adapt_sellers,
        "geolocation": adapt_geolocation,
    }
    return Shop(**{name: partial(adapt, spark, sf_dir) for name, adapt in adapters.items()})


def load_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic scored table (id, y, p, split) with many tied scores."""
    pin_utc(spark)
    return adapt_orders(spark, sf_dir).selectExpr(
        "order_id AS id",
        "CASE WHEN order_status = 'delivered' AND order_id % 3 > 0 THEN 1 ELSE 0 END AS y",
        """CAST(((order_id * 7919) % 1000) * 8 + CASE WHEN order_status = 'delivered' THEN 2000 ELSE 0 END
           AS DOUBLE) / 10000 AS p""",
        "CASE WHEN order_id % 10 = 0 THEN 'test' WHEN order_id % 10 = 1 THEN 'val' ELSE 'train' END AS split",
    )
