from __future__ import annotations

import oracles.segments  # noqa: F401  (defines the summary block)
from oracles.blocks import cols, quantile, rnd, statement

TYPES = ("boleto", "credit_card", "debit_card", "voucher")


def median(kind: str) -> str:
    return quantile("payment_value", f"(SELECT * FROM c_payments WHERE payment_type = '{kind}')", 0.5)


SQL = {
    "scan_orders": f"SELECT * REPLACE ({cols('o_totalprice')}) FROM orders",
    "csv_roundtrip": "SELECT * FROM c_orders",
    "coerce_timestamps": """
SELECT order_id, CASE WHEN order_id % 13 > 1 THEN order_purchase_timestamp END AS order_purchase_timestamp FROM c_orders""",
    "null_fill": """
SELECT review_id, coalesce(review_score, 0) AS review_score, coalesce(review_comment_message, 'none') AS text
FROM c_reviews""",
    "distinct_customers": "SELECT DISTINCT customer_id FROM c_orders",
    "group_stats": f"""
SELECT payment_type, {rnd('min(payment_value)')} AS min, {rnd('max(payment_value)')} AS max, count(payment_value) AS count,
  {rnd('sum(payment_value)')} AS sum, {rnd('avg(payment_value)')} AS mean, {rnd('stddev_samp(payment_value)')} AS std,
  {rnd("CASE payment_type " + " ".join(f"WHEN '{t}' THEN {median(t)}" for t in TYPES) + " END")} AS median
FROM c_payments GROUP BY payment_type""",
    "half_even_round": f"""
SELECT order_id, payment_sequential, {rnd('payment_value', 1)} AS round_1, {rnd('payment_value', 2)} AS round_2,
  {rnd('payment_value', 3)} AS round_3 FROM c_payments""",
    "segment_summary_json": "SELECT * FROM b_summary",
    "load_tables": " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", count(*) AS "rows" FROM {source}"""
        for name, source in (
            ("orders_raw", "c_orders"), ("order_items_raw", "c_items"), ("order_payments_raw", "c_payments"),
            ("order_reviews_raw", "c_reviews"), ("customers_raw", "c_customers"), ("products_raw", "c_products"),
            ("category_translation_raw", "c_cats"), ("sellers_raw", "supplier"), ("geolocation_raw", "nation"),
        )
    ),
    "orders_by_month": "SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, count(*) AS orders FROM c_orders GROUP BY 1",
}

ORACLES = {key: statement(sql) for key, sql in SQL.items()}
