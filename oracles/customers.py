from __future__ import annotations

from oracles.blocks import cols, quantile, rnd, statement

MASTER_NUMBERS = "total_spent avg_order_value total_freight avg_freight avg_installments total_payment_value avg_review_score review_rate"

SQL = {
    "rfm_base": "SELECT * FROM b_rfm",
    "order_value_join": f"SELECT order_id, customer_id, {cols('total_price total_freight total_value')} FROM c_orders JOIN b_order_values USING (order_id)",
    "monetary": f"SELECT customer_id, {cols('total_spent avg_order_value total_freight avg_freight')} FROM b_monetary",
    "monetary_price_only": f"""
SELECT o.customer_id, {rnd('sum(v.total_price)', 2)} AS total_price, {rnd('avg(v.total_price)', 2)} AS avg_order_value,
  {rnd('sum(v.total_freight)', 2)} AS total_freight, {rnd('avg(v.total_freight)', 2)} AS avg_freight,
  {rnd('sum(v.total_value)', 2)} AS total_spent, {rnd('avg(v.total_value)', 2)} AS avg_total_value
FROM c_orders o JOIN b_order_values v USING (order_id) GROUP BY o.customer_id""",
    "payment_behavior": "SELECT * FROM b_payment",
    "preferred_payment_type": "SELECT customer_id, preferred_payment_type FROM b_preferred_payment",
    "payment_diversity": "SELECT customer_id, payment_diversity FROM b_payment",
    "review_behavior": f"SELECT customer_id, {cols('avg_review_score review_rate')}, review_count, reviews_with_text FROM b_review",
    "items_with_category": f"""
SELECT order_id, order_item_id, product_id, {cols('price')}, product_category_name, product_category_name_english FROM b_items_cat""",
    "category_behavior": "SELECT * FROM b_category",
    "preferred_category": "SELECT customer_id, preferred_category FROM b_category",
    "geo_info": "SELECT customer_id, customer_city, customer_state FROM c_customers",
    "customer_master": f"""
SELECT f.* REPLACE ({cols(MASTER_NUMBERS)}), s.R_score, s.F_score, s.M_score, s.RFM_score, s.value_segment
FROM b_features f JOIN b_scores s USING (customer_id)""",
    "bucketed_features": f"SELECT * REPLACE ({cols(MASTER_NUMBERS)}) FROM b_features",
    "rfm_scores": "SELECT customer_id, R_score, F_score, M_score, RFM_score FROM b_scores",
    "rfm_code": "SELECT customer_id, RFM_score FROM b_scores",
    "value_segment": f"SELECT customer_id, {cols('total_spent')}, value_segment FROM b_spend JOIN b_scores USING (customer_id)",
    "global_rank": f"SELECT customer_id, {cols('total_spent')}, m_rank AS spend_rank FROM b_spend JOIN b_rank USING (customer_id)",
    "spend_quantiles": f"""
SELECT {rnd(quantile('total_spent', 'b_spend', 0.25))} AS q25, {rnd(quantile('total_spent', 'b_spend', 0.5))} AS q50,
  {rnd(quantile('total_spent', 'b_spend', 0.75))} AS q75, {rnd(quantile('total_spent', 'b_spend', 0.9))} AS q90""",
    "cltv_summary": f"""
SELECT customer_id, frequency - 1 AS frequency, tenure_days AS recency,
  CAST(floor((epoch_us((SELECT max(order_purchase_timestamp) FROM c_orders)) - epoch_us(first_order)) / 86400000000.0) AS BIGINT) AS age,
  {rnd('coalesce(avg_order_value, 0)')} AS mean_value
FROM b_rfm LEFT JOIN b_monetary USING (customer_id)""",
    "quality_checks": """
SELECT "check", violations::BIGINT AS violations, CASE WHEN violations = 0 THEN 1 ELSE 0 END AS passed FROM (
  SELECT 'null_order_id' AS "check", count(*) FILTER (order_id IS NULL) AS violations FROM c_reviews
  UNION ALL SELECT 'null_review_score', count(*) FILTER (review_score IS NULL) FROM c_reviews
  UNION ALL SELECT 'null_review_comment_message', count(*) FILTER (review_comment_message IS NULL) FROM c_reviews
  UNION ALL SELECT 'range_review_score', count(*) FILTER (review_score NOT BETWEEN 1 AND 4) FROM c_reviews
  UNION ALL SELECT 'duplicate_key', count(*) - count(DISTINCT order_id) FROM c_reviews)""",
}

ORACLES = {key: statement(sql) for key, sql in SQL.items()}
