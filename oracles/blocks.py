"""Named SQL blocks and a helper that strings the needed ones into one statement."""

from __future__ import annotations

import re

BLOCKS: dict[str, str] = {}


def block(name: str, sql: str) -> None:
    BLOCKS[name] = sql.strip()


def needed(sql: str, seen: list[str]) -> None:
    for name in BLOCKS:
        if name not in seen and re.search(rf"\b{name}\b", sql):
            needed(BLOCKS[name], seen)
            if name not in seen:
                seen.append(name)


def statement(sql: str) -> str:
    """`sql` preceded by the blocks it mentions, in order of use."""
    names: list[str] = []
    needed(sql, names)
    if not names:
        return sql.strip()
    return "WITH " + ",\n".join(f"{n} AS (\n{BLOCKS[n]}\n)" for n in names) + "\n" + sql.strip()


def rnd(expr: str, digits: int = 4) -> str:
    """Half-even rounding after noise removal, as in the operators."""
    scale = f"1{'0' * digits}.0::DOUBLE"
    return f"(round_even(round(({expr})::DOUBLE, 8) * {scale}, 0) / {scale})"


def cols(names: str, digits: int = 4) -> str:
    """Rounded columns under their own names."""
    return ", ".join(f"{rnd(n, digits)} AS {n}" for n in names.split())


def days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"


def quantile(column: str, table: str, p: float) -> str:
    """Linear interpolation between the two neighbours in sorted order, as a scalar subquery."""
    return f"""(SELECT CASE WHEN t < 0.5 THEN a + (b - a) * t ELSE b - (b - a) * (1 - t) END FROM (
      SELECT max(v) FILTER (rn - 1 = floor(h)) AS a,
             coalesce(max(v) FILTER (rn - 1 = floor(h) + 1), max(v) FILTER (rn - 1 = floor(h))) AS b,
             max(h - floor(h)) AS t
      FROM (SELECT v, rn, (n - 1) * {p}::DOUBLE AS h FROM (
        SELECT {column}::DOUBLE AS v, row_number() OVER (ORDER BY {column}) AS rn, count(*) OVER () AS n
        FROM {table} WHERE {column} IS NOT NULL))))"""


# ---- shop tables derived from the driver's tables --------------------------------------------
block("c_orders", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN o_orderkey % 20 = 0 THEN 'canceled' WHEN o_orderstatus = 'P' THEN 'shipped' ELSE 'delivered' END AS order_status,
  o_orderdate AS order_purchase_timestamp,
  CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate + (o_orderkey % 23) * INTERVAL 1 DAY + (o_orderkey % 24) * INTERVAL 1 HOUR END AS order_delivered_customer_date,
  o_orderdate + (4 + 3 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) * INTERVAL 1 DAY AS order_estimated_delivery_date
FROM orders""")
block("c_items", """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
  l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_extendedprice * l_tax AS freight_value
FROM lineitem""")
block("c_payments", """
SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
  CASE WHEN l_returnflag = 'A' THEN 'credit_card' WHEN l_returnflag = 'N' THEN 'boleto'
       WHEN l_linestatus = 'F' THEN 'voucher' ELSE 'debit_card' END AS payment_type,
  1 + CAST(l_quantity AS INTEGER) % 12 AS payment_installments,
  l_extendedprice * (1 - l_discount) AS payment_value
FROM lineitem""")
block("c_reviews", """
SELECT e.event_id AS review_id, CASE WHEN e.event_id % 7 = 1 THEN e.event_id - 1 ELSE e.event_id END AS order_id,
  CASE WHEN e.event_type = 'error' THEN NULL ELSE 1 + least(4, CAST(floor(e.value / 20) AS INTEGER)) END AS review_score,
  d.text AS review_comment_message, e.ts AS review_creation_date
FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id""")
block("c_customers", """
SELECT c_custkey AS customer_id, c_name AS customer_unique_id, c_nationkey AS customer_zip_code_prefix,
  n_name AS customer_city, r_name AS customer_state
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
block("c_products", """
SELECT p_partkey AS product_id, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_brand END AS product_category_name FROM part""")
block("c_cats", """
SELECT DISTINCT p_brand AS product_category_name, 'category_' || substr(p_brand, 7) AS product_category_name_english
FROM part WHERE p_brand <> 'Brand#13'""")
block("c_scored", """
SELECT order_id AS id, CASE WHEN order_status = 'delivered' AND order_id % 3 > 0 THEN 1 ELSE 0 END AS y,
  CAST(((order_id * 7919) % 1000) * 8 + CASE WHEN order_status = 'delivered' THEN 2000 ELSE 0 END AS DOUBLE) / 10000 AS p,
  CASE WHEN order_id % 10 = 0 THEN 'test' WHEN order_id % 10 = 1 THEN 'val' ELSE 'train' END AS split
FROM c_orders""")

# ---- customer features -----------------------------------------------------------------------
block("b_rfm", f"""
SELECT customer_id, min(order_purchase_timestamp) AS first_order, max(order_purchase_timestamp) AS last_order,
  count(order_purchase_timestamp) AS frequency,
  {days("(SELECT max(order_purchase_timestamp) FROM c_orders) + INTERVAL 1 DAY", "max(order_purchase_timestamp)")} AS recency_days,
  {days("max(order_purchase_timestamp)", "min(order_purchase_timestamp)")} AS tenure_days
FROM c_orders GROUP BY customer_id""")
block("b_order_values", """
SELECT order_id, sum(price) AS total_price, sum(freight_value) AS total_freight, sum(price) + sum(freight_value) AS total_value
FROM c_items GROUP BY order_id""")
block("b_monetary", """
SELECT o.customer_id, sum(v.total_value) AS total_spent, avg(v.total_value) AS avg_order_value,
  sum(v.total_freight) AS total_freight, avg(v.total_freight) AS avg_freight
FROM c_orders o JOIN b_order_values v USING (order_id) GROUP BY o.customer_id""")
block("b_preferred_payment", """
SELECT customer_id, payment_type AS preferred_payment_type FROM (
  SELECT o.customer_id, p.payment_type,
    row_number() OVER (PARTITION BY o.customer_id ORDER BY count(*) DESC, p.payment_type) AS place
  FROM c_payments p JOIN c_orders o USING (order_id) GROUP BY o.customer_id, p.payment_type)
WHERE place = 1""")
block("b_payment", f"""
SELECT o.customer_id, any_value(f.preferred_payment_type) AS preferred_payment_type,
  {rnd("avg(p.payment_installments)", 2)} AS avg_installments, {rnd("sum(p.payment_value)", 2)} AS total_payment_value,
  count(DISTINCT p.payment_type) AS payment_diversity
FROM c_payments p JOIN c_orders o USING (order_id) JOIN b_preferred_payment f USING (customer_id)
GROUP BY o.customer_id""")
block("b_review", f"""
SELECT o.customer_id, avg(r.review_score) AS avg_review_score, count(r.review_score) AS review_count,
  count(r.review_comment_message) AS reviews_with_text,
  {rnd("count(r.review_score) / any_value(b.frequency)", 2)} AS review_rate
FROM c_orders o LEFT JOIN c_reviews r USING (order_id) JOIN b_rfm b USING (customer_id)
GROUP BY o.customer_id""")
block("b_items_cat", """
SELECT i.*, p.product_category_name, c.product_category_name_english
FROM c_items i LEFT JOIN c_products p USING (product_id) LEFT JOIN c_cats c USING (product_category_name)""")
block("b_category", """
SELECT d.customer_id, d.category_diversity, coalesce(f.category, 'other') AS preferred_category
FROM (SELECT o.customer_id, count(DISTINCT i.product_category_name_english) AS category_diversity
      FROM b_items_cat i JOIN c_orders o USING (order_id) GROUP BY o.customer_id) d
LEFT JOIN (SELECT o.customer_id, i.product_category_name_english AS category,
             row_number() OVER (PARTITION BY o.customer_id ORDER BY count(*) DESC, i.product_category_name_english) AS place
           FROM b_items_cat i JOIN c_orders o USING (order_id)
           WHERE i.product_category_name_english IS NOT NULL
           GROUP BY o.customer_id, i.product_category_name_english) f
  ON f.customer_id = d.customer_id AND f.place = 1""")
block("b_features", """
SELECT r.customer_id, r.first_order, r.last_order, r.frequency, r.recency_days, r.tenure_days,
  coalesce(m.total_spent, 0) AS total_spent, coalesce(m.avg_order_value, 0) AS avg_order_value,
  coalesce(m.total_freight, 0) AS total_freight, coalesce(m.avg_freight, 0) AS avg_freight,
  coalesce(p.preferred_payment_type, '0') AS preferred_payment_type, coalesce(p.avg_installments, 0) AS avg_installments,
  coalesce(p.total_payment_value, 0) AS total_payment_value, coalesce(p.payment_diversity, 0) AS payment_diversity,
  coalesce(v.avg_review_score, 0) AS avg_review_score, coalesce(v.review_count, 0) AS review_count,
  coalesce(v.reviews_with_text, 0) AS reviews_with_text, coalesce(v.review_rate, 0) AS review_rate,
  coalesce(c.category_diversity, 0) AS category_diversity, coalesce(c.preferred_category, '0') AS preferred_category,
  coalesce(g.customer_city, '0') AS customer_city, coalesce(g.customer_state, '0') AS customer_state
FROM b_rfm r LEFT JOIN b_monetary m USING (customer_id) LEFT JOIN b_payment p USING (customer_id)
LEFT JOIN b_review v USING (customer_id) LEFT JOIN b_category c USING (customer_id)
LEFT JOIN c_customers g USING (customer_id)""")
block("b_spend", """
SELECT r.customer_id, r.recency_days, r.frequency, r.tenure_days, r.last_order,
  coalesce(m.total_spent, 0) AS total_spent, coalesce(m.avg_order_value, 0) AS avg_order_value
FROM b_rfm r LEFT JOIN b_monetary m USING (customer_id)""")
block("b_rank", """
SELECT customer_id, row_number() OVER (ORDER BY frequency, customer_id) AS f_rank,
  row_number() OVER (ORDER BY total_spent, customer_id) AS m_rank, count(*) OVER () AS n
FROM b_spend""")
block("b_edges", f"""
SELECT {quantile("recency_days", "b_spend", 0.2)} AS e1, {quantile("recency_days", "b_spend", 0.4)} AS e2,
  {quantile("recency_days", "b_spend", 0.6)} AS e3, {quantile("recency_days", "b_spend", 0.8)} AS e4,
  {quantile("total_spent", "b_spend", 0.25)} AS q25, {quantile("total_spent", "b_spend", 0.5)} AS q50,
  {quantile("total_spent", "b_spend", 0.75)} AS q75, {quantile("total_spent", "b_spend", 0.9)} AS q90""")
block("b_scores", """
SELECT customer_id, R_score, F_score, M_score, concat(R_score, F_score, M_score) AS RFM_score, value_segment FROM (
  SELECT s.customer_id,
    5 - ((s.recency_days > e1)::INT + (s.recency_days > e2)::INT + (s.recency_days > e3)::INT + (s.recency_days > e4)::INT) AS R_score,
    CAST(greatest(1, ceil((f_rank - 1) * 5 / (n - 1))) AS INT) AS F_score,
    CAST(greatest(1, ceil((m_rank - 1) * 5 / (n - 1))) AS INT) AS M_score,
    CASE WHEN total_spent >= q90 THEN 'VIP' WHEN total_spent >= q75 THEN 'High Value'
         WHEN total_spent >= q50 THEN 'Medium Value' WHEN total_spent >= q25 THEN 'Low Value' ELSE 'Entry Level' END AS value_segment
  FROM b_spend s JOIN b_rank k USING (customer_id) CROSS JOIN b_edges)""")
