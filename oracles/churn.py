from __future__ import annotations

from oracles.blocks import block, cols, days, quantile, rnd, statement

LATEST = "(SELECT max(order_purchase_timestamp) FROM c_orders)"


def share(name: str, total: str = "count(*)") -> str:
    return f"count(*) FILTER ({name}) / {total}"


block("b_labels", f"""
SELECT customer_id, max(order_purchase_timestamp) AS last_purchase,
  CASE WHEN max(order_purchase_timestamp) < {LATEST} - INTERVAL 6 MONTH THEN 1 ELSE 0 END AS is_churned,
  {days(LATEST, "max(order_purchase_timestamp)")} AS days_since_last_order
FROM c_orders GROUP BY customer_id""")
block("b_split", """
SELECT customer_id, CASE WHEN nth <= floor((n - 1) * 0.1::DOUBLE) + 1 THEN 'test'
  WHEN nth <= floor((n - 1) * (0.1::DOUBLE + 0.1::DOUBLE)) + 1 THEN 'val' ELSE 'train' END AS split
FROM (SELECT customer_id, count(*) OVER (PARTITION BY is_churned) AS n,
  row_number() OVER (PARTITION BY is_churned ORDER BY substr(md5('42-' || customer_id::VARCHAR), 1, 13)) AS nth FROM b_labels)""")
block("b_delivered", f"""
SELECT *, {days("order_delivered_customer_date", "order_estimated_delivery_date")} AS days_diff,
  {days("order_delivered_customer_date", "order_purchase_timestamp")} AS actual_days,
  {days("order_estimated_delivery_date", "order_purchase_timestamp")} AS promised_days
FROM c_orders
WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL""")
block("b_delivery_base", f"""
SELECT customer_id, {rnd("avg(days_diff)", 2)} AS diff_mean, {rnd("avg(actual_days)", 2)} AS actual_mean,
  {rnd("stddev_samp(actual_days)", 2)} AS actual_std,
  {share("days_diff > 0")} AS late, {share("actual_days > 7")} AS slow, {share("actual_days > 14")} AS very_slow
FROM b_delivered GROUP BY customer_id""")
block("b_delivery_score", """
SELECT *, late * 0.3::DOUBLE + slow * 0.4::DOUBLE + very_slow * 0.3::DOUBLE AS score FROM b_delivery_base""")
block("b_delivery", """
SELECT customer_id, diff_mean AS delivery_days_diff_mean, actual_mean AS delivery_actual_days_mean,
  coalesce(actual_std, 0) AS delivery_actual_days_std, late AS delivery_late_ratio, slow AS delivery_slow_ratio,
  very_slow AS delivery_very_slow_ratio,
  (late > 0.5)::INT AS delivery_consistently_late, (slow > 0.3::DOUBLE)::INT AS delivery_frequently_slow,
  (very_slow > 0)::INT AS delivery_has_very_slow, (coalesce(actual_std, 0) > 5)::INT AS delivery_inconsistent,
  score AS delivery_dissatisfaction_score, (score > 0.3::DOUBLE)::INT AS delivery_likely_dissatisfied,
  (actual_mean <= 3)::INT AS delivery_speed_fast, (actual_mean > 3 AND actual_mean <= 7)::INT AS delivery_speed_normal,
  (actual_mean > 7 AND actual_mean <= 14)::INT AS delivery_speed_slow, (actual_mean > 14)::INT AS delivery_speed_very_slow
FROM b_delivery_score""")
block("b_promise", f"""
SELECT customer_id, {rnd("avg(days_diff)", 2)} AS delivery_days_diff_mean, max(days_diff) AS delivery_days_diff_max,
  {rnd("avg(actual_days)", 2)} AS delivery_delivery_actual_days_mean,
  {rnd("avg(promised_days)", 2)} AS delivery_delivery_promised_days_mean, count(order_id) AS delivery_order_id_count,
  {share("days_diff > 0")} AS delivery_late_ratio, {share("days_diff > 5")} AS delivery_very_late_ratio,
  {share("promised_days > 20")} AS delivery_long_promise_ratio
FROM b_delivered GROUP BY customer_id""")

PROMISE_SCALED = {
    "delivery_days_diff_mean": "greatest(least(coalesce(p.delivery_days_diff_mean, 0), 30.0::DOUBLE), -30.0::DOUBLE)",
    "delivery_days_diff_max": "greatest(least(coalesce(p.delivery_days_diff_max, 0), 30), -30)::DOUBLE",
    "delivery_delivery_actual_days_mean": "coalesce(p.delivery_delivery_actual_days_mean, 0)",
    "delivery_delivery_promised_days_mean": "coalesce(p.delivery_delivery_promised_days_mean, 0)",
    "delivery_late_ratio": "coalesce(p.delivery_late_ratio, 0)",
    "delivery_very_late_ratio": "coalesce(p.delivery_very_late_ratio, 0)",
    "delivery_long_promise_ratio": "coalesce(p.delivery_long_promise_ratio, 0)",
    "delivery_late_ratio_log": "coalesce(ln(p.delivery_late_ratio + 0.001::DOUBLE), 0)",
    "delivery_very_late_ratio_log": "coalesce(ln(p.delivery_very_late_ratio + 0.001::DOUBLE), 0)",
    "delivery_long_promise_ratio_log": "coalesce(ln(p.delivery_long_promise_ratio + 0.001::DOUBLE), 0)",
}
block("b_promise_clean", "SELECT c.customer_id, " + ", ".join(f"{e} AS {n}" for n, e in PROMISE_SCALED.items())
      + " FROM c_customers c LEFT JOIN b_promise p USING (customer_id)")


def scaled(column: str, table: str) -> str:
    q = [quantile(column, table, p) for p in (0.25, 0.5, 0.75)]
    return f"({column} - {q[1]}) / coalesce(nullif({q[2]} - {q[0]}, 0), 1)"


block("b_reviews_scored", f"""
SELECT o.customer_id, {rnd("avg(r.review_score)", 2)} AS review_review_score_mean,
  min(r.review_score) AS review_review_score_min, {share("r.review_score <= 2")} AS review_bad_ratio
FROM c_reviews r JOIN c_orders o USING (order_id) WHERE r.review_score IS NOT NULL GROUP BY o.customer_id""")
def lexicon(reviews: str) -> str:
    """Log odds of the words of high against low scores with a Dirichlet prior of 500 words."""
    return f"""
SELECT word, high, low, round(2 / (1 + exp(-difference)) - 1, 6) AS polarity FROM (
  SELECT word, high, low, sqrt(1 / (high + share) + 1 / (low + share)) AS deviation,
    ln((high + share) / nullif(all_high + 500 - (high + share), 0)) - ln((low + share) / nullif(all_low + 500 - (low + share), 0)) AS difference
  FROM (SELECT *, 500.0::DOUBLE * (high + low) / (all_high + all_low) AS share FROM (
    SELECT word, high, low, sum(high) OVER ()::DOUBLE AS all_high, sum(low) OVER ()::DOUBLE AS all_low FROM (
      SELECT word, count(*) FILTER (review_score >= 4) AS high, count(*) FILTER (review_score <= 2) AS low FROM (
        SELECT review_score, unnest(regexp_split_to_array(lower(review_comment_message), '[^\\p{{L}}]+')) AS word
        FROM {reviews} WHERE review_comment_message IS NOT NULL AND (review_score >= 4 OR review_score <= 2))
      WHERE word <> '' GROUP BY word))))
WHERE abs(difference) >= 1.96::DOUBLE * deviation"""


HELD_OUT = "('0x' || substr(md5(review_id::VARCHAR), 1, 8))::BIGINT % 5 = 0"
block("b_lexicon", lexicon("c_reviews"))
block("b_learning_reviews", f"SELECT * FROM c_reviews WHERE NOT ({HELD_OUT})")
block("b_learned_lexicon", lexicon("b_learning_reviews"))
block("b_words", """
SELECT review_id, unnest(regexp_split_to_array(lower(review_comment_message), '[^\\p{L}]+')) AS word
FROM c_reviews WHERE review_comment_message IS NOT NULL""")
block("b_polarity", """
SELECT r.review_id, r.order_id, r.review_score, coalesce(p.polarity, 0) AS polarity,
  CASE WHEN coalesce(p.polarity, 0) <= -0.1::DOUBLE THEN 'negative' WHEN coalesce(p.polarity, 0) <= 0.1::DOUBLE THEN 'neutral'
       ELSE 'positive' END AS tone
FROM c_reviews r
LEFT JOIN (SELECT review_id, round(avg(polarity), 10) AS polarity FROM b_words JOIN b_lexicon USING (word) GROUP BY review_id) p USING (review_id)
WHERE r.review_comment_message IS NOT NULL""")
block("b_sentiment", f"""
SELECT o.customer_id, {rnd("avg(r.review_score)", 3)} AS review_score_mean, min(r.review_score) AS review_score_min,
  {rnd("avg(polarity)", 3)} AS sentiment_mean, {rnd("stddev_samp(polarity)", 3)} AS sentiment_std,
  {share("(r.review_score >= 4 AND tone = 'negative') OR (r.review_score <= 2 AND tone = 'positive')")} AS mismatch_ratio,
  {share("tone = 'negative'")} AS negative_ratio
FROM b_polarity r JOIN c_orders o USING (order_id) GROUP BY o.customer_id""")
SENTIMENT = ["review_score_mean", "review_score_min", "sentiment_mean", "sentiment_std", "negative_ratio", "mismatch_ratio"]
block("b_sentiment_all", "SELECT c.customer_id, CASE WHEN s.customer_id IS NULL THEN 0 ELSE 1 END AS has_review, "
      + ", ".join(f"coalesce({c}, 0) AS {c}" for c in SENTIMENT)
      + " FROM (SELECT DISTINCT customer_id FROM c_orders) c LEFT JOIN b_sentiment s USING (customer_id)")
block("b_split_latest", """
SELECT split, max(order_purchase_timestamp) AS latest FROM c_orders JOIN b_split USING (customer_id) GROUP BY split""")
block("b_window_rows", """
SELECT o.customer_id, s.split, o.order_id, p.paid, i.price, i.freight_value,
  row_number() OVER (PARTITION BY o.order_id) AS nth
FROM c_orders o JOIN b_split s USING (customer_id) JOIN b_split_latest l USING (split)
LEFT JOIN c_items i USING (order_id)
LEFT JOIN (SELECT order_id, sum(payment_value) AS paid FROM c_payments GROUP BY order_id) p USING (order_id)
WHERE o.order_purchase_timestamp BETWEEN l.latest - INTERVAL 6 MONTH - INTERVAL 6 MONTH AND l.latest - INTERVAL 6 MONTH""")


def history(monthly: str, rows: str) -> str:
    return f"""
SELECT customer_id, any_value(split) AS split, {monthly} AS monthly,
  {rnd(f"avg(paid) {rows}", 2)} AS mean_paid, {rnd(f"coalesce(sum(paid) {rows}, 0)", 2)} AS spend,
  coalesce({rnd("sum(freight_value)", 2)} / nullif({rnd("sum(price)", 2)}, 0), 0) AS shipping
FROM b_window_rows GROUP BY customer_id"""


block("b_hist_flow", history("count(*) / 6", ""))
block("b_hist_module", history(rnd("count(*) / 6", 2), ""))
block("b_hist_dedupe", history("count(DISTINCT order_id) / 6", "FILTER (nth = 1)"))


def flagged(table: str, mean_name: str) -> str:
    train = f"(SELECT * FROM {table} WHERE split = 'train')"
    return f"""
SELECT customer_id, monthly AS rfm_hist_monthly_orders, mean_paid AS {mean_name}, shipping AS rfm_hist_shipping_ratio,
  (spend > {quantile("spend", train, 0.75)})::INT AS rfm_hist_was_valuable,
  (monthly > {quantile("monthly", train, 0.75)})::INT AS rfm_hist_was_frequent
FROM {table}"""


block("b_history", flagged("b_hist_flow", "rfm_hist_payment_value_mean"))
block("b_shipping", f"""
SELECT customer_id, frequency, total_spend, avg_order_value, avg_shipping, recency_days,
  coalesce(avg_shipping / nullif(avg_order_value, 0), 0) AS shipping_ratio
FROM (
  SELECT o.customer_id, count(o.order_id) AS frequency, {rnd("coalesce(sum(p.paid), 0)", 2)} AS total_spend,
    {rnd("avg(p.paid)", 2)} AS avg_order_value, {rnd("avg(i.freight_value)", 2)} AS avg_shipping,
    {days(LATEST, "max(o.order_purchase_timestamp)")} AS recency_days
  FROM c_orders o
  LEFT JOIN (SELECT order_id, sum(payment_value) AS paid FROM c_payments GROUP BY order_id) p USING (order_id)
  LEFT JOIN c_items i USING (order_id)
  GROUP BY o.customer_id)""")
SHIPPING_NUMBERS = ["recency_days", "frequency", "total_spend", "avg_order_value", "avg_shipping", "shipping_ratio"]
SHIPPING_LIMITS = {"5pct": "0.05::DOUBLE", "10pct": "0.1::DOUBLE", "15pct": "0.15::DOUBLE", "20pct": "0.2::DOUBLE",
                   "75pct": quantile("shipping_ratio", "b_shipping", 0.75), "90pct": quantile("shipping_ratio", "b_shipping", 0.9)}
block("b_order_payments", """
SELECT order_id, max(payment_installments) AS install_max, avg(payment_installments) AS install_mean,
  count(DISTINCT payment_type) AS n_types, sum(payment_value) AS value, avg(payment_value) AS value_mean,
  max(payment_sequential) AS n_methods
FROM c_payments GROUP BY order_id""")
block("b_payment_features", f"""
SELECT *, (coalesce(payment_installments, 0) > 6)::INT AS payment_high_installments,
  (coalesce(payment_type, 0) > 1)::INT AS payment_multiple_types
FROM (SELECT o.customer_id, {rnd("avg(install_max)", 2)} AS payment_installments, {rnd("avg(n_types)", 2)} AS payment_type,
        {rnd("avg(value)", 2)} AS payment_value
      FROM c_orders o LEFT JOIN b_order_payments USING (order_id) GROUP BY o.customer_id)""")
block("b_cancel", f"""
SELECT customer_id, {share("order_status = 'canceled'")} AS cancellation_ratio,
  max(CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END) AS has_cancellations
FROM c_orders GROUP BY customer_id""")

DELIVERY = """delivery_days_diff_mean delivery_actual_days_mean delivery_actual_days_std delivery_late_ratio delivery_slow_ratio
delivery_very_slow_ratio delivery_consistently_late delivery_frequently_slow delivery_has_very_slow delivery_inconsistent
delivery_dissatisfaction_score delivery_likely_dissatisfied delivery_speed_fast delivery_speed_normal delivery_speed_slow
delivery_speed_very_slow""".split()
REVIEW = ["review_review_score_mean", "review_review_score_min", "review_bad_ratio", "review_dissatisfied"]
HISTORY = ["rfm_hist_monthly_orders", "rfm_hist_payment_value_mean", "rfm_hist_shipping_ratio", "rfm_hist_was_valuable", "rfm_hist_was_frequent"]
PAYMENT = ["payment_installments", "payment_type", "payment_value", "payment_high_installments", "payment_multiple_types"]
CANCEL = ["cancellation_ratio", "has_cancellations"]
ALL_FEATURES = [*DELIVERY, *REVIEW, *HISTORY, *PAYMENT, *CANCEL]
FRACTIONS = """delivery_days_diff_mean delivery_actual_days_mean delivery_actual_days_std delivery_late_ratio delivery_slow_ratio
delivery_very_slow_ratio delivery_dissatisfaction_score review_review_score_mean review_bad_ratio rfm_hist_monthly_orders
rfm_hist_payment_value_mean rfm_hist_shipping_ratio payment_installments payment_type payment_value cancellation_ratio"""
block("b_review_features", """
SELECT *, (review_review_score_mean < 3.5)::INT AS review_dissatisfied FROM b_reviews_scored""")
block("b_churn_features", "SELECT s.customer_id, s.split, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in ALL_FEATURES) + """
FROM b_split s LEFT JOIN b_delivery USING (customer_id) LEFT JOIN b_review_features USING (customer_id)
LEFT JOIN b_history USING (customer_id) LEFT JOIN b_payment_features USING (customer_id) LEFT JOIN b_cancel USING (customer_id)""")
block("b_dataset", """
SELECT f.*, l.is_churned, l.days_since_last_order FROM b_churn_features f JOIN b_labels l USING (customer_id)""")

DESCRIBED = """delivery_days_diff_mean delivery_days_diff_max delivery_delivery_actual_days_mean delivery_delivery_promised_days_mean
delivery_order_id_count delivery_late_ratio delivery_very_late_ratio delivery_long_promise_ratio""".split()
SCALED = ["payment_value", "delivery_days_diff_mean", "delivery_actual_days_mean", "cancellation_ratio"]


def described(c: str) -> str:
    q = [rnd(quantile(c, "b_promise", p)) for p in (0.25, 0.5, 0.75)]
    return f"""SELECT '{c}' AS feature, count({c}) AS count, {rnd(f"avg({c})")} AS mean, {rnd(f"stddev_samp({c})")} AS std,
  {rnd(f"min({c})")} AS min, {rnd(f"max({c})")} AS max, {q[0]} AS p25, {q[1]} AS p50, {q[2]} AS p75 FROM b_promise"""


def standard(c: str) -> str:
    train = "(SELECT * FROM b_churn_features WHERE split = 'train')"
    spread = f"(SELECT stddev_pop({c}) FROM {train})"
    return f"{rnd(f'coalesce(({c} - (SELECT avg({c}) FROM {train})) / nullif({spread}, 0), 0)')} AS {c}"


SQL = {
    "churn_labels": "SELECT * FROM b_labels",
    "churn_rate": f"SELECT count(*) AS customers, {rnd('avg(is_churned)')} AS churn_rate, max(last_purchase) AS latest_purchase FROM b_labels",
    "stratified_split": "SELECT customer_id, is_churned, split FROM b_labels JOIN b_split USING (customer_id)",
    "class_balance": f"""
SELECT split, count(*) AS customers, sum(is_churned)::BIGINT AS churned, {rnd('avg(is_churned)')} AS churn_rate
FROM b_labels JOIN b_split USING (customer_id) GROUP BY split""",
    "delivered_orders": "SELECT * EXCLUDE (days_diff, actual_days, promised_days) FROM b_delivered",
    "date_arithmetic": f"""
SELECT order_id, {days('order_delivered_customer_date', 'order_estimated_delivery_date')} AS days_late,
  order_purchase_timestamp + INTERVAL 1 DAY AS next_day, order_purchase_timestamp - INTERVAL 6 MONTH AS half_year_before
FROM c_orders""",
    "delivery_features": f"SELECT * REPLACE ({cols('delivery_late_ratio delivery_slow_ratio delivery_very_slow_ratio delivery_dissatisfaction_score')}) FROM b_delivery",
    "delivery_features_module": f"""
SELECT b.customer_id, diff_mean AS delivery_days_diff_mean, actual_mean AS delivery_actual_days_mean, actual_std AS delivery_actual_days_std,
  {rnd('late')} AS delivery_late_ratio, {rnd('slow')} AS delivery_slow_ratio, {rnd('very_slow')} AS delivery_very_slow_ratio,
  d.delivery_consistently_late, d.delivery_frequently_slow, d.delivery_has_very_slow,
  d.delivery_inconsistent AS delivery_inconsistent_delivery, {rnd('score')} AS delivery_dissatisfaction,
  d.delivery_likely_dissatisfied, d.delivery_speed_fast, d.delivery_speed_normal, d.delivery_speed_slow, d.delivery_speed_very_slow
FROM b_delivery_score b JOIN b_delivery d USING (customer_id)""",
    "delivery_promise_features": f"SELECT * REPLACE ({cols('delivery_late_ratio delivery_very_late_ratio delivery_long_promise_ratio')}) FROM b_promise",
    "winsorize": f"""
SELECT customer_id, {rnd('greatest(least(delivery_days_diff_mean, 30), -30)')} AS delivery_days_diff_mean,
  {rnd('greatest(least(delivery_days_diff_max, 30), -30)')} AS delivery_days_diff_max FROM b_promise""",
    "log_ratios": "SELECT customer_id, " + ", ".join(
        f"{rnd(f'ln({c} + 0.001::DOUBLE)')} AS {c}_log" for c in ("delivery_late_ratio", "delivery_very_late_ratio", "delivery_long_promise_ratio")
    ) + " FROM b_promise",
    "customer_spine": "SELECT c.customer_id, " + ", ".join(
        f"coalesce(p.{c}, 0) AS {c}" if c in ("delivery_days_diff_max", "delivery_order_id_count") else f"{rnd(f'coalesce(p.{c}, 0)')} AS {c}"
        for c in DESCRIBED
    ) + " FROM c_customers c LEFT JOIN b_promise p USING (customer_id)",
    "delivery_features_scaled": "SELECT customer_id, " + ", ".join(
        f"{rnd(scaled(c, 'b_promise_clean'))} AS {c}" for c in PROMISE_SCALED) + " FROM b_promise_clean",
    "describe_features": " UNION ALL ".join(described(c) for c in DESCRIBED),
    "review_features": f"""
SELECT f.* REPLACE ({rnd('review_bad_ratio')} AS review_bad_ratio), {rnd('s.sentiment')} AS review_sentiment_mean
FROM b_review_features f
LEFT JOIN (SELECT o.customer_id, avg(polarity) AS sentiment FROM b_polarity JOIN c_orders o USING (order_id)
           WHERE review_score IS NOT NULL GROUP BY o.customer_id) s USING (customer_id)""",
    "learned_lexicon": "SELECT word, high, low, polarity FROM b_lexicon",
    "lexicon_agreement": f"""
SELECT count(*) AS reviews, count(*) FILTER (polarity <> 0) AS with_polarity,
  count(*) FILTER (polarity <> 0 AND (polarity > 0) = (review_score >= 4)) AS agreeing,
  {rnd('count(*) FILTER (polarity <> 0 AND (polarity > 0) = (review_score >= 4)) / nullif(count(*) FILTER (polarity <> 0), 0)')} AS agreement
FROM (
  SELECT r.review_id, max(r.review_score) AS review_score, coalesce(round(avg(l.polarity), 10), 0) AS polarity
  FROM c_reviews r JOIN b_words w USING (review_id) LEFT JOIN b_learned_lexicon l USING (word)
  WHERE {HELD_OUT} AND (r.review_score >= 4 OR r.review_score <= 2) GROUP BY r.review_id)""",
    "review_sentiment": f"""
SELECT c.customer_id, coalesce(review_score_mean, 0) AS review_score_mean, coalesce(review_score_min, 0) AS review_score_min,
  coalesce(sentiment_mean, 0) AS sentiment_mean, coalesce(sentiment_std, 0) AS sentiment_std,
  CASE WHEN s.customer_id IS NULL THEN 0 ELSE 1 END AS has_review,
  {rnd('coalesce(negative_ratio, 0)')} AS negative_ratio, {rnd('coalesce(mismatch_ratio, 0)')} AS mismatch_ratio
FROM (SELECT DISTINCT customer_id FROM c_orders) c LEFT JOIN b_sentiment s USING (customer_id)""",
    "review_sentiment_scaled": "SELECT customer_id, has_review, "
    + ", ".join(f"{rnd(scaled(c, 'b_sentiment_all'))} AS {c}" for c in SENTIMENT) + " FROM b_sentiment_all",
    "sentiment_class": "SELECT tone AS sentiment_class, count(*) AS reviews FROM b_polarity GROUP BY tone",
    "historical_window": f"""
SELECT order_id, customer_id, order_purchase_timestamp FROM c_orders
WHERE order_purchase_timestamp BETWEEN {LATEST} - INTERVAL 6 MONTH - INTERVAL 6 MONTH AND {LATEST} - INTERVAL 6 MONTH""",
    "rfm_historical": f"SELECT * REPLACE ({cols('rfm_hist_monthly_orders rfm_hist_shipping_ratio')}) FROM b_history",
    "rfm_historical_module": f"SELECT * REPLACE ({cols('rfm_hist_shipping_ratio')}) FROM ({flagged('b_hist_module', 'rfm_hist_spend_mean')})",
    "rfm_historical_deduped": f"SELECT * REPLACE ({cols('rfm_hist_monthly_orders rfm_hist_shipping_ratio')}) FROM ({flagged('b_hist_dedupe', 'rfm_hist_payment_value_mean')})",
    "rfm_shipping_features": "SELECT customer_id, " + ", ".join(f"{rnd(scaled(c, 'b_shipping'))} AS {c}" for c in SHIPPING_NUMBERS)
    + ", " + ", ".join(f"(shipping_ratio > {limit})::INT AS ship_above_{name}" for name, limit in SHIPPING_LIMITS.items()) + " FROM b_shipping",
    "payment_features": "SELECT * FROM b_payment_features",
    "payment_features_module": f"""
SELECT *, (coalesce(payment_install_max_mean, 0) > 6)::INT AS payment_high_installments,
  (coalesce(payment_type_nunique_mean, 0) > 1)::INT AS payment_multiple_types
FROM (SELECT o.customer_id, {rnd('avg(install_max)', 2)} AS payment_install_max_mean, {rnd('avg(install_mean)', 2)} AS payment_install_mean_mean,
        {rnd('avg(n_types)', 2)} AS payment_type_nunique_mean, {rnd('avg(value_mean)', 2)} AS payment_payment_mean_mean
      FROM c_orders o LEFT JOIN b_order_payments USING (order_id) GROUP BY o.customer_id)""",
    "payment_complexity": f"""
SELECT customer_id, {cols('pm_mean_methods pm_mean_types pm_mean_high_inst pm_mean_max_inst')}, num_orders,
  {rnd('methods / num_orders')} AS complex_payment_ratio,
  {rnd('pm_mean_high_inst * 0.4::DOUBLE + pm_mean_methods * 0.3::DOUBLE + (pm_mean_max_inst / 12) * 0.3::DOUBLE', 3)} AS financial_stress_score
FROM (SELECT o.customer_id, avg((n_methods > 1)::INT) AS pm_mean_methods, avg((n_types > 1)::INT) AS pm_mean_types,
        avg((install_max > 6)::INT) AS pm_mean_high_inst, avg(install_max) AS pm_mean_max_inst, count(DISTINCT o.order_id) AS num_orders,
        coalesce(sum((n_methods > 1)::INT), 0) AS methods
      FROM c_orders o LEFT JOIN b_order_payments USING (order_id) GROUP BY o.customer_id)""",
    "cancellation_features": f"SELECT customer_id, {cols('cancellation_ratio')}, has_cancellations FROM b_cancel",
    "semi_join_split": """
SELECT review_id, order_id, review_score FROM c_reviews
WHERE order_id IN (SELECT order_id FROM c_orders WHERE customer_id IN (SELECT customer_id FROM b_split WHERE split = 'test'))""",
    "semi_join_items": f"""
SELECT order_id, order_item_id, product_id, {rnd('price')} AS price FROM c_items
WHERE order_id IN (SELECT order_id FROM c_orders WHERE customer_id IN (SELECT customer_id FROM b_split WHERE split = 'test'))""",
    "semi_join_payments": f"""
SELECT order_id, payment_sequential, payment_type, {rnd('payment_value')} AS payment_value FROM c_payments
WHERE order_id IN (SELECT order_id FROM c_orders WHERE customer_id IN (SELECT customer_id FROM b_split WHERE split = 'test'))""",
    "churn_features": f"SELECT * REPLACE ({cols(FRACTIONS)}) FROM b_churn_features",
    "churn_dataset": f"SELECT * REPLACE ({cols(FRACTIONS)}) FROM b_dataset",
    "constant_features": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {rnd(f'min({c})')} AS minimum, (count(DISTINCT {c}) <= 1)::INT AS is_constant FROM b_churn_features WHERE split = 'train'"
        for c in ALL_FEATURES
    ),
    "standard_scale": "SELECT customer_id, split, " + ", ".join(standard(c) for c in SCALED) + " FROM b_churn_features",
    "robust_scale": "SELECT customer_id, split, " + ", ".join(f"{rnd(scaled(c, 'b_churn_features'))} AS {c}" for c in SCALED) + " FROM b_churn_features",
    "null_rates": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {rnd(f'avg(({c} IS NULL)::INT)', 3)} AS null_rate FROM c_reviews"""
        for c in ("review_id", "order_id", "review_score", "review_comment_message")
    ),
    "order_delivery_features": """
SELECT order_id, promised_days, actual_days, days_diff, month(order_purchase_timestamp)::INT AS purchase_month,
  (dayofweek(order_purchase_timestamp) + 1)::INT AS purchase_weekday, (days_diff > 0)::INT AS is_late FROM b_delivered""",
    "monthly_churn": f"""
SELECT strftime(m, '%Y-%m') AS month, count(*) AS "totalCustomers",
  count(*) FILTER (date_trunc('month', last_order + INTERVAL 6 MONTH) <= m) AS "churnedCustomers",
  {rnd("count(*) FILTER (date_trunc('month', last_order + INTERVAL 6 MONTH) <= m) / count(*)", 3)} AS "churnRate",
  {rnd("1 - count(*) FILTER (date_trunc('month', last_order + INTERVAL 6 MONTH) <= m) / count(*)", 3)} AS "retentionRate"
FROM (SELECT m, customer_id, max(order_purchase_timestamp) AS last_order
      FROM (SELECT unnest(generate_series((SELECT date_trunc('month', min(order_purchase_timestamp)) FROM c_orders)::TIMESTAMP,
                                          (SELECT date_trunc('month', max(order_purchase_timestamp)) FROM c_orders)::TIMESTAMP, INTERVAL 1 MONTH)) AS m)
      JOIN c_orders ON date_trunc('month', order_purchase_timestamp) <= m GROUP BY m, customer_id)
GROUP BY m""",
}

# the second feature set, assembled
block("b_delivery_module", SQL["delivery_features_module"])
block("b_history_module", flagged("b_hist_module", "rfm_hist_spend_mean"))
block("b_payment_module", SQL["payment_features_module"])
block("b_cancel_module", "SELECT customer_id, cancellation_ratio AS cancel_ratio, has_cancellations AS cancel_has_cancel FROM b_cancel")
block("b_sentiment_module", f"""
SELECT o.customer_id, avg(polarity) AS review_sentiment_mean FROM b_polarity JOIN c_orders o USING (order_id)
WHERE review_score IS NOT NULL GROUP BY o.customer_id""")
MODULE_FEATURES = [
    *({"delivery_inconsistent": "delivery_inconsistent_delivery", "delivery_dissatisfaction_score": "delivery_dissatisfaction"}.get(c, c) for c in DELIVERY),
    *REVIEW,
    *(c.replace("payment_value_mean", "spend_mean") for c in HISTORY),
    *"payment_install_max_mean payment_install_mean_mean payment_type_nunique_mean payment_payment_mean_mean".split(),
    *"payment_high_installments payment_multiple_types cancel_ratio cancel_has_cancel review_sentiment_mean".split(),
]
WHOLE = set(c for c in ALL_FEATURES if c not in FRACTIONS.split()) | {"delivery_inconsistent_delivery", "cancel_has_cancel"}
SQL["cancellation_features_module"] = f"SELECT customer_id, {cols('cancel_ratio')}, cancel_has_cancel FROM b_cancel_module"
SQL["churn_features_module"] = "SELECT s.customer_id, s.split, " + ", ".join(
    f"coalesce({c}, 0) AS {c}" if c in WHOLE else f"{rnd(f'coalesce({c}, 0)')} AS {c}" for c in MODULE_FEATURES
) + """
FROM b_split s LEFT JOIN b_delivery_module USING (customer_id) LEFT JOIN b_review_features USING (customer_id)
LEFT JOIN b_history_module USING (customer_id) LEFT JOIN b_payment_module USING (customer_id)
LEFT JOIN b_cancel_module USING (customer_id) LEFT JOIN b_sentiment_module USING (customer_id)"""

ORACLES = {key: statement(sql) for key, sql in SQL.items()}
