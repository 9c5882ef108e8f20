from __future__ import annotations

from oracles.blocks import block, quantile, rnd, statement
from oracles.churn import ALL_FEATURES
from patronage.operators.segments import (
    CLUSTER_NAMES,
    FEATURE_ADVICE,
    INSIGHTS,
    OTHER_FEATURE_ADVICE,
    RECOMMENDATIONS,
    RFM_SEGMENTS,
    STANDARD_HAPPY,
    STANDARD_OTHER,
)

# one text is needed on both sides; DuckDB doubles quotes
ADVICE = {segment: text.replace("'", "''") for segment, text in INSIGHTS.items()}
block("b_segmented", "SELECT s.*, f.recency_days, f.frequency, f.total_spent, f.avg_order_value, CASE "
      + " ".join(f"WHEN RFM_score IN ({', '.join(repr(c) for c in codes.split())}) THEN '{name}'" for name, codes in RFM_SEGMENTS)
      + " ELSE 'Lost' END AS RFM_segment FROM b_scores s JOIN b_spend f USING (customer_id)")
block("b_clustered", "SELECT *, (customer_id % 5)::INT AS cluster FROM b_features")
block("b_summary", f"""
SELECT cluster, count(*) AS customers, {rnd('100 * count(*) / (SELECT count(*) FROM b_clustered)', 1)} AS percentage,
  {rnd('avg(avg_order_value)', 2)} AS "avgOrderValue", {rnd('avg(avg_installments)', 2)} AS "avgInstallments",
  {rnd('avg(avg_review_score)', 2)} AS "avgReviewScore", {rnd('avg(review_rate)', 2)} AS "reviewRate",
  {rnd('avg(category_diversity)', 2)} AS "categoryDiversity"
FROM b_clustered GROUP BY cluster""")
block("b_names", f"SELECT * FROM (VALUES {', '.join(map(repr, CLUSTER_NAMES))}) AS t(cluster, name, type)")
block("b_enriched", """
SELECT s.*, n.name, n.type, floor("avgOrderValue" + 0.5)::BIGINT AS "annualValue",
  floor(customers * "avgOrderValue" + 0.5)::BIGINT AS "totalValue"
FROM b_summary s JOIN b_names n USING (cluster)""")
block("b_profiles", "SELECT cluster, avg(frequency) AS f, avg(avg_order_value) AS v, avg(category_diversity) AS d FROM b_clustered GROUP BY cluster")
FEATURES = ["frequency", "avg_order_value", "tenure_days", "avg_installments", "payment_diversity", "avg_review_score", "review_rate", "category_diversity"]
block("b_strength", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, coalesce(CASE WHEN stddev_pop({c}) > 0 THEN corr({c}, is_churned) END, 0) AS coefficient FROM b_dataset WHERE split = 'train'"
    for c in ALL_FEATURES))
block("b_importance", """
SELECT feature, coefficient, abs(round(coefficient, 6)) AS importance,
  row_number() OVER (ORDER BY abs(round(coefficient, 6)) DESC, feature) AS place FROM b_strength""")


def title(c: str) -> str:
    return " ".join(word.capitalize() for word in c.split("_"))


block("b_titles", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{title(c)}')" for c in ALL_FEATURES) + ") AS t(feature, title)")


def stats(c: str) -> str:
    median = "CASE cluster " + " ".join(
        f"WHEN {k} THEN {quantile(c, f'(SELECT * FROM b_clustered WHERE cluster = {k})', 0.5)}" for k in range(5)) + " END"
    return f"""
SELECT cluster, '{c}' AS feature, {rnd(f"avg({c})", 3)} AS mean, {rnd(median, 3)} AS median, {rnd(f"stddev_samp({c})", 3)} AS std,
  CASE WHEN round(avg({c}), 8) > round((SELECT avg({c}) FROM b_clustered), 8) THEN '↑' ELSE '↓' END AS direction
FROM b_clustered GROUP BY cluster"""


def by_type(i: int, standard: str) -> str:
    return "CASE type " + " ".join(f"WHEN '{t}' THEN '{texts[i]}'" for t, texts in RECOMMENDATIONS.items()) + f" ELSE {standard} END"


SQL = {
    "rfm_segments": "SELECT customer_id, RFM_score, RFM_segment FROM b_segmented",
    "segment_distribution": f"""
SELECT RFM_segment, count(*) AS customers, {rnd('100 * count(*) / (SELECT count(*) FROM b_segmented)', 1)} AS percentage
FROM b_segmented GROUP BY RFM_segment""",
    "rfm_segment_profile": f"""
SELECT RFM_segment, {rnd('avg(recency_days)', 2)} AS recency_days_mean, {rnd('avg(frequency)', 2)} AS frequency_mean,
  {rnd('avg(total_spent)', 2)} AS total_spent_mean, {rnd('avg(avg_order_value)', 2)} AS avg_order_value_mean,
  {rnd('avg(coalesce(avg_review_score, 0))', 2)} AS avg_review_score_mean
FROM b_segmented JOIN b_review USING (customer_id) GROUP BY RFM_segment""",
    "value_segment_profile": f"""
SELECT value_segment, {rnd('avg(total_spent)', 2)} AS total_spent_mean, {rnd('min(total_spent)', 2)} AS total_spent_min,
  {rnd('max(total_spent)', 2)} AS total_spent_max, {rnd('avg(frequency)', 2)} AS frequency_mean,
  {rnd('avg(avg_order_value)', 2)} AS avg_order_value_mean, {rnd('avg(recency_days)', 2)} AS recency_days_mean
FROM b_segmented GROUP BY value_segment""",
    "segment_insights": "SELECT RFM_segment, count(*) AS customers, CASE RFM_segment "
    + " ".join(f"WHEN '{s}' THEN '{t}'" for s, t in ADVICE.items()) + " END AS strategy FROM b_segmented GROUP BY RFM_segment",
    "segment_churn": f"""
SELECT value_segment AS name, count(*) AS count, {rnd('avg(avg_order_value)', 2)} AS "avgOrderValue", {rnd('avg(is_churned)', 3)} AS "churnRate",
  'Customers of the spend tier ' || value_segment AS description
FROM b_segmented JOIN b_labels USING (customer_id) GROUP BY value_segment""",
    "segment_summary": "SELECT * FROM b_summary",
    "behavioral_segments": """
SELECT c.customer_id, c.cluster, CASE WHEN f > mf AND v > mv THEN 'High Frequency High Value' WHEN f > mf THEN 'Frequent Buyers'
  WHEN v > mv THEN 'Big Spenders' WHEN d > md THEN 'Category Explorers' ELSE 'Occasional Shoppers' END AS behavioral_segment
FROM b_clustered c JOIN b_profiles USING (cluster) CROSS JOIN (SELECT avg(f) AS mf, avg(v) AS mv, avg(d) AS md FROM b_profiles)""",
    "cluster_statistics": " UNION ALL ".join(stats(c) for c in FEATURES),
    "cluster_value_score": f"""
SELECT cluster, customers, {rnd('value_score')} AS value_score,
  CASE WHEN row_number() OVER (ORDER BY value_score DESC, cluster) = 1 THEN 'high'
       WHEN row_number() OVER (ORDER BY value_score, cluster) = 1 THEN 'low' ELSE 'middle' END AS role
FROM (SELECT cluster, count(*) AS customers, avg(frequency) * 0.4::DOUBLE + avg(avg_order_value) * 0.4::DOUBLE + avg(tenure_days) * 0.2::DOUBLE AS value_score
      FROM b_clustered GROUP BY cluster)""",
    "cluster_revenue": f"""
SELECT cluster, count(*) AS customers, {rnd('avg(avg_order_value) * avg(frequency)')} AS estimated_annual_value,
  {rnd('avg(avg_order_value) * avg(frequency) * count(*)')} AS total_value FROM b_clustered GROUP BY cluster""",
    "cluster_minmax": "SELECT cluster, " + ", ".join(
        f"{rnd(f'({c} - least({chr(44).join(FEATURES)})) / (greatest({chr(44).join(FEATURES)}) - least({chr(44).join(FEATURES)}))')} AS {c}" for c in FEATURES
    ) + " FROM (SELECT cluster, " + ", ".join(f"avg({c}) AS {c}" for c in FEATURES) + " FROM b_clustered GROUP BY cluster)",
    "cluster_names": """
SELECT customer_id, c.cluster, coalesce(name, 'Cluster ' || c.cluster) AS name, coalesce(type, 'standard') AS type
FROM (SELECT DISTINCT customer_id, (customer_id % 6)::INT AS cluster FROM c_orders) c LEFT JOIN b_names n ON n.cluster = c.cluster""",
    "segment_enriched": "SELECT * FROM b_enriched",
    "segment_kpis": f"""
SELECT sum(customers)::BIGINT AS "totalCustomers", sum("totalValue")::BIGINT AS "totalRevenue",
  {rnd("max(percentage) FILTER (type = 'premium')")} AS "premiumPercentage",
  {rnd("sum(percentage) FILTER (type IN ('at-risk', 'low-value'))")} AS "atRiskPercentage" FROM b_enriched""",
    "segment_radar": """
SELECT 'Cluster ' || cluster AS cluster, floor("avgOrderValue" / 400 * 100 + 0.5)::BIGINT AS "Order Value",
  floor("avgReviewScore" / 5 * 100 + 0.5)::BIGINT AS "Review Score", floor("avgInstallments" / 10 * 100 + 0.5)::BIGINT AS "Installments",
  floor("categoryDiversity" * 100 + 0.5)::BIGINT AS "Category Diversity", floor("reviewRate" * 100 + 0.5)::BIGINT AS "Review Rate" FROM b_summary""",
    "segment_recommendation": f"""
SELECT cluster, {by_type(0, 'name')} AS title,
  {by_type(1, f"CASE WHEN avgReviewScore > 4.5 THEN '{STANDARD_HAPPY}' ELSE '{STANDARD_OTHER}' END")} AS description,
  {by_type(2, "'Long-term'")} AS priority, {by_type(3, "'blue'")} AS color
FROM b_enriched""",
    "top_features": f"SELECT feature, {rnd('importance')} AS importance FROM b_importance WHERE place <= 10",
    "feature_titles": f"SELECT feature, title, {rnd('importance')} AS importance FROM b_importance JOIN b_titles USING (feature)",
    "feature_advice": f"""
SELECT title AS feature, {rnd('importance')} AS importance, CASE WHEN coefficient > 0 THEN 'increases' ELSE 'decreases' END AS impact,
  CASE {' '.join(f"WHEN {' OR '.join(f'contains(feature, {word!r})' for word in words)} THEN '{text}'" for words, text in FEATURE_ADVICE)}
    ELSE '{OTHER_FEATURE_ADVICE}' END AS advice
FROM b_importance JOIN b_titles USING (feature) WHERE place <= 3""",
}

block("b_behavioural", SQL["behavioral_segments"])
SQL["labelled_segment_profile"] = "SELECT behavioral_segment, " + ", ".join(
    f"{rnd(f'avg({c})', 2)} AS {c}_mean"
    for c in "frequency avg_order_value category_diversity payment_diversity avg_review_score total_spent".split()
) + " FROM b_behavioural JOIN b_clustered USING (customer_id) GROUP BY behavioral_segment"

ORACLES = {key: statement(sql) for key, sql in SQL.items()}
