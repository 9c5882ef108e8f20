from __future__ import annotations

from oracles.blocks import block, cols, quantile, rnd, statement
from oracles.churn import SCALED


def number(x: float) -> str:
    """A literal that DuckDB reads as this very double."""
    return f"{x:.17e}"


def evenly(start: float, stop: float, count: int) -> list[float]:
    step = (stop - start) / (count - 1)
    return [start + i * step for i in range(count - 1)] + [stop]


def counts(thresholds: list[float]) -> str:
    values = ", ".join(f"({number(t)}, {number(round(t, 2))})" for t in thresholds)
    return f"""
SELECT split, t AS threshold, t2,
  count(*) FILTER (p >= t AND y = 1) AS tp, count(*) FILTER (p >= t AND y = 0) AS fp,
  count(*) FILTER (p < t AND y = 1) AS fn, count(*) FILTER (p < t AND y = 0) AS tn
FROM c_scored CROSS JOIN (VALUES {values}) AS v(t, t2) GROUP BY split, t, t2"""


RATES = """coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1"""
LIFETIME = number(89 * 4.2 * (18 / 12))

block("b_score_counts", "SELECT split, p, sum(y)::BIGINT AS pos, sum(1 - y)::BIGINT AS neg FROM c_scored GROUP BY split, p")
block("b_curve", """
SELECT split, p, pos, neg,
  sum(pos) OVER down AS tp, sum(neg) OVER down AS fp,
  sum(pos) OVER (PARTITION BY split) AS pos_total, sum(neg) OVER (PARTITION BY split) AS neg_total,
  lead(pos) OVER (PARTITION BY split ORDER BY p DESC) AS next_pos, lead(neg) OVER (PARTITION BY split ORDER BY p DESC) AS next_neg,
  row_number() OVER (PARTITION BY split ORDER BY p DESC) AS place
FROM b_score_counts WINDOW down AS (PARTITION BY split ORDER BY p DESC ROWS UNBOUNDED PRECEDING)""")
block("b_auc", """
SELECT split, sum(pos * (neg_total - fp + neg * 0.5::DOUBLE)) / (max(pos_total)::DOUBLE * max(neg_total)) AS auc,
  sum(pos / pos_total * tp / (tp + fp)) AS avg_precision
FROM b_curve GROUP BY split""")
block("b_confusion", """
SELECT split, count(*) FILTER (p >= 0.5 AND y = 1) AS tp, count(*) FILTER (p >= 0.5 AND y = 0) AS fp,
  count(*) FILTER (p < 0.5 AND y = 1) AS fn, count(*) FILTER (p < 0.5 AND y = 0) AS tn
FROM c_scored GROUP BY split""")
block("b_rates", f"SELECT *, {RATES}, coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0) AS accuracy FROM b_confusion")
block("b_sweep", f"""
SELECT *, tp * {LIFETIME} * 0.7::DOUBLE - fn * {LIFETIME} - (tp + fp) * 25 AS net_benefit
FROM (SELECT split, t2 AS threshold, tp, fp, fn, tn, {RATES} FROM ({counts(evenly(0.05, 0.95, 91))}))""")
block("b_best", """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY net_benefit DESC, threshold) AS place FROM b_sweep) WHERE place = 1""")
block("b_report", f"""
SELECT split, threshold, {cols('precision recall f1', 3)}, fp AS "falsePositives", fn AS "falseNegatives",
  tp AS "truePositives", tn AS "trueNegatives", trunc(net_benefit)::BIGINT AS "netBenefit",
  CASE threshold WHEN 3e-1 THEN 'Low Threshold' WHEN 9e-1 THEN 'High Threshold' ELSE 'Recommended' END AS description
FROM (SELECT * FROM b_sweep WHERE threshold IN (3e-1, 9e-1) UNION ALL SELECT * FROM b_best)""")
block("b_options", f"""
SELECT split, threshold, tp, fp, fn, tp * 500 * 0.3::DOUBLE - (tp + fp) * 50 AS net_benefit FROM ({counts([0.3, 0.5, 0.7])})""")


def risk(by: str) -> str:
    tiers = [("High Risk", "p >= 0.7::DOUBLE", "0.87", "#ef4444"),
             ("Medium Risk", "p >= 0.3::DOUBLE AND p < 0.7::DOUBLE", "0.34", "#f59e0b"),
             ("Low Risk", "p < 0.3::DOUBLE", "0.08", "#10b981")]
    return " UNION ALL ".join(f"""
SELECT {by} '{name}' AS name, count(*) FILTER ({test}) * 10 AS count, {rnd(f"count(*) FILTER ({test}) / count(*) * 100", 1)} AS percentage,
  {rnd(f"coalesce(avg(y) FILTER ({test}), {assumed})", 2)} AS "churnRate", '{colour}' AS color
FROM c_scored {'GROUP BY split' if by else ''}""" for name, test, assumed, colour in tiers)


EDGES = [number(e) for e in evenly(0.0, 1.0, 11)[1:-1]]


def psi(c: str) -> str:
    train = "(SELECT * FROM b_churn_features WHERE split = 'train')"
    edges = ", ".join(quantile(c, train, i / 10) for i in range(1, 10))
    return f"""
SELECT '{c}' AS feature, sum((a - e) * ln(a / e)) AS psi FROM (
  SELECT greatest(count(*) FILTER (split = 'train') / any_value(n_train), 0.0001::DOUBLE) AS e,
         greatest(count(*) FILTER (split = 'test') / any_value(n_test), 0.0001::DOUBLE) AS a
  FROM (SELECT split, len(list_filter(list_distinct([{edges}]), lambda x: x < {c})) AS bin,
          count(*) FILTER (split = 'train') OVER () AS n_train, count(*) FILTER (split = 'test') OVER () AS n_test
        FROM b_churn_features WHERE split <> 'val') GROUP BY bin)"""


SQL = {
    "roc_auc": f"""
SELECT split, {rnd('auc')} AS auc, CASE WHEN auc > 0.85 THEN 'Excellent' WHEN auc > 0.75 THEN 'Good' ELSE 'Fair' END AS rating FROM b_auc""",
    "average_precision": f"SELECT split, {rnd('avg_precision')} AS avg_precision FROM b_auc",
    "roc_curve": f"""
SELECT split, {rnd('p')} AS threshold, {rnd('fp / neg_total')} AS fpr, {rnd('tp / pos_total')} AS tpr FROM b_curve
WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT DISTINCT split, 'Infinity'::DOUBLE, 0::DOUBLE, 0::DOUBLE FROM c_scored""",
    "pr_curve": f"""
SELECT split, {rnd('p')} AS threshold, {rnd('tp / (tp + fp)')} AS precision, {rnd('tp / pos_total')} AS recall FROM b_curve
UNION ALL SELECT DISTINCT split, NULL::DOUBLE, 1::DOUBLE, 0::DOUBLE FROM c_scored""",
    "classification_metrics": f"SELECT split, tp, fp, fn, tn, {cols('precision recall f1 accuracy')} FROM b_rates",
    "confusion_matrix": f"""
SELECT split, 0 AS actual, 0 AS predicted, tn AS customers, {rnd('tn / (tn + fp)')} AS share FROM b_confusion
UNION ALL SELECT split, 0, 1, fp, {rnd('fp / (tn + fp)')} FROM b_confusion
UNION ALL SELECT split, 1, 0, fn, {rnd('fn / (fn + tp)')} FROM b_confusion
UNION ALL SELECT split, 1, 1, tp, {rnd('tp / (fn + tp)')} FROM b_confusion""",
    "model_metrics_by_split": f"SELECT split, {cols('precision recall f1 accuracy auc avg_precision')} FROM b_rates JOIN b_auc USING (split)",
    "calibration_curve": f"""
SELECT split, bin, count(*) AS customers, {rnd('avg(p)')} AS mean_predicted, {rnd('avg(y)')} AS fraction_positive
FROM (SELECT *, ({' + '.join(f'(p > {e})::INT' for e in EDGES)}) AS bin FROM c_scored) GROUP BY split, bin""",
    "score_histogram": f"""
SELECT split, y, bin, count(*) AS customers, {rnd('any_value(low) + bin * any_value(w)')} AS lower,
  {rnd('count(*) / (any_value(n) * any_value(w))')} AS density
FROM (SELECT *, (SELECT max(i) FROM range(50) AS r(i) WHERE p >= low + i * w)::INT AS bin
      FROM (SELECT *, min(p) OVER g AS low, (max(p) OVER g - min(p) OVER g) / 50 AS w, count(*) OVER g AS n
            FROM c_scored WINDOW g AS (PARTITION BY split, y)))
GROUP BY split, y, bin""",
    "threshold_curve": f"SELECT split, {rnd('threshold')} AS threshold, {cols('precision recall f1')} FROM (SELECT split, threshold, {RATES} FROM ({counts(evenly(0.0, 1.0, 100))}))",
    "threshold_sweep": f"SELECT split, threshold, tp, fp, fn, tn, {cols('precision recall f1 net_benefit')} FROM b_sweep",
    "threshold_report": "SELECT * FROM b_report",
    "threshold_options": f"""
SELECT split, threshold, tp, fp, fn, {rnd('net_benefit')} AS net_benefit,
  (row_number() OVER (PARTITION BY split ORDER BY net_benefit DESC, CASE threshold WHEN 0.5 THEN 0 WHEN 3e-1 THEN 1 ELSE 2 END) = 1)::INT AS recommended
FROM b_options""",
    "risk_segmentation": risk("split,"),
    "business_impact": f"""
SELECT split, trunc(saved)::BIGINT AS "revenueSaved", trunc(cost)::BIGINT AS "retentionCosts", trunc(missed)::BIGINT AS "missedRevenue",
  trunc(saved - cost - missed)::BIGINT AS "netBenefit", {rnd('(saved - cost - missed) / cost * 100', 1)} AS roi
FROM (SELECT split, tp * 10 * {LIFETIME} * 0.7::DOUBLE AS saved, (tp * 10 + fp * 10) * 25.0::DOUBLE AS cost, fn * 10 * {LIFETIME} AS missed FROM b_confusion)""",
    "recommended_threshold": f"""
SELECT r.split, r.threshold, r."truePositives", r."falsePositives", r."falseNegatives", r."trueNegatives",
  {rnd('r."truePositives" / (r."truePositives" + r."falsePositives")')} AS precision,
  {rnd('r."truePositives" / (r."truePositives" + r."falseNegatives")')} AS recall
FROM (SELECT DISTINCT * FROM b_report) r JOIN b_best b ON b.split = r.split AND b.threshold = r.threshold""",
    "churn_kpis": f"""
SELECT sum(count)::BIGINT AS "totalCustomers", (sum(count) FILTER (name = 'High Risk'))::BIGINT AS "highRiskCustomers",
  {rnd('(SELECT avg("churnRate") FROM b_monthly_churn)')} AS "avgChurnRate"
FROM ({risk('')})""",
    "class_weights": f"""
SELECT is_churned AS label, count(*) AS customers, {rnd('any_value(n) / (2 * count(*))')} AS weight,
  {rnd('any_value(n0) / any_value(n1)')} AS positive_ratio
FROM (SELECT is_churned, count(*) OVER () AS n, count(*) FILTER (is_churned = 0) OVER () AS n0, count(*) FILTER (is_churned = 1) OVER () AS n1
      FROM b_labels JOIN b_split USING (customer_id) WHERE split = 'train') GROUP BY is_churned""",
    "precision_at_k": " UNION ALL ".join(f"""
SELECT '{s}' AS split, {rnd('any_value(cut)')} AS cut, count(*) AS customers, {rnd('avg(y)')} AS precision
FROM c_scored, (SELECT {quantile('p', f"(SELECT * FROM c_scored WHERE split = '{s}')", 0.8)} AS cut) WHERE split = '{s}' AND p >= cut"""
                                   for s in ("train", "val", "test")),
    "weekly_auc_alert": f"""
SELECT week, {rnd('auc')} AS auc, {rnd('previous_auc')} AS previous_auc,
  coalesce((auc < previous_auc * (1 - 0.03::DOUBLE))::INT, 0) AS alert
FROM (SELECT week, auc, lag(auc) OVER (ORDER BY week) AS previous_auc FROM (
  SELECT a.week, sum(CASE WHEN a.y = 1 AND b.y = 0 THEN CASE WHEN a.p > b.p THEN 1.0::DOUBLE WHEN a.p = b.p THEN 0.5::DOUBLE ELSE 0 END END)
      / nullif(count(*) FILTER (a.y = 1 AND b.y = 0), 0) AS auc
  FROM b_weekly a JOIN b_weekly b ON a.week = b.week GROUP BY a.week))""",
    "psi_drift": f"SELECT feature, {rnd('psi')} AS psi, (psi > 0.2)::INT AS alert FROM (" + " UNION ALL ".join(psi(c) for c in SCALED) + ")",
}
block("b_weekly", """
SELECT s.id, s.y, s.p, date_trunc('week', o.order_purchase_timestamp)::TIMESTAMP AS week
FROM c_scored s JOIN c_orders o ON o.order_id = s.id""")
from oracles import churn as _churn  # noqa: E402

block("b_monthly_churn", _churn.SQL["monthly_churn"])

ORACLES = {key: statement(sql) for key, sql in SQL.items()}
