from __future__ import annotations

from oracles.blocks import block, rnd, statement

MEASURES = ["frequency", "avg_order_value", "tenure_days"]
block("b_scaled", "SELECT customer_id, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / (stddev_pop({c}) OVER ()) AS {c}" for c in MEASURES) + " FROM b_spend")
block("b_points_fixed", """
SELECT k, customer_id AS id, customer_id % k AS label, j, CASE j WHEN 1 THEN frequency WHEN 2 THEN avg_order_value ELSE tenure_days END AS v
FROM b_scaled CROSS JOIN range(2, 11) AS r(k) CROSS JOIN range(1, 4) AS d(j)""")
block("b_points_emb", """
SELECT 0 AS k, vec_id AS id, label, unnest(range(1, 65)) AS j, unnest(embedding)::DOUBLE AS v FROM embeddings""")


def quality(points: str, suffix: str) -> None:
    block(f"b_centers_{suffix}", f"SELECT k, label, j, avg(v) AS c, count(*) AS n FROM {points} GROUP BY k, label, j")
    block(f"b_dist_{suffix}", f"""
SELECT p.k, p.id, p.label, sum((p.v - c.c) * (p.v - c.c)) AS d2
FROM {points} p JOIN b_centers_{suffix} c ON c.k = p.k AND c.label = p.label AND c.j = p.j GROUP BY p.k, p.id, p.label""")
    block(f"b_spread_{suffix}", f"SELECT k, label, avg(sqrt(d2)) AS s, sum(d2) AS inertia FROM b_dist_{suffix} GROUP BY k, label")
    block(f"b_pairs_{suffix}", f"""
SELECT a.k, a.label, b.label AS other, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS m
FROM b_centers_{suffix} a JOIN b_centers_{suffix} b ON a.k = b.k AND a.j = b.j AND a.label <> b.label GROUP BY a.k, a.label, b.label""")
    block(f"b_db_{suffix}", f"""
SELECT k, avg(worst) AS db_index FROM (
  SELECT m.k, m.label, max((x.s + y.s) / m.m) AS worst FROM b_pairs_{suffix} m
  JOIN b_spread_{suffix} x ON x.k = m.k AND x.label = m.label JOIN b_spread_{suffix} y ON y.k = m.k AND y.label = m.other
  GROUP BY m.k, m.label) GROUP BY k""")
    # mean squared distance of a point to the members of a cluster, from distance to the centre and inertia
    block(f"b_far_{suffix}", f"""
SELECT p.k, p.id, p.label, c.label AS other, any_value(c.n) AS n,
  sum((p.v - c.c) * (p.v - c.c)) + any_value(s.inertia) / any_value(c.n) AS mean
FROM {points} p JOIN b_centers_{suffix} c ON c.k = p.k AND c.j = p.j JOIN b_spread_{suffix} s ON s.k = c.k AND s.label = c.label
GROUP BY p.k, p.id, p.label, c.label""")
    block(f"b_sil_{suffix}", f"""
SELECT k, avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) AS silhouette FROM (
  SELECT k, id, max(n) FILTER (label = other) AS n, max(mean * n / nullif(n - 1, 0)) FILTER (label = other) AS a,
    min(mean) FILTER (label <> other) AS b FROM b_far_{suffix} GROUP BY k, id) GROUP BY k""")


quality("b_points_fixed", "fixed")
quality("b_points_emb", "emb")
block("b_inertia_fixed", "SELECT k, sum(inertia) AS inertia FROM b_spread_fixed GROUP BY k")

SQL = {
    "elbow_k": f"""
SELECT k::INT AS elbow_k, {rnd('bend')} AS bend FROM (
  SELECT k, abs((lag(inertia) OVER o - inertia) - (inertia - lead(inertia) OVER o)) AS bend FROM b_inertia_fixed WINDOW o AS (ORDER BY k))
WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1""",
    "k_metric_ranks": f"""
SELECT k::INT AS k, {rnd('silhouette')} AS silhouette, {rnd('db_index')} AS db_index,
  rank() OVER (ORDER BY silhouette DESC)::DOUBLE AS silhouette_rank, rank() OVER (ORDER BY db_index)::DOUBLE AS db_rank
FROM b_sil_fixed JOIN b_db_fixed USING (k)""",
    "best_k": """
SELECT (SELECT k FROM b_sil_fixed ORDER BY round(silhouette, 9) DESC, k LIMIT 1)::INT AS by_silhouette,
  (SELECT k FROM b_db_fixed ORDER BY round(db_index, 9), k LIMIT 1)::INT AS by_db_index,
  (SELECT k FROM (
    SELECT k, abs((lag(inertia) OVER o - inertia) - (inertia - lead(inertia) OVER o)) AS bend FROM b_inertia_fixed WINDOW o AS (ORDER BY k))
   WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1)::INT AS by_elbow""",
    "davies_bouldin": f"""
SELECT {rnd('(SELECT db_index FROM b_db_emb)')} AS db_index, {rnd('(SELECT sum(inertia) FROM b_spread_emb)')} AS inertia""",
    "silhouette": f"SELECT {rnd('silhouette')} AS silhouette FROM b_sil_emb",
}

ORACLES = {key: statement(sql) for key, sql in SQL.items()}
