from __future__ import annotations

import oracles.churn  # noqa: F401  (defines the blocks)
from oracles.blocks import statement

# what every fitted model must satisfy, row by row; the fits themselves are tested by their properties
SQL = {
    "score_customers": "SELECT customer_id AS id, is_churned AS y, split, 1 AS sound FROM b_dataset",
    "model_roundtrip": "SELECT customer_id AS id, 1 AS equal FROM b_dataset",
}

ORACLES = {key: statement(sql) for key, sql in SQL.items()}
