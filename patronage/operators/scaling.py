"""Feature scaling with statistics learned in one pass and applied row by row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from patronage.operators.ordering import exact_quantiles


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation; a column without spread becomes 0."""
    source = df if fit_on is None else fit_on
    row = source.agg(
        *(F.avg(c).alias(f"m_{c}") for c in columns), *(F.stddev_pop(c).alias(f"s_{c}") for c in columns)
    ).first()
    return df.withColumns(
        {
            c: (F.col(c) - F.lit(row[f"m_{c}"])) / F.lit(row[f"s_{c}"]) if row[f"s_{c}"] else F.lit(0.0)
            for c in columns
        }
    )


def robust_scale(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(x - median) / interquartile range; without a range the divisor is 1."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    scaled = {}
    for c in columns:
        low, middle, high = quartiles.get(c, (0.0, 0.0, 0.0))
        scaled[c] = (F.col(c) - F.lit(middle)) / F.lit((high - low) or 1.0)
    return df.withColumns(scaled)
