"""Joins against a smaller side, safe when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str, how: str = "left", salts: int | None = None) -> DataFrame:
    """Join `facts` with a lookup table by `how` in left, inner or left_semi.

    The optimiser broadcasts a lookup whose size in bytes is under its threshold, and splits skewed
    partitions of a larger one while the job runs. Where the skew is known, `salts` spreads every key of
    the facts over that many partitions by a hash of the row and repeats the lookup as often; the hash
    makes the spread the same when a task is repeated.
    """
    if salts is None:
        return facts.join(lookup, on, how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return salted.join(copies, [on, "_salt"], how).drop("_salt")
