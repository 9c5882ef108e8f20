"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

MICROS_PER_DAY = 86_400_000_000


def floor_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole days between two timestamps, rounded down: minus one hour is minus one day."""
    later = F.col(later) if isinstance(later, str) else later
    earlier = F.col(earlier) if isinstance(earlier, str) else earlier
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(MICROS_PER_DAY))


def plus_months(ts: Column, months: int) -> Column:
    """Calendar shift that keeps the time of day and stops at the end of short months."""
    return ts + F.make_ym_interval(F.lit(0), F.lit(months))


def plus_days(ts: Column, days: int) -> Column:
    return ts + F.make_dt_interval(F.lit(days))


def round_half_even(x: Column, digits: int) -> Column:
    """Round ties to the even neighbour.

    The inner `round` removes the last-bit noise that a different order of summation
    leaves, so that a tie is the same tie on every run.
    """
    scale = F.lit(float(10**digits))
    return F.rint(F.round(x, 8) * scale) / scale


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating point column of a result."""
    return df.select(
        *(
            round_half_even(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f.name)
            for f in df.schema
        )
    )


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is 0 where the denominator is 0 or a side is missing."""
    return F.coalesce(numerator / F.nullif(denominator, F.lit(0)), F.lit(0.0))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def fill_missing(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Replace nulls by 0, and by "0" in text columns."""
    text = [f.name for f in df.schema if isinstance(f.dataType, StringType) and f.name not in keep]
    other = [f.name for f in df.schema if f.name not in text and f.name not in keep]
    return df.fillna(0, subset=other).fillna("0", subset=text)


def cascade(rules: list[tuple[Column, object]], default: object) -> Column:
    """First matching rule wins."""
    first, *rest = rules
    chain = reduce(lambda acc, rule: acc.when(rule[0], rule[1]), rest, F.when(first[0], first[1]))
    return chain.otherwise(default)


def count_above(x: Column, edges: list[float]) -> Column:
    """How many of the edges lie strictly below `x`."""
    return reduce(lambda acc, edge: acc + (x > F.lit(edge)).cast("int"), edges, F.lit(0))


def title_case(name: Column) -> Column:
    """`payment_value` becomes `Payment Value`."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def polarity_class(score: Column) -> Column:
    """Intervals (-1, -0.1], (-0.1, 0.1], (0.1, 1]; -1 itself and values above 1 belong to none."""
    return (
        F.when((score <= -1.0) | (score > 1.0), F.lit(None).cast("string"))
        .when(score <= -0.1, "negative")
        .when(score <= 0.1, "neutral")
        .when(score <= 1.0, "positive")
    )
