import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from patronage.functions.expressions import (
    count_above,
    fill_missing,
    flag,
    floor_days,
    plus_months,
    polarity_class,
    ratio,
    round_half_even,
    title_case,
)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ts(text):
    return F.lit(dt.datetime.fromisoformat(text))


def test_day_difference_rounds_down(spark):
    before, after = ts("2018-03-01 09:00:00"), ts("2018-03-01 10:00:00")
    midnight = ts("2018-03-02 00:30:00")
    assert one(spark, floor_days(before, after), floor_days(after, before), floor_days(midnight, after)) == (-1, 0, 0)


def test_month_shift_keeps_time_and_clamps(spark):
    shifted = one(spark, plus_months(ts("2018-08-31 10:00:00"), -6))[0]
    assert shifted == dt.datetime(2018, 2, 28, 10)


def test_rounding_equals_numpy(spark):
    values = [i / 200 + 0.005 for i in range(-2000, 2000)] + [2.675, 1.005, 0.125, 0.375, -0.125]
    df = spark.createDataFrame([(float(v),) for v in values], "x double").select("x", round_half_even(F.col("x"), 2).alias("r"))
    for x, r in df.collect():
        clean = round(x, 8)
        assert r == np.round(clean, 2), x


def test_flags_and_ratios_without_value(spark):
    nothing = F.lit(None).cast("double")
    assert one(spark, flag(nothing > 1), ratio(F.lit(1.0), F.lit(0.0)), ratio(nothing, F.lit(2.0))) == (0, 0.0, 0.0)


def test_fill_missing(spark):
    df = spark.createDataFrame([(1, None, None)], "k int, x double, s string")
    assert tuple(fill_missing(df, keep=("k",)).first()) == (1, 0.0, "0")


def test_count_above_is_strict(spark):
    assert one(spark, count_above(F.lit(2.0), [1.0, 2.0, 3.0])) == (1,)


def test_polarity_class_edges(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, -0.5, -0.1, 0.0, 0.1, 0.11, 1.0)], "p double")
    found = [r[0] for r in df.select(polarity_class(F.col("p"))).collect()]
    assert found == [None, "negative", "negative", "neutral", "neutral", "positive", "positive"]


def test_title_case(spark):
    assert one(spark, title_case(F.lit("delivery_days_diff_mean"))) == ("Delivery Days Diff Mean",)
