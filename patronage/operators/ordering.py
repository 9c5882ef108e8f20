"""Ranks, running totals and exact quantiles over a whole table without a one-task sort.

An unpartitioned window puts every row into one task. Here the rows are range
partitioned and sorted in parallel instead; only one row per partition and group is
needed to link the partitions, and that small table is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.session import materialize, materialize_bucketed

# monotonically_increasing_id() keeps the partition above bit 33 and the row number below it
POSITION_BITS = 33
#: the sketch of a quantile is wrong by 1 / ACCURACY of the rows at most; with this distance on both sides
#: it encloses the wanted places in groups of more than SMALL rows
ACCURACY, GAP, SMALL = 5000, 4e-4, 20_000


def _placed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in global order, each with its partition `_part` and its place `_pos` there.

    The result is materialised: the bounds of a range partitioning come from a sample,
    and every later consumer has to see the same partitions.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return (
        materialize(ordered.withColumn("_slot", F.monotonically_increasing_id()))
        .withColumn("_part", F.shiftright("_slot", POSITION_BITS))
        .withColumn("_pos", F.col("_slot").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)))
        .drop("_slot")
    )


def _chunk_windows(within: Sequence[str]):
    """Windows over the table of chunks (one row per partition and group, so it is small)."""
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return before, Window.partitionBy(*within)


def global_rank(df: DataFrame, order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """First-come rank: adds `rank` (from 1) and `total` (rows in the group).

    `order` must be unique inside a group, which keeps equal leading values from piling
    up in one partition. `within` names columns with few values.
    """
    within = list(within)
    placed = _placed(df, [*within, *order])
    chunks = placed.groupBy("_part", *within).agg(F.count("*").alias("_chunk_rows"), F.min("_pos").alias("_first"))
    before, group = _chunk_windows(within)
    links = chunks.select(
        "_part",
        *within,
        (F.coalesce(F.sum("_chunk_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_chunk_rows").over(group).alias("total"),
    )
    return (
        placed.join(F.broadcast(links), ["_part", *within])
        .withColumn("rank", F.col("_shift") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_shift")
    )


def running_totals(
    df: DataFrame, order: Sequence[str], sums: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """For every column in `sums`, the total of the rows before (`<name>_before`) and of
    the whole group (`<name>_total`); also the row number `position` from 1.

    `order` must be unique inside a group: aggregate to distinct values first.
    """
    within = list(within)
    keys = [*within, *order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored in buckets by partition: the sums and the window inside the partitions shuffle nothing
    ordered = df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id())
    placed = materialize_bucketed(ordered, "_part", parts, ["_part", *keys])
    chunks = placed.groupBy("_part", *within).agg(
        F.count("*").alias("_chunk_rows"), *(F.sum(name).alias(f"_{name}") for name in sums)
    )
    before, group = _chunk_windows(within)
    links = chunks.select(
        "_part",
        *within,
        F.coalesce(F.sum("_chunk_rows").over(before), F.lit(0)).alias("_offset"),
        *(F.coalesce(F.sum(f"_{name}").over(before), F.lit(0)).alias(f"_{name}_offset") for name in sums),
        *(F.sum(f"_{name}").over(group).alias(f"{name}_total") for name in sums),
    )
    inside = (
        Window.partitionBy("_part", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    numbered = placed.withColumns(
        {"_row": F.count("*").over(inside), **{f"_{name}_upto": F.sum(name).over(inside) for name in sums}}
    )
    return numbered.join(F.broadcast(links), ["_part", *within]).select(
        *df.columns,
        (F.col("_offset") + F.col("_row")).alias("position"),
        *(
            (F.col(f"_{name}_offset") + F.col(f"_{name}_upto") - F.col(name)).alias(f"{name}_before")
            for name in sums
        ),
        *(F.col(f"{name}_total") for name in sums),
    )


def unpivot(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form: key, feature name, non-null value."""
    return (
        df.select(*key, *(F.col(c).cast("double").alias(c) for c in columns))
        .unpivot(list(key), list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
    )


def rank_features(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """All columns ranked in one pass; rows (by, key, feature, value, rank, total)."""
    return global_rank(unpivot(df, [*by, *key], columns), ["value", *key], within=[*by, "feature"])


def quantile_table(ranked: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles q0, q1, … per feature from `rank_features`."""
    place = F.col("rank") - 1
    spot = {i: (F.col("total") - 1) * F.lit(float(p)) for i, p in enumerate(probs)}
    wanted = F.lit(False)
    for h in spot.values():
        wanted = wanted | place.between(F.floor(h), F.floor(h) + 1)
    picks = ranked.where(wanted).groupBy(*by, "feature").agg(
        F.max("total").alias("total"),
        *(F.max(F.when(place == F.floor(h), F.col("value"))).alias(f"_lo{i}") for i, h in spot.items()),
        *(F.max(F.when(place == F.floor(h) + 1, F.col("value"))).alias(f"_hi{i}") for i, h in spot.items()),
    )

    return picks.select(*by, "feature", "total", *(_interpolated(i, h).alias(f"q{i}") for i, h in spot.items()))


def value_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Like `quantile_table`, exact, without sorting the table: (by, feature, total, q0, q1, ...).

    A sketch, combined on the map side, gives two values that enclose each wanted place for certain.
    Rows below them are counted; only the values between them, a share of about `4 * GAP` of the rows
    (all of them in groups of up to `SMALL`), are counted one by one and put in order. `by` names columns
    with few values. `df` is read three times: materialise it when it is expensive.
    """
    keys = [*by, "feature"]
    long = unpivot(df, by, columns)
    around = [x for p in probs for x in (max(0.0, float(p) - GAP), min(1.0, float(p) + GAP))]
    sketch = long.groupBy(*keys).agg(
        F.count("*").alias("total"), F.percentile_approx("value", around, ACCURACY).alias("_around")
    )
    brackets = F.array(
        *(
            F.struct(
                F.lit(i).alias("i"),
                F.when(F.col("total") > SMALL, F.col("_around")[2 * i]).alias("low"),
                F.when(F.col("total") > SMALL, F.col("_around")[2 * i + 1]).alias("high"),
            )
            for i in range(len(probs))
        )
    )
    sketch = sketch.select(*keys, "total", brackets.alias("_brackets"))
    # one row per group and feature
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    met = long.alias("l").join(F.broadcast(sketch.alias("s")), reduce(lambda x, y: x & y, same))
    met = met.select(*(F.col(f"l.{k}").alias(k) for k in keys), "value", "total", "_brackets")
    low = [F.col("_brackets")[i]["low"] for i in range(len(probs))]
    below = met.groupBy(*keys).agg(
        F.max("total").alias("total"), *(F.count_if(F.col("value") < x).alias(f"_below{i}") for i, x in enumerate(low))
    )
    inside = F.filter(
        "_brackets",
        lambda b: b["low"].isNull() | ((F.col("value") >= b["low"]) & (F.col("value") <= b["high"])),
    )
    near = (
        met.select(*keys, "value", F.explode(F.transform(inside, lambda b: b["i"])).alias("i"))
        .groupBy(*keys, "i", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(Window.partitionBy(*keys, "i").orderBy("value")))
    )
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    placed = near.alias("n").join(F.broadcast(below.alias("b")), reduce(lambda x, y: x & y, same))
    placed = placed.select(*(F.col(f"n.{k}").alias(k) for k in keys), "i", "value", "n", "upto", "total", *(f"_below{i}" for i in range(len(probs))))
    spot = {i: (F.col("total") - 1) * F.lit(float(p)) for i, p in enumerate(probs)}

    def at(i: int, place: Column) -> Column:
        first = F.col(f"_below{i}") + F.col("upto") - F.col("n")
        return F.max(F.when((F.col("i") == i) & (first <= place) & (place < first + F.col("n")), F.col("value")))

    picks = placed.groupBy(*keys).agg(
        F.max("total").alias("total"),
        *(at(i, F.floor(h)).alias(f"_lo{i}") for i, h in spot.items()),
        *(at(i, F.floor(h) + 1).alias(f"_hi{i}") for i, h in spot.items()),
    )
    return picks.select(*keys, "total", *(_interpolated(i, h).alias(f"q{i}") for i, h in spot.items()))


def _interpolated(i: int, spot: Column) -> Column:
    """Between the two neighbours of the wanted place, from the nearer end."""
    low = F.col(f"_lo{i}")
    high = F.coalesce(F.col(f"_hi{i}"), low)
    part = spot - F.floor(spot)
    return F.when(part < 0.5, low + (high - low) * part).otherwise(high - (high - low) * (1 - part))


def pick_places(ranked: DataFrame, keys: Sequence[str], places: Sequence[Column]) -> dict[str, dict[int, tuple]]:
    """The rows at the given places (from 0), per feature: place -> (value, key …).

    A place is an expression over `total`. The result has as many rows as places are asked
    for, so it is small enough for the driver; its total is kept under place -1.
    """
    place = F.col("rank") - 1
    wanted = reduce(lambda a, b: a | b, (place == p for p in places))
    found: dict[str, dict[int, tuple]] = {}
    for row in ranked.where(wanted).select("feature", "value", *keys, "rank", "total").collect():
        spots = found.setdefault(row["feature"], {-1: (row["total"],)})
        spots[row["rank"] - 1] = (row["value"], *(row[k] for k in keys))
    return found


def quantile_places(probs: Sequence[float]) -> list[Column]:
    spots = [(F.col("total") - 1) * F.lit(float(p)) for p in probs]
    return [x for h in spots for x in (F.floor(h), F.floor(h) + 1)]


def quintile_places() -> list[Column]:
    return [F.floor((F.col("total") - 1) * s / 5) for s in range(1, 5)]


def quantiles_from(spots: dict[int, tuple], probs: Sequence[float]) -> list[float]:
    """Linear interpolation between the picked neighbours, from the nearer end."""
    total = spots[-1][0]
    result = []
    for p in probs:
        h = (total - 1) * float(p)
        low = spots[math.floor(h)][0]
        high = spots.get(math.floor(h) + 1, (low,))[0]
        part = h - math.floor(h)
        result.append(low + (high - low) * part if part < 0.5 else high - (high - low) * (1 - part))
    return result


def quintile_bounds(spots: dict[int, tuple]) -> list[tuple]:
    """Last (value, key) of the first four fifths of a ranked feature."""
    total = spots[-1][0]
    return [spots[(total - 1) * s // 5] for s in range(1, 5)]


# ---- selection by narrowing ----------------------------------------------------------------

#: rows in a bracket that the driver may put in order, and rows sampled from a bracket to narrow it
FEW, SAMPLED = 16_384, 1000


@dataclass
class _Bracket:
    """Neighbouring places of an order whose rows lie between two rows, both left out (None is open), or equal one."""

    order: tuple[str, ...]
    places: list[int]
    below: int
    size: int
    low: tuple | None = None
    high: tuple | None = None
    same: tuple | None = None

    def inside(self) -> Column:
        found = F.col(self.order[0]).isNotNull()
        if self.low is not None:
            found = found & _follows(self.order, self.low)
        return found if self.high is None else found & _precedes(self.order, self.high)

    def part(self, low: tuple | None, high: tuple | None, below: int, size: int, same: tuple | None = None) -> list[_Bracket]:
        """What lies in a part of the bracket, if a place does."""
        places = [p for p in self.places if below <= p < below + size]
        return [_Bracket(self.order, places, below, size, low, high, same)] if places else []


def _precedes(order: Sequence[str], row: tuple) -> Column:
    """Whether a row stands before the given one; the columns but the first are never null."""
    found = F.lit(False)
    for name, value in reversed(list(zip(order, row))):
        found = (F.col(name) < F.lit(value)) | ((F.col(name) == F.lit(value)) & found)
    return found


def _follows(order: Sequence[str], row: tuple) -> Column:
    found = F.lit(False)
    for name, value in reversed(list(zip(order, row))):
        found = (F.col(name) > F.lit(value)) | ((F.col(name) == F.lit(value)) & found)
    return found


def _sorting(row: tuple) -> tuple:
    """Spark's order for Python's sort: nan is the largest number."""
    return tuple((1, 0.0) if isinstance(v, float) and math.isnan(v) else (0, v) for v in row)


def _narrow(df: DataFrame, brackets: list[_Bracket], seed: int) -> list[_Bracket]:
    """Smaller brackets of the same places: one sample of bounded size, then one count of all rows."""
    names = sorted({name for b in brackets for name in b.order})
    picked = F.array(
        *(F.when(b.inside() & (F.rand(seed + i) < min(1.0, SAMPLED / b.size)), F.lit(i)) for i, b in enumerate(brackets))
    )
    sample = df.select(*names, F.explode(F.filter(picked, lambda i: i.isNotNull())).alias("_i")).collect()
    cuts: list[tuple[tuple, tuple] | None] = []
    for i, b in enumerate(brackets):
        rows = sorted((tuple(r[n] for n in b.order) for r in sample if r["_i"] == i), key=_sorting)
        reach = 2 * math.sqrt(len(rows)) + 2
        at = [(p - b.below) / b.size * len(rows) for p in b.places]
        ends = max(0, math.floor(min(at) - reach)), min(len(rows) - 1, math.ceil(max(at) + reach))
        cuts.append((rows[ends[0]], rows[ends[1]]) if rows else None)
    counted = [
        F.count_if(b.inside() & side(b.order, row)).alias(f"{name}{i}")
        for i, (b, cut) in enumerate(zip(brackets, cuts))
        if cut
        for name, side, row in (("a", _precedes, cut[0]), ("b", _follows, cut[0]), ("c", _precedes, cut[1]), ("d", _follows, cut[1]))
    ]
    counts = df.agg(*counted).first().asDict() if counted else {}
    out: list[_Bracket] = []
    for i, (b, cut) in enumerate(zip(brackets, cuts)):
        if not cut:  # a sample without rows: draw again
            out.append(b)
            continue
        low, high = cut
        before, after_low, before_high, after = (counts[f"{name}{i}"] for name in "abcd")
        out += b.part(b.low, low, b.below, before)
        out += b.part(None, None, b.below + before, b.size - before - after_low, low)
        out += b.part(low, high, b.below + b.size - after_low, max(0, before_high - (b.size - after_low)))
        if high != low:
            out += b.part(None, None, b.below + before_high, b.size - before_high - after, high)
        out += b.part(high, b.high, b.below + b.size - after, after)
    return out


def rows_at_places(
    df: DataFrame, wanted: dict[str, tuple[Sequence[str], Callable[[int], list[list[int]]]]]
) -> dict[str, dict[int, tuple]]:
    """The rows at given places (from 0) of several orders of a table, without sorting it.

    `wanted` names an order (columns; rows with a null in the first are left out) and lists, for a number of rows,
    groups of neighbouring places. A group's rows are enclosed by two rows of a sample and the rows before them
    counted; the bracket is narrowed again until it holds at most `FEW` rows, or equal ones only. Only then are its
    rows put in order, so no step grows with the table but the passes over it. All groups share the passes:
    materialise an expensive `df`. The total is kept under place -1; an order without rows is left out.
    """
    totals = df.agg(*(F.count(order[0]).alias(name) for name, (order, _) in wanted.items())).first()
    brackets = {
        name: [_Bracket(tuple(order), sorted(group), 0, totals[name]) for group in places(totals[name])]
        for name, (order, places) in wanted.items()
        if totals[name]
    }
    every = [(name, b) for name, group in brackets.items() for b in group]
    done: list[tuple[str, _Bracket]] = []
    seed = 0
    while every:
        done += [(name, b) for name, b in every if b.same is not None or b.size <= FEW]
        open_ = [(name, b) for name, b in every if b.same is None and b.size > FEW]
        every = []
        if open_:
            seed += len(open_)
            # places of one order that share a bracket share its counts
            shared: dict[tuple, _Bracket] = {}
            for _, b in open_:
                key = (b.order, b.low, b.high, tuple(b.places))
                shared.setdefault(key, b)
            narrowed = _narrow(df, list(shared.values()), seed)
            for name, b in open_:
                every += [(name, n) for n in narrowed if n.order == b.order and set(n.places) <= set(b.places)]
            every = list({(name, tuple(b.places)): (name, b) for name, b in every}.values())
    # equal brackets (all of a small table) are read once
    distinct = {(b.order, b.low, b.high): b for _, b in done if b.same is None}
    found: dict[tuple, list[tuple]] = {key: [] for key in distinct}
    if distinct:
        names = sorted({name for b in distinct.values() for name in b.order})
        inside = F.array(*(F.when(b.inside(), F.lit(i)) for i, b in enumerate(distinct.values())))
        keys = list(distinct)
        for r in df.select(*names, F.explode(F.filter(inside, lambda i: i.isNotNull())).alias("_i")).collect():
            found[keys[r["_i"]]].append(tuple(r[n] for n in keys[r["_i"]][0]))
    for rows in found.values():
        rows.sort(key=_sorting)
    result: dict[str, dict[int, tuple]] = {name: {-1: (totals[name],)} for name in brackets}
    for name, b in done:
        for place in b.places:
            result[name][place] = b.same or found[b.order, b.low, b.high][place - b.below]
    return result


def quantile_groups(probs: Sequence[float]) -> Callable[[int], list[list[int]]]:
    """For each share the two places that its quantile lies between."""

    def places(total: int) -> list[list[int]]:
        spots = [math.floor((total - 1) * float(p)) for p in probs]
        return [[spot, min(spot + 1, total - 1)] for spot in spots]

    return places


def quintile_groups(total: int) -> list[list[int]]:
    """The last places of the first four fifths."""
    return [[(total - 1) * s // 5] for s in range(1, 5)]


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Quantiles of several columns as plain numbers: one short list per column that has values."""
    numbers = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    found = rows_at_places(numbers, {c: ([c], quantile_groups(probs)) for c in columns})
    return {c: quantiles_from(spots, probs) for c, spots in found.items()}


def quintile_of_rank(value: Column, key: Column, bounds: list[tuple]) -> Column:
    """Score 1..5 by rank, ties in key order; compares with the bounds, so no window is needed."""
    score = F.lit(1)
    for bound_value, bound_key in bounds:
        above = (value > F.lit(bound_value)) | ((value == F.lit(bound_value)) & (key > F.lit(bound_key)))
        score = score + above.cast("int")
    return score


def thresholds_between(start: float, stop: float, count: int) -> list[float]:
    """Evenly spaced thresholds, both ends included."""
    step = (stop - start) / (count - 1)
    return [start + i * step for i in range(count - 1)] + [stop]


def next_after(edges: Sequence[float]) -> list[float]:
    return [math.nextafter(edge, math.inf) for edge in edges]
