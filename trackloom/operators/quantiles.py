"""Exact quantiles without gathering a group's values in one place.

Pass one counts values per cell of a fixed monotone grid (at most a few thousand cells per
group, combined on the map side). The cells that hold the wanted ranks are known from the
running counts. Pass two reads only the values of those cells, as distinct values with counts.

A cell is put in order by one task. With ``large_cells`` only one of up to ``BOUNDED`` rows is; in others, radix selection on the order-preserving bits of a
double finds the ranks: each step counts the next digit of the values that share the digits so far, and goes
on with the digit that holds the rank. Running counts are taken over digits, of which there are at most
2**DIGIT_BITS, and never over values, so a cell with any number of values is no task's burden. Both are parts of one
plan; where no cell is that large, the second part reads nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 4096
#: Bits of a digit of the radix selection; 64 bits in all.
DIGIT_BITS = (22, 21, 21)
#: Rows of a cell that one task may put in order.
BOUNDED = 1_000_000
QUARTILES = {"p25": 0.25, "p75": 0.75}


def _cell(value: Column, scale: float) -> Column:
    """Grid cell of a value. Every step is monotone under rounding, so order is kept."""

    def grow(v: Column) -> Column:
        return F.floor((F.lit(1.0) - F.lit(scale) / (F.lit(scale) + v)) * CELLS).cast("bigint")

    return F.when(value >= 0, grow(value)).otherwise(-grow(-value) - 1)


def ordered_bits(value: Column) -> Column:
    """The 64 bits of a double as a number with the same order: negative values have all other bits flipped."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value).cast("bigint")
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit((1 << 63) - 1)))


def _picked(long: DataFrame, wanted: DataFrame, keys: list[str], pick: Callable) -> DataFrame:
    """(keys, prob, side, _v): the values at the wanted ranks, read from the wanted cells only."""
    cell = [*keys, "_cell"]
    inside = wanted.select(*cell, "prob", "side", (F.col("rank") - F.col("_lo")).alias("_k"))
    values = long.join(inside.select(*cell).distinct(), cell, "left_semi").groupBy(*cell, "_v").agg(F.sum("_w").alias("_n"))
    return pick(values, inside, keys)


def _sorted_pick(values: DataFrame, inside: DataFrame, keys: list[str]) -> DataFrame:
    """The ``_k``-th value (from 0) of a cell for every row of ``inside``, by the order of the cell's values."""
    return (
        _running(values, [*keys, "_cell"], "_v")
        .join(inside, [*keys, "_cell"])
        .where((F.col("_k") >= F.col("_lo")) & (F.col("_k") < F.col("_hi")))
        .select(*keys, "prob", "side", "_v")
    )


def _radix_pick(values: DataFrame, inside: DataFrame, keys: list[str], digits: tuple[int, ...] = DIGIT_BITS) -> DataFrame:
    """The same without an order of values. ``values`` has (keys, _cell, _v, _n), one row per distinct value.

    The digits so far are the bits above ``left``.
    """
    cell = [*keys, "_cell"]
    values = values.withColumn("_bits", ordered_bits(F.col("_v")))
    # Null tests of all steps, so that the plan below them is the same and its shuffle is reused.
    for bits in accumulate(reversed(digits), initial=0):
        values = values.where(F.shiftright("_bits", bits).isNotNull())
    wanted, known, left = inside, [], 64
    for step, width in enumerate(digits):
        left -= width
        prefix = F.shiftright("_bits", left)
        if known:
            # The digits so far are the key; there are as few of them as there are ranks.
            here = values.withColumn("_known", F.shiftright("_bits", left + width)).join(
                wanted.select(*cell, "_known").distinct(), [*cell, "_known"], "left_semi"
            )
        else:
            here = values
        group = [*cell, *known]
        counted = here.withColumn("_digit", prefix).groupBy(*group, "_digit").agg(F.sum("_n").alias("_n"), F.max("_v").alias("_v"))
        placed = (
            _running(counted, group, "_digit")
            .join(wanted, group)
            .where((F.col("_k") >= F.col("_lo")) & (F.col("_k") < F.col("_hi")))
        )
        rest = (F.col("_k") - F.col("_lo")).alias("_k")
        if step + 1 == len(digits):
            return placed.select(*keys, "prob", "side", "_v")
        wanted = placed.select(*cell, F.col("_digit").alias("_known"), "prob", "side", rest)
        known = ["_known"]
    raise ValueError("no digits")


def _pick_ranks(running: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """Rows of ``running`` (columns _lo, _hi, _total) that hold the rank below or above a quantile."""
    at = {name: F.lit(p) * (F.col("_total") - 1) for name, p in probs.items()}
    ranks = F.array(
        *[
            F.struct(F.lit(name).alias("prob"), F.lit(side).alias("side"), f(at[name]).alias("rank"))
            for name in probs
            for side, f in (("lo", F.floor), ("hi", F.ceil))
        ]
    )
    return (
        running.withColumn("_r", F.explode(ranks))
        .where((F.col("_r.rank") >= F.col("_lo")) & (F.col("_r.rank") < F.col("_hi")))
        .select("*", "_r.prob", "_r.side", "_r.rank")
        .drop("_r")
    )


def _running(hist: DataFrame, keys: list[str], value: str) -> DataFrame:
    group = Window.partitionBy(*keys)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        hist.withColumn("_hi", F.sum("_n").over(upto))
        .withColumn("_lo", F.col("_hi") - F.col("_n"))
        .withColumn("_total", F.sum("_n").over(group))
    )


def _interpolate(picked: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    aggs = []
    for name in probs:
        for side in ("lo", "hi"):
            hit = (F.col("prob") == name) & (F.col("side") == side)
            aggs.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{name}_{side}"))
    return picked.groupBy(*keys).agg(*aggs)


def five_numbers(
    df: DataFrame,
    groups: list[str],
    metrics: dict[str, Column],
    weight: Column | None = None,
    discrete: bool = False,
    scale: float = 1.0,
    digits: int | None = 6,
    probs: dict[str, float] | None = None,
    rescan: bool = True,
    large_cells: bool = False,
    bounded: int = BOUNDED,
) -> DataFrame:
    """count, min, p25, mean, p75, max of every metric per group (linear interpolation).

    ``groups`` must hold no nulls; null metric values are left out. ``discrete`` is for values
    with few distinct ones (frame counts): the histogram itself then holds every rank.
    ``scale`` is a typical size of the values. ``rescan=False`` is for inputs that are dear to
    compute: they are shuffled once as a histogram of values, which both passes then read.
    With ``large_cells``, cells of more than ``bounded`` rows are searched digit by digit instead of being put in order
    by one task each; that makes the plan longer, so it is for large inputs.
    Output has one row per (groups, metric).
    """
    probs = probs or QUARTILES
    keys = [*groups, "metric"]
    names = list(metrics)
    weight = F.lit(1) if weight is None else weight
    pairs = F.explode(
        F.array(
            *[F.struct(F.lit(m).alias("metric"), metrics[m].cast("double").alias("_v")) for m in names]
        )
    )
    long = (
        df.select(*groups, weight.cast("bigint").alias("_w"), pairs.alias("_p"))
        .select(*groups, "_w", "_p.metric", "_p._v")
        .where(F.col("_v").isNotNull() & (F.col("_w") > 0))
    )
    if not rescan:
        long = long.groupBy(*keys, "_v").agg(F.sum("_w").alias("_w"))
    # The null tests keep the plan under both passes the same, so its shuffle is reused.
    long = long.withColumn("_cell", F.col("_v") if discrete else _cell(F.col("_v"), scale))
    for name in [*keys, "_cell"]:
        long = long.where(F.col(name).isNotNull())
    cells = long.groupBy(*keys, "_cell").agg(
        F.sum("_w").alias("_n"),
        F.sum(F.col("_v") * F.col("_w")).alias("_s"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    totals = cells.groupBy(*keys).agg(
        F.sum("_n").cast("bigint").alias("count"),
        F.min("_min").alias("min"),
        (F.sum("_s") / F.sum("_n")).alias("mean"),
        F.max("_max").alias("max"),
    )
    wanted = _pick_ranks(_running(cells, keys, "_cell"), keys, probs)
    if discrete:
        picked = wanted.withColumn("_v", F.col("_cell"))
    else:
        if large_cells:
            small, large = wanted.where(F.col("_n") <= bounded), wanted.where(F.col("_n") > bounded)
            picked = _picked(long, small, keys, _sorted_pick).unionByName(_picked(long, large, keys, _radix_pick))
        else:
            picked = _picked(long, wanted, keys, _sorted_pick)
    out = totals.join(_interpolate(picked, keys, probs), keys)
    for name, p in probs.items():
        at = F.lit(p) * (F.col("count") - 1)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out = out.withColumn(name, low + (high - low) * (at - F.floor(at)))
    shown = ["min", *[n for n in probs if n == "p25"], "mean", *[n for n in probs if n != "p25"], "max"]
    numbers = [F.round(F.col(c), digits).alias(c) if digits is not None else F.col(c) for c in shown]
    return out.select(*keys, "count", *numbers)
