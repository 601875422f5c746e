"""Exact quantiles against numpy, also where one cell of the grid has all values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import quantiles as Q

AWKWARD = [0.0, -0.0, 5e-324, -5e-324, 1e-300, -1e-300, 1.0, -1.0, 1e300, -1e300, 3.5, 3.5000000000000004, 2.0**52, -(2.0**52)]


def test_ordered_bits_keep_the_order(spark):
    draw = random.Random(1)
    values = AWKWARD + [draw.uniform(-9, 9) * 10 ** draw.randint(-30, 30) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", Q.ordered_bits(F.col("v")).alias("b"))
    got = sorted((r["b"], r["v"]) for r in df.collect())
    assert [v for _, v in got] == sorted(values)
    assert len({b for b, _ in got}) == len({(v, math.copysign(1, v)) for v in values})


def groups():
    draw = random.Random(4)
    return {
        "one cell": [draw.uniform(7e8, 9e8) for _ in range(3000)],
        "next to each other": [1.0 + k * 2.0**-52 for k in range(1500)],
        "one value": [4.25] * 500,
        "awkward": AWKWARD,
        "mixed": [draw.choice([-1, 1]) * 10 ** draw.uniform(-12, 12) for _ in range(2000)],
        "single": [-3.0],
        "ties": [float(draw.randint(0, 3)) for _ in range(700)],
    }


@pytest.mark.parametrize("rescan, bounded", [(True, 0), (False, 0), (True, 600), (False, 10**6)])
def test_five_numbers(spark, rescan, bounded):
    made = groups()
    rows = [(g, v) for g, values in made.items() for v in values] + [("single", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    out = Q.five_numbers(df, ["g"], {"x": F.col("v")}, digits=None, rescan=rescan, large_cells=True, bounded=bounded)
    got = {r["g"]: r for r in out.collect()}
    assert got.keys() == made.keys()
    for name, values in made.items():
        low, high = np.percentile(values, [25, 75])
        row = got[name]
        assert row["count"] == len(values) and row["min"] == min(values) and row["max"] == max(values)
        assert row["p25"] == pytest.approx(low, rel=1e-12, abs=0) and row["p75"] == pytest.approx(high, rel=1e-12, abs=0)


def test_no_window_orders_the_values_of_a_large_cell(spark):
    """Running counts go over digits: the windows of the radix steps order cells and digits only."""
    df = spark.createDataFrame([(float(k),) for k in range(50)], "v double")
    plan = Q.five_numbers(df, [], {"x": F.col("v")}, large_cells=True, bounded=-1)._jdf.queryExecution().optimizedPlan().toString()
    orders = [line for line in plan.splitlines() if "windowspecdefinition" in line and "ASC" in line]
    assert orders and all("_cell#" in line or "_digit#" in line for line in orders)
