"""Chunked ordered operators against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import ordering as O
from trackloom.operators.quantiles import five_numbers


def loop_runs(frames, stride, copies=None):
    """(index -> brk, head, tail, run_no) by walking the sorted frames."""
    out, prev, tail, run = {}, None, None, -1
    for f in sorted(frames):
        brk = prev is None or f - prev != stride
        run += brk
        head = f if brk else tail
        n = copies[f] if copies else 1
        tail = f if n > 1 else head
        out[f] = (brk, head, tail, run)
        run += n - 1
        prev = f
    return out


@pytest.mark.parametrize("chunk", [1, 3, 1000])
@pytest.mark.parametrize("with_copies", [False, True])
def test_label_runs(spark, chunk, with_copies):
    rng = random.Random(chunk)
    data, want = [], set()
    for key in ("a", "b", "c"):
        stride = rng.choice([1, 2])
        frames = rng.sample(range(0, 60), 35)
        copies = {f: rng.choice([1, 1, 2, 4]) for f in frames}
        data += [(key, f, stride, copies[f]) for f in frames]
        loop = loop_runs(frames, stride, copies if with_copies else None)
        want |= {(key, f, *v) for f, v in loop.items()}
    df = spark.createDataFrame(data, "k string, f bigint, stride bigint, n bigint")
    got = O.label_runs(
        df,
        ["k"],
        "f",
        lambda prev, cur: cur - prev != F.col("stride"),
        copies="n" if with_copies else None,
        constants=("stride",),
        chunk=chunk,
    )
    assert {tuple(r) for r in got.select("k", "f", "brk", "head", "tail", "run_no").collect()} == want


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_distinct_diffs(spark, chunk):
    rng = random.Random(5)
    frames = sorted(rng.sample(range(200), 60))
    df = spark.createDataFrame([("v", f) for f in frames + frames[:9]], "v string, f bigint")
    want = {}
    for a, b in zip(frames, frames[1:]):
        want[b - a] = want.get(b - a, 0) + 1
    got = {r["diff"]: r["n"] for r in O.distinct_diffs(df, ["v"], "f", chunk).collect()}
    assert got == want


def test_row_numbers(spark):
    rng = random.Random(1)
    data = [(rng.choice("ab"), i, rng.random()) for i in range(200)]
    df = spark.createDataFrame(data, "k string, i bigint, x double")
    got = O.row_numbers(df, ["k"], [F.col("x"), F.col("i")], F.floor(F.col("x") * 7), total="n")
    for k in "ab":
        mine = sorted((x, i) for kk, i, x in data if kk == k)
        want = {i: n for n, (_x, i) in enumerate(mine, 1)}
        part = {r["i"]: (r["rn"], r["n"]) for r in got.where(F.col("k") == k).collect()}
        assert part == {i: (n, len(mine)) for i, n in want.items()}


def test_first_per_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), ("a", 2)], "k string, x int")
    got = O.first_per_group(df, ["k"], [F.col("x")], 2)
    assert {(r["k"], r["x"], r["rn"]) for r in got.collect()} == {("a", 1, 1), ("a", 2, 2), ("b", 2, 1)}


@pytest.mark.parametrize("scale", [1.0, 100.0])
@pytest.mark.parametrize("discrete,rescan", [(False, True), (False, False), (True, True)])
def test_five_numbers(spark, scale, discrete, rescan):
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(0, 50, 301), "b": rng.random(7), "c": np.array([2.5]), "d": np.round(rng.normal(0, 2, 100))}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs]
    df = spark.createDataFrame([*rows, ("a", None)], "g string, x double")
    got = five_numbers(
        df, ["g"], {"x": F.col("x"), "y": F.col("x") * 2}, discrete=discrete, scale=scale, digits=9, rescan=rescan
    )
    seen = {(r["g"], r["metric"]): r for r in got.collect()}
    assert len(seen) == 8
    for g, xs in groups.items():
        for metric, values in (("x", xs), ("y", xs * 2)):
            r = seen[g, metric]
            assert r["count"] == len(values)
            want = [values.min(), np.percentile(values, 25), values.mean(), np.percentile(values, 75), values.max()]
            assert np.allclose([r[c] for c in ("min", "p25", "mean", "p75", "max")], want, atol=1e-8)


def test_five_numbers_weighted(spark):
    df = spark.createDataFrame([(0.0, 10), (0.5, 1), (0.9, 3)], "x double, w int")
    r = five_numbers(df, [], {"x": F.col("x")}, F.col("w")).first()
    values = np.array([0.0] * 10 + [0.5] + [0.9] * 3)
    assert r["count"] == 14 and r["p75"] == pytest.approx(np.percentile(values, 75))
    assert r["mean"] == pytest.approx(values.mean(), abs=1e-6)
