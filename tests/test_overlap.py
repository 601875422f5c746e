"""Pairs give a loop's result whatever the size of a block."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import overlap as O

COLUMNS = (
    "video_id string, frame_idx bigint, pos bigint, track_id string, action string,"
    " x1 double, y1 double, x2 double, y2 double, img_w int, img_h int"
)


def make(seed, frames=6, most=14):
    rng = random.Random(seed)
    rows = []
    for f in range(frames):
        for pos in range(1, rng.randint(1, most) + 1):
            x, y = rng.uniform(-100, 300), rng.uniform(-80, 200)
            w, h = rng.choice([0, 3, 40, 130]), rng.choice([0, 5, 60, 150])
            rows.append(("v", f, pos, str(rng.randint(0, 3)), rng.choice(["a", "b", ""]), x, y, x + w, y + h, 300, 200))
    return rows


def iou(a, b):
    w = min(a[7], b[7]) - max(a[5], b[5])
    h = min(a[8], b[8]) - max(a[6], b[6])
    if w <= 0 or h <= 0:
        return 0.0
    area = lambda r: (r[7] - r[5]) * (r[8] - r[6])
    return w * h / (area(a) + area(b) - w * h)


def valid(rows):
    return [r for r in rows if r[7] > r[5] and r[8] > r[6]]


def loop_pairs(rows):
    ok = valid(rows)
    return {
        (a[1], a[2], b[2]): iou(a, b)
        for a in ok
        for b in ok
        if a[1] == b[1] and a[2] < b[2] and iou(a, b) > 0
    }


@pytest.mark.parametrize("block", [4096, 100, 3, 1])
def test_frame_pairs(spark, block):
    rows = make(4)
    pairs = O.frame_pairs(spark.createDataFrame(rows, COLUMNS), block=block)
    got = {(r["frame_idx"], r["a_pos"], r["b_pos"]): r["iou"] for r in pairs.collect()}
    assert pairs.count() == len(got)
    want = loop_pairs(rows)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) and 0 < got[k] <= 1 for k in got)


@pytest.mark.parametrize("block", [4096, 2])
def test_cross_pairs(spark, block):
    a, b = make(5), make(6)
    left, right = (O.valid_boxes(spark.createDataFrame(r, COLUMNS)) for r in (a, b))
    pairs = O.cross_pairs(left, right, O.FRAME, block=block)
    got = {(r["frame_idx"], r["a_pos"], r["b_pos"]): r["iou"] for r in pairs.collect()}
    want = {
        (x[1], x[2], y[2]): iou(x, y) for x in valid(a) for y in valid(b) if x[1] == y[1] and iou(x, y) > 0
    }
    assert pairs.count() == len(got) and got.keys() == want.keys()


def test_counts_without_pairs_of_disjoint_boxes(spark):
    rows = make(9)
    boxes = spark.createDataFrame(rows, COLUMNS)
    want = loop_pairs(rows)
    per_frame = {}
    for r in valid(rows):
        per_frame[r[1]] = per_frame.get(r[1], 0) + 1
    total = sum(n * (n - 1) // 2 for n in per_frame.values())
    t = O.totals(boxes).first()
    assert (t["total_pairs"], t["frames_with_overlaps"]) == (total, len({k[0] for k in want}))
    hist = {r["bin"]: r["pairs"] for r in O.iou_histogram(boxes).collect()}
    assert sum(hist.values()) == total
    assert hist[0] == total - sum(1 for v in want.values() if v >= 0.1)
    degree = O.degree_histogram(boxes).where(F.col("threshold") == 0.1).collect()
    deg = {}
    for (f, a, b), v in want.items():
        if v >= 0.1:
            for p in (a, b):
                deg[f, p] = deg.get((f, p), 0) + 1
    counts = {}
    for r in valid(rows):
        if per_frame[r[1]] >= 2:
            d = deg.get((r[1], r[2]), 0)
            counts[d] = counts.get(d, 0) + 1
    assert {r["degree"]: r["boxes"] for r in degree} == counts
    assert all(r["degree_ref"] == (r["degree"] - 1 if r["degree"] else None) for r in degree)


def test_sudden_changes(spark):
    rows = make(12)
    ok = valid(rows)
    ids = {}
    for r in ok:
        ids.setdefault(r[1], set()).add(r[3])
    want = {
        (a[1], a[2], b[2])
        for a in ok
        for b in ok
        if b[1] == a[1] + 1 and a[3] not in ids[b[1]] and b[3] not in ids[a[1]]
    }
    got = O.sudden_changes(spark.createDataFrame(rows, COLUMNS)).collect()
    assert {(r["frame_idx"], r["a_pos"], r["b_pos"]) for r in got} == want and len(got) == len(want)


def test_one_crowded_frame(spark):
    """A frame of more than one block."""
    rng = np.random.default_rng(2)
    n = O.BLOCK + 500
    x, y = rng.uniform(0, 1800, n), rng.uniform(0, 1000, n)
    corners = zip(x.tolist(), y.tolist())
    rows = [("v", 0, i, "1", "a", a, b, a + 9, b + 7, 1920, 1080) for i, (a, b) in enumerate(corners, 1)]
    boxes = spark.createDataFrame(rows, COLUMNS)
    want = 0
    for i in range(n - 1):
        want += int(((np.abs(x[i + 1 :] - x[i]) < 9) & (np.abs(y[i + 1 :] - y[i]) < 7)).sum())
    pairs = O.frame_pairs(boxes, (), block=64)
    assert pairs.count() == want == pairs.select("a_pos", "b_pos").distinct().count()


def test_chunks_are_numbered_alike(spark, monkeypatch):
    from trackloom.plans import fixtures

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    plain = sorted(map(tuple, fixtures.Views(spark, folder).boxes().collect()))
    monkeypatch.setattr(fixtures, "CHUNK_LINES", 2)
    assert sorted(map(tuple, fixtures.Views(spark, folder).boxes().collect())) == plain


def test_no_job_runs_while_queries_are_built(spark):
    from trackloom.plans import registry

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    names = "pair_iou overlap_by_action iou_summary xds_summary tubes_annotated tubes_auto bbox_quantiles frame_records".split()
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    spark.read.parquet(*[f"{folder}/{t}.parquet" for t in ("lineitem",)])
    built = registry.queries()
    schema_jobs = len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before)
    for name in names:
        start = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        built[name](spark, folder)
        fresh = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - start
        tasks = [
            spark.sparkContext.statusTracker().getStageInfo(s).numTasks
            for j in fresh
            for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds
        ]
        assert all(n <= 1 for n in tasks), name  # reading a footer is one task
    assert schema_jobs <= 1
