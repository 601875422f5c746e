"""Windows, fills and masks against a frame-by-frame loop."""

import random

import pytest
from pyspark.sql import functions as F

from trackloom.operators import tubes as T
from trackloom.operators import windows as W
from trackloom.session import cut_lineage

BOX_COLUMNS = (
    "video_id string, frame_idx bigint, pos bigint, track_id string, action string,"
    " x1 double, y1 double, x2 double, y2 double, img_w int, img_h int"
)


def nearest(target, options):
    return min(options, key=lambda o: (abs(o - target), o))


def loop_windows(frames, images, win, step, pad, annotated):
    """(win_no, offset) -> (frame, img_src, box_src, anno, img, edge) of one segment."""
    low, high = min(frames), max(frames)
    if high - low + 1 >= win:
        last = high - win + 1
        starts = list(range(low, last + 1, step))
        if starts[-1] != last:
            starts.append(last)
    else:
        start = round(sum(frames) / len(frames)) - win // 2
        if not pad:
            start = max(min(images), min(start, max(images) - win + 1))
        starts = [start]
    inside_images = [i for i in images if low <= i <= high]
    out = {}
    for n, start in enumerate(starts):
        for o in range(win):
            f = start + o
            edge = img_missing = False
            outside = f < low or f > high
            if f in images:
                img = f
            elif pad and outside:
                img, edge = (low if f < low else high), True
            else:
                img, img_missing = nearest(f, inside_images), True
            out[n, o] = (f, img, nearest(f, frames), f not in frames, img_missing, edge)
    return out


@pytest.mark.parametrize("stride", [1, 3])
@pytest.mark.parametrize("pad", [False, True])
def test_windows(spark, stride, pad):
    rng = random.Random(stride)
    rows, images = [], {}
    for v in ("v1", "v2"):
        images[v] = set(f for f in range(0, 90) if f % stride == 0 or rng.random() < 0.5)
        for track in "12":
            f = rng.randint(0, 4) * stride
            while f < 85:
                for _ in range(rng.randint(1, 9)):
                    if f in images[v] and f < 85:
                        rows.append((v, f, len([r for r in rows if r[:2] == (v, f)]) + 1, track, "go", float(f), 0.0, f + 5.0, 9.0, 640, 480))
                    f += stride
                f += rng.randint(2, 5) * stride
    boxes = spark.createDataFrame(rows, BOX_COLUMNS)
    frames = spark.createDataFrame(
        [(v, f, f"{f:06d}.jpg") for v in images for f in sorted(images[v])],
        "video_id string, frame_idx bigint, image_name string",
    )
    win, step = 7, 3
    tube_rows = cut_lineage(T.annotated_rows(boxes, frames))
    segments = T.annotated_segments(tube_rows)
    starts = W.window_starts(tube_rows, segments, frames, win, step, pad=pad)
    plan = W.window_frames(starts, frames, win, pad)
    got = {}
    for r in plan.collect():
        key = (r["video_id"], r["track_id"], r["run_no"])
        got.setdefault(key, {})[r["win_no"], r["offset"]] = (
            r["frame"], r["img_src"], r["box_src"], r["anno_missing"], r["img_missing"], r["edge_padded"],
        )
    members = {}
    for r in tube_rows.collect():
        assert r["stride"] == stride
        members.setdefault((r["video_id"], r["track_id"], r["run_no"]), []).append(r["frame_idx"])
    assert got.keys() == members.keys()
    for key, fs in members.items():
        assert got[key] == loop_windows(sorted(fs), images[key[0]], win, step, pad, fs), key
    masks = {r["window"]: r for r in W.window_masks(plan).collect()}
    for key, places in got.items():
        for n in {n for n, _o in places}:
            name = f"{key[0]}__tid{key[1]}__seg{key[2]:02d}__win{n:03d}"
            for column, i in (("anno_mask", 3), ("img_mask", 4), ("edge_pad", 5)):
                marks = ",".join(str(o + 1) for (w, o), p in sorted(places.items()) if w == n and p[i])
                assert (masks[name][column] if name in masks else "") == marks


def test_context_and_upsample(spark):
    names = [f"img_{i:04d}.jpg" for i in range(3, 30, 2)]
    frames = spark.createDataFrame(
        [("v", int(n[4:8]), n) for n in names], "video_id string, frame_idx bigint, image_name string"
    )
    centres = spark.createDataFrame([("a", "v", 5), ("a", "v", 4)], "action string, video_id string, frame_idx bigint")
    got = {(r["frame_idx"], r["offset"]): r["image_name"] for r in W.context_frames(centres, frames, 2).collect()}
    assert got == {(5, -1): names[0], (5, 0): names[1], (5, 1): names[2], (5, 2): names[3], (4, 0): names[0]}
    kept = W.context_frames(centres, frames, 2, "centre").where("frame_idx = 4").collect()
    assert [r["image_name"] for r in kept] == [None]
    up = {r["new_index"]: (r["src_name"], r["new_name"]) for r in W.upsample(frames, 5, 10).collect()}
    assert up == {2 * i + j + 1: (n, f"{2 * i + j + 1:06d}.jpg") for i, n in enumerate(names) for j in (0, 1)}
    with pytest.raises(ValueError):
        W.upsample(frames, 6, 20)


def test_crop_outside_is_empty(spark):
    rows = [("v", f, 1, "1", "go", x, 10.0, x + 20, 30.0, 100, 80) for f, x in enumerate([0.0, 85.0, 400.0])]
    boxes = spark.createDataFrame(rows, BOX_COLUMNS)
    frames = boxes.select("video_id", "frame_idx")
    got = {r["frame_idx"]: r for r in W.crop_plan(T.annotated_rows(boxes, frames)).collect()}
    assert (got[0]["new_w"], got[0]["new_h"], got[0]["x_off"]) == (224, 224, 0)
    assert (got[1]["crop_x2"], got[1]["new_w"], got[1]["x_off"]) == (100, 168, 28)
    assert (got[2]["new_w"], got[2]["y_off"]) == (0, 0)


def test_windows_are_dealt_whole(spark):
    """No row per window and frame is dealt: after the boxes are attached nothing is shuffled by frame."""
    boxes = spark.createDataFrame([("v1", f, 1, "1", "go", float(f), 0.0, f + 5.0, 9.0, 640, 480) for f in (0, 2, 70, 72, 74)], BOX_COLUMNS)
    frames = spark.createDataFrame([("v1", f, f"{f:06d}.jpg") for f in range(0, 80, 2)], "video_id string, frame_idx bigint, image_name string")
    rows = cut_lineage(T.annotated_rows(boxes, frames))
    starts = W.window_starts(rows, T.annotated_segments(rows), frames, 5, 2)
    listed = W.windows(starts, frames, 5)
    for out in (W.filled_boxes(listed, rows, 5), W.window_shapes(listed, rows, boxes, 5), W.masks_of(listed, 5)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "box_src" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
    shapes = {(r["window"][-3:], r["offset"]): (r["shape_pos"], r["x1"]) for r in W.window_shapes(listed, rows, boxes, 5).where("window LIKE '%seg01%'").collect()}
    assert shapes == {("000", o): p for o, p in enumerate([(1, 70.0), (1, 70.0), (1, 72.0), (1, 72.0), (1, 74.0)])}


@pytest.mark.parametrize("pad", [False, True])
def test_dense_windows_from_one_dealing(spark, pad):
    """The same shapes as by pieces, over ends of chunks, copies, boxes without an image or an action; only boxes are dealt."""
    from trackloom.operators.ordering import near_chunks

    rng, rows, images = random.Random(5), [], set()
    for v, first in (("v1", 990), ("v2", 0), ("v3", 1019)):
        for f in range(first, first + (1070 if v == "v1" else 12)):
            if rng.random() < (0.97 if v == "v1" else 0.8):
                images.add((v, f))
            gone = 0.05 if 1000 < f < 2045 else 0.4
            shapes = [(t, a) for t in "12" for a in ("go", "stop", "", "go") if rng.random() > gone and (a == "go" or rng.random() < 0.2)]
            rows += [(v, f, n + 1, t, a, float(f), float(n), f + 5.0, n + 9.0, 640, 480) for n, (t, a) in enumerate(shapes[: rng.choice((1, 1, 2, 5))])]
    boxes = spark.createDataFrame(rows, BOX_COLUMNS)
    frames = spark.createDataFrame([(v, f, f"{f:06d}.jpg") for v, f in sorted(images)], "video_id string, frame_idx bigint, image_name string")
    win, step = 6, 3
    tubes = cut_lineage(T.annotated_rows(boxes, frames))
    assert {r["stride"] for r in tubes.select("stride").distinct().collect()} == {1}
    starts = W.window_starts(tubes, T.annotated_segments(tubes), frames, win, step, pad=pad)
    want = W.window_shapes(W.windows(starts, frames, win), tubes, boxes, win, pad)
    dealt = boxes.select("*", F.explode(near_chunks("frame_idx", win)).alias("_chunk")).repartition("video_id", "_chunk")
    got = W.dense_window_shapes(dealt, boxes.drop("pos"), frames, win, step, pad)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange hashpartitioning" in line and ("run_no" in line or "win_no" in line) for line in plan.splitlines())
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
