"""Tube segmentation variants against a plain loop over sorted boxes."""

import random
from collections import Counter

import pytest

from trackloom.operators import tubes as T
from trackloom.operators.ordering import frame_chunk


def make_boxes(seed, stride=1, copies=True):
    rng = random.Random(seed)
    rows = []
    for video in ("v1", "sportshhi_v2"):
        for frame in range(0, 60, stride):
            if rng.random() < 0.25:
                continue
            pos = 0
            for track in ("1", "2", ""):
                for _ in range(rng.choice([0, 1, 1, 3] if copies else [0, 1])):
                    pos += 1
                    action = rng.choice(["run", "hit", ""])
                    x, y = rng.randint(0, 50), rng.randint(0, 50)
                    rows.append((video, frame, pos, track, action, float(x), float(y), x + 5.0, y + 7.0, 100, 90))
    return rows


COLUMNS = (
    "video_id string, frame_idx bigint, pos bigint, track_id string, action string,"
    " x1 double, y1 double, x2 double, y2 double, img_w int, img_h int"
)


def mode(frames, default):
    frames = sorted(set(frames))
    diffs = Counter(b - a for a, b in zip(frames, frames[1:]))
    return min(diffs, key=lambda d: (-diffs[d], d)) if diffs else default


def loop_segments(rows, stride, dedup=False, gt=False):
    """Counter of (video, track, action, start, end, length)."""
    keys = {}
    for r in rows:
        if r[3] and r[4]:
            keys.setdefault((r[0], r[3], r[4]), []).append(r[1])
    out = Counter()
    for key, frames in keys.items():
        frames = sorted(set(frames)) if dedup else sorted(frames)
        step = stride(key, frames)
        runs = [[frames[0]]]
        for f in frames[1:]:
            d = f - runs[-1][-1]
            if (d > step) if gt else (d != step):
                runs.append([f])
            else:
                runs[-1].append(f)
        out.update((*key, r[0], r[-1], len(r)) for r in runs)
    return out


def collected(df):
    out = Counter()
    for r in df.collect():
        out[r["video_id"], r["track_id"], r["action"], r["start_f"], r["end_f"], r["length"]] += r["n"]
    return out


@pytest.mark.parametrize("seed,stride", [(1, 1), (2, 2), (3, 5)])
def test_variants(spark, seed, stride):
    rows = make_boxes(seed, stride)
    boxes = spark.createDataFrame(rows, COLUMNS)
    all_frames = lambda v: [r[1] for r in rows if r[0] == v]
    rule = lambda v: 5 if "sportshhi" in v else 1
    cases = [
        (dict(stride="fixed"), dict(stride=lambda k, f: rule(k[0]))),
        (dict(stride="auto"), dict(stride=lambda k, f: mode(all_frames(k[0]), rule(k[0])))),
        (
            dict(stride="auto", dedup=True),
            dict(stride=lambda k, f: mode(all_frames(k[0]), rule(k[0])), dedup=True),
        ),
        (
            dict(stride="per_key", dedup=True, break_if="gt"),
            dict(stride=lambda k, f: mode(f, 1), dedup=True, gt=True),
        ),
        (dict(stride=2, dedup=True, break_if="gt"), dict(stride=lambda k, f: 2, dedup=True, gt=True)),
    ]
    for ours, loop in cases:
        assert collected(T.tube_segments(boxes, **ours)) == loop_segments(rows, **loop), ours


def test_lengths_add_up(spark):
    rows = make_boxes(7)
    boxes = spark.createDataFrame(rows, COLUMNS)
    got = T.tube_segments(boxes, "auto", dedup=True)
    assert sum(r["length"] * r["n"] for r in got.collect()) == len({r[:2] + r[3:5] for r in rows if r[3] and r[4]})


def test_annotated_rows(spark):
    rows = make_boxes(11, 2)
    rng = random.Random(0)
    images = {(r[0], r[1]) for r in rows if rng.random() < 0.9}
    boxes = spark.createDataFrame(rows, COLUMNS)
    frames = spark.createDataFrame(sorted(images), "video_id string, frame_idx bigint")
    usable = [r for r in rows if r[:2] in images and r[3] and r[4]]
    want = {}
    for key in {(r[0], r[3], r[4]) for r in usable}:
        step = mode([r[1] for r in usable if r[0] == key[0]], 1)
        run, prev = -1, None
        for r in sorted((r for r in usable if (r[0], r[3], r[4]) == key), key=lambda r: (r[1], r[2])):
            run += prev is None or r[1] - prev != step
            prev = r[1]
            want[r[0], r[1], r[2]] = run
    got = T.annotated_rows(boxes, frames)
    assert {(r["video_id"], r["frame_idx"], r["pos"]): r["run_no"] for r in got.collect()} == want


def test_bins(spark):
    segments = spark.createDataFrame([(1, 2), (25, 1), (26, 1), (90, 3)], "length int, n bigint")
    got = {r["bin"]: r["count"] for r in T.length_bins(segments).collect()}
    assert len(got) == 26 and got["1"] == 2 and got["25"] == 1 and got["25+"] == 4 and got["7"] == 0
    bins = T.time_bins(segments, 0.04).first()
    assert (bins["le_half"], bins["half_to_one"], bins["over_one"]) == (2, 1, 4) or tuple(bins)[-1] == 7
    assert bins["num_tubes"] == 7


def test_annotated_rows_shuffle_little(spark):
    """Boxes are dealt by chunk of frames and by chunk of a tube, and no more often."""
    boxes, frames = (spark.createDataFrame([], s) for s in (COLUMNS, "video_id string, frame_idx bigint"))
    rows = T.annotated_rows(boxes.repartition("video_id", frame_chunk("frame_idx")), frames)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 40, plan


def test_stride_from_bits_and_segments_without_positions(spark, rows_of):
    from trackloom.operators.ordering import frame_words

    frames = [("v", f) for f in (0, 3, 63, 64, 1023, 1024, 1027, 5000, 5003, 5006)] + [("w", 7)]
    images = frame_words(spark.createDataFrame([*frames, ("v", 2), ("x", 1)], "video_id string, frame_idx long"))
    boxes = spark.createDataFrame([(v, "1", "a", f, p) for v, f in frames for p in (1, 2)], "video_id string, track_id string, action string, frame_idx long, pos int")
    assert rows_of(T.shared_modes(boxes, images)) == rows_of(T.modes(boxes, ["video_id"]))
    both = [T.annotated_segments(T.annotated_rows(b, boxes.select("video_id", "frame_idx"))) for b in (boxes, boxes.drop("pos"))]
    assert rows_of(both[0]) == rows_of(both[1]) and len(rows_of(both[0])) > 10


def test_only_the_rows_themselves_are_numbered(spark):
    from trackloom.plans.catalog_windows import Parts
    from trackloom.plans.fixtures import Views

    parts = Parts(Views(spark, "/root/testdata/sf0.001"))
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (parts.annotated, parts.segments)]
    assert [p.count("row_number()") > 0 for p in plans] == [True, False]
    assert [p.count("RepartitionByExpression") for p in plans] == [2, 0]
