"""Registered window, context and crop queries and their SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from trackloom.operators import tubes as T
from trackloom.operators import windows as W
from trackloom.operators.ordering import frame_words
from trackloom.plans.catalog_tubes import ANNOTATED, KEY
from trackloom.plans.fixtures import Views, ctes
from trackloom.session import cut_lineage

WIN, STEP = 6, 3
SEG = f"{KEY}, run_no"


def _name(extra: str = "") -> str:
    return (
        "concat(video_id, '__tid', track_id, '__seg', printf('%02d', run_no::BIGINT)"
        + (", '__win', printf('%03d', win_no::BIGINT)" if extra else "")
        + ")"
    )


def window_sql(pad: bool) -> str:
    """Windows and their frames in SQL, with nearest frames found by comparing all candidates."""
    short_start = f"round_even(fsum / length, 0)::BIGINT - {WIN // 2}"
    if not pad:
        short_start = f"greatest(lo, least({short_start}, hi - {WIN} + 1))"
    extra = [
        *ANNOTATED,
        (
            "sg",
            f"SELECT {SEG}, min(frame_idx) AS start_f, max(frame_idx) AS end_f, count(*) AS length, sum(frame_idx) AS fsum FROM seg_s GROUP BY ALL",
        ),
        ("extent", "SELECT video_id, min(frame_idx) AS lo, max(frame_idx) AS hi FROM img GROUP BY 1"),
        (
            "starts",
            f"SELECT {SEG}, start_f, end_f, CAST((start - start_f) / {STEP} AS BIGINT) AS win_no, start FROM"
            f" (SELECT *, unnest(range(start_f, end_f - {WIN} + 2, {STEP})) AS start FROM sg WHERE end_f - start_f + 1 >= {WIN})"
            f" UNION ALL SELECT {SEG}, start_f, end_f, (end_f - {WIN} + 1 - start_f) // {STEP} + 1, end_f - {WIN} + 1 FROM sg"
            f" WHERE end_f - start_f + 1 >= {WIN} AND (end_f - {WIN} + 1 - start_f) % {STEP} <> 0"
            f" UNION ALL SELECT {SEG}, start_f, end_f, 0, {short_start} FROM sg JOIN extent USING (video_id) WHERE end_f - start_f + 1 < {WIN}",
        ),
        (
            "wf",
            f"SELECT *, start + o AS frame FROM (SELECT *, unnest(range({WIN})) AS o FROM starts)",
        ),
        (
            "plan",
            f"""SELECT w.*, i.frame_idx IS NOT NULL AS has_image, a.frame_idx IS NOT NULL AS annotated, frame < start_f OR frame > end_f AS outside,
 CASE WHEN a.frame_idx IS NOT NULL THEN frame WHEN frame < start_f THEN start_f ELSE end_f END AS box_src,
 CASE WHEN i.frame_idx IS NOT NULL THEN frame WHEN frame < start_f THEN start_f ELSE end_f END AS img_src
 FROM wf w LEFT JOIN img i ON i.video_id = w.video_id AND i.frame_idx = w.frame
 LEFT JOIN seg_s a ON a.video_id = w.video_id AND a.track_id = w.track_id AND a.action = w.action AND a.run_no = w.run_no AND a.frame_idx = w.frame""",
        ),
    ]
    return ctes("fx_boxes", "fx_frames", extra=extra)


def masks_sql(pad: bool) -> str:
    padded = "(outside AND NOT has_image)" if pad else "FALSE"
    marks = {
        "anno_mask": "NOT annotated",
        "img_mask": f"NOT has_image AND NOT {padded}",
        "edge_pad": padded,
    }
    return (
        window_sql(pad)
        + f" SELECT {_name('win')} AS \"window\", "
        + ", ".join(
            f"coalesce(string_agg(CASE WHEN {t} THEN (o + 1)::VARCHAR END, ',' ORDER BY o), '') AS {n}"
            for n, t in marks.items()
        )
        + f" FROM plan GROUP BY {SEG}, win_no HAVING bool_or(NOT annotated) OR bool_or(NOT has_image)"
    )


class Parts:
    """Rows, segments, window starts and windows of one run, each made when it is first wanted."""

    def __init__(self, v: Views, pad: bool = False):
        self.pad = pad
        self.boxes, self.bare, self.frames = v.boxes(), v.bare_boxes(), v.frames()
        self.annotated = T.annotated_rows(self.boxes, self.frames, self.bare)

    @cached_property
    def rows(self):
        """The rows written once, for queries that read them beside their segments."""
        return cut_lineage(self.annotated)

    @cached_property
    def segments(self):
        """From the rows where they are written, else from boxes without their position, which segments don't need."""
        rows = self.__dict__.get("rows")
        return T.annotated_segments(T.annotated_rows(self.bare, self.frames) if rows is None else rows)

    @cached_property
    def starts(self):
        return W.window_starts(self.annotated, self.segments, self.frames, WIN, STEP, pad=self.pad)

    @cached_property
    def windows(self):
        return W.windows(self.starts, self.frames, WIN)


def _masks(v: Views, pad: bool = False):
    return W.masks_of(Parts(v, pad).windows, WIN, pad)


def _nearest(v: Views):
    p = Parts(v)
    rows = p.rows
    return W.filled_boxes(p.windows, rows, WIN).select(
        *W.WINDOW, "offset", "frame", "img_src", "box_src", "x1", "y1", "x2", "y2"
    )


def _shapes(v: Views):
    """Videos whose boxes lie a frame apart are windowed in one dealing of their boxes, the others as ``window_shapes`` does."""
    bare, frames = v.bare_boxes(), v.frames()
    steps = T.shared_modes(T.in_tube(bare), frame_words(frames))
    far = F.broadcast(steps.where("_mode <> 1").select("video_id"))
    kinds = {how: lambda df, how=how: df.join(far, "video_id", how) for how in ("left_anti", "left_semi")}
    near = W.dense_window_shapes(
        v.boxes(WIN, kinds["left_anti"]), kinds["left_anti"](bare), frames, WIN, STEP
    )
    bare, frames = kinds["left_semi"](bare), kinds["left_semi"](frames)
    boxes = v.boxes(keep=kinds["left_semi"])
    rows = T.annotated_rows(boxes, frames, bare)
    starts = W.window_starts(rows, T.annotated_segments(T.annotated_rows(bare, frames)), frames, WIN, STEP, lazy=True)
    return near.unionByName(W.window_shapes(W.windows(starts, frames, WIN), rows, boxes, WIN))


def _membership(v: Views):
    """Samples by split; one sample in ten is in two splits, some in none."""
    number = F.right(F.col("video_id"), F.lit(1)).cast("int")
    split = F.when(number < 6, F.array(F.lit("train"))).when(
        number == 6, F.array(F.lit("val"), F.lit("test"))
    ).when(number == 7, F.array(F.lit("val")))
    return (
        v.frames().select("video_id").distinct().select("video_id", F.explode(split).alias("split"))
    )


MEMBERS = (
    "members",
    "SELECT DISTINCT video_id, unnest(CASE WHEN right(video_id, 1) < '6' THEN ['train'] WHEN right(video_id, 1) = '6' THEN ['val', 'test']"
    " WHEN right(video_id, 1) = '7' THEN ['val'] ELSE [] END) AS split FROM fx_frames",
)


def _index(v: Views):
    return W.window_index(Parts(v).starts, _membership(v))


def _split_by_tube(v: Views):
    p = Parts(v)
    rows = p.rows
    return W.tube_shapes(rows, p.segments, p.boxes, min_len=2)


def _crop(strategy: str):
    return lambda v: W.crop_plan(
        cut_lineage(T.annotated_rows(v.boxes(), v.frames(), v.bare_boxes())), strategy
    )


def crop_sql(strategy: str) -> str:
    w, h = "greatest(1.0, ref_x2 - ref_x1)", "greatest(1.0, ref_y2 - ref_y1)"
    if strategy == "square":
        w = h = f"greatest({w}, {h})"

    def side(axis: str, sign: str, size: str, limit: int) -> str:
        return f"greatest(0, least({limit}, round_even(({axis}1 + {axis}2) / 2.0::DOUBLE {sign} {size} / 2.0::DOUBLE, 0)::BIGINT))"

    new = (
        ("224", "224")
        if strategy == "square"
        else tuple(
            f"greatest(1, round_even({c} * least(224::DOUBLE / cw, 224::DOUBLE / ch), 0)::INT)"
            for c in ("cw", "ch")
        )
    )
    return (
        ctes("fx_boxes", "fx_frames", extra=ANNOTATED)
        + f""", ref AS (SELECT {SEG}, x1 AS ref_x1, y1 AS ref_y1, x2 AS ref_x2, y2 AS ref_y2 FROM seg_s
 QUALIFY row_number() OVER (PARTITION BY {SEG} ORDER BY greatest(0.0, x2 - x1) * greatest(0.0, y2 - y1) DESC, frame_idx, ord) = 1),
 c AS (SELECT {SEG}, frame_idx, ord AS pos, {side('x', '-', w, 1280)} AS crop_x1, {side('y', '-', h, 720)} AS crop_y1,
 {side('x', '+', w, 1280)} AS crop_x2, {side('y', '+', h, 720)} AS crop_y2 FROM seg_s JOIN ref USING ({SEG})),
 d AS (SELECT *, crop_x2 - crop_x1 AS cw, crop_y2 - crop_y1 AS ch FROM c),
 e AS (SELECT *, CASE WHEN cw <= 0 OR ch <= 0 THEN 0 ELSE {new[0]} END AS new_w, CASE WHEN cw <= 0 OR ch <= 0 THEN 0 ELSE {new[1]} END AS new_h FROM d)
 SELECT {KEY}, run_no::BIGINT AS run_no, frame_idx, pos, crop_x1, crop_y1, crop_x2, crop_y2, new_w, new_h,
 CASE WHEN new_w = 0 THEN 0 ELSE (224 - new_w) // 2 END AS x_off, CASE WHEN new_h = 0 THEN 0 ELSE (224 - new_h) // 2 END AS y_off FROM e"""
    )


SAMPLE = (
    "sample",
    "SELECT action, video_id, frame_idx FROM (SELECT DISTINCT CASE WHEN action = '' THEN '__unknown__' ELSE action END AS action, video_id, frame_idx FROM fx_boxes)"
    " QUALIFY row_number() OVER (PARTITION BY action ORDER BY md5(concat(video_id, '/', frame_idx, '/0')), video_id, frame_idx) <= {}",
)


def sample(k: int) -> tuple[str, str]:
    return SAMPLE[0], SAMPLE[1].format(k)


RANKED = (
    "ranked",
    "SELECT video_id, frame_idx, image_name, row_number() OVER (PARTITION BY video_id ORDER BY image_name) AS rank FROM fx_frames",
)


def context_sql(k: int, around: int, missing: str) -> str:
    lost = "(SELECT min(image_name) FROM fx_frames f WHERE f.video_id = s.video_id)" if missing == "first" else "NULL"
    return (
        ctes("fx_boxes", "fx_frames", extra=[sample(k), RANKED])
        + f""" SELECT s.action, s.video_id, s.frame_idx, (n.rank - c.rank)::INT AS "offset", n.image_name FROM sample s
 JOIN ranked c USING (video_id, frame_idx) JOIN ranked n ON n.video_id = s.video_id AND abs(n.rank - c.rank) <= {around}
 UNION ALL SELECT s.action, s.video_id, s.frame_idx, 0, {lost} FROM sample s ANTI JOIN ranked c USING (video_id, frame_idx)"""
    )


def _visualize(v: Views):
    """Context frames with the boxes to draw on them, rounded to whole pixels."""
    boxes = v.boxes()
    context = W.context_frames(W.sample_frames(boxes, 3), v.frames(), 2, "centre")
    names = v.frames().select("video_id", F.col("frame_idx").alias("shown"), "image_name")
    drawn = boxes.select(
        "video_id",
        F.col("frame_idx").alias("shown"),
        "pos",
        F.col("action").alias("box_action"),
        *[F.bround(c).cast("bigint").alias(c) for c in ("x1", "y1", "x2", "y2")],
    )
    return (
        context.join(names, ["video_id", "image_name"])
        .join(drawn, ["video_id", "shown"])
        .select("action", "video_id", "frame_idx", "offset", "pos", "box_action", "x1", "y1", "x2", "y2")
    )


QUERIES = {
    "fpswin_starts": (
        lambda v: Parts(v).starts.select(*W.WINDOW, "start"),
        window_sql(False) + f" SELECT {KEY}, run_no::BIGINT AS run_no, win_no, start FROM starts",
    ),
    "fpswin_starts_pad": (
        lambda v: Parts(v, True).starts.select(*W.WINDOW, "start"),
        window_sql(True) + f" SELECT {KEY}, run_no::BIGINT AS run_no, win_no, start FROM starts",
    ),
    "nearest_fill": (
        _nearest,
        window_sql(False)
        + f""" SELECT p.video_id, p.track_id, p.action, p.run_no::BIGINT AS run_no, win_no, o::INT AS "offset", frame, img_src, box_src, s.x1, s.y1, s.x2, s.y2
 FROM plan p JOIN seg_s s ON s.video_id = p.video_id AND s.track_id = p.track_id AND s.action = p.action AND s.run_no = p.run_no AND s.frame_idx = p.box_src""",
    ),
    "fpswin_mask": (_masks, masks_sql(False)),
    "fpswin_mask_pad": (lambda v: _masks(v, True), masks_sql(True)),
    "fpswin_shapes": (
        _shapes,
        window_sql(False)
        + f""", f AS (SELECT p.*, s.x1 AS sx1, s.y1 AS sy1, s.x2 AS sx2, s.y2 AS sy2 FROM plan p JOIN seg_s s
 ON s.video_id = p.video_id AND s.track_id = p.track_id AND s.action = p.action AND s.run_no = p.run_no AND s.frame_idx = p.box_src),
 j AS (SELECT f.*, b.pos, b.action AS b_action, b.x1, b.y1, b.x2, b.y2 FROM f LEFT JOIN fx_boxes b
 ON b.video_id = f.video_id AND b.track_id = f.track_id AND b.frame_idx = f.img_src)
 SELECT {_name('win')} AS "window", o::INT AS "offset", coalesce(pos, 0) AS shape_pos, CASE WHEN pos IS NULL THEN action ELSE b_action END AS action,
 coalesce(x1, sx1) AS x1, coalesce(y1, sy1) AS y1, coalesce(x2, sx2) AS x2, coalesce(y2, sy2) AS y2 FROM j""",
    ),
    "fpswin_single": (
        _index,
        window_sql(False)
        + f", {MEMBERS[0]} AS ({MEMBERS[1]}) SELECT split, concat('videos/', {_name('win')}) AS path, action AS label FROM starts JOIN members USING (video_id)",
    ),
    "split_by_tube": (
        _split_by_tube,
        ctes("fx_boxes", "fx_frames", extra=ANNOTATED)
        + f""" SELECT {_name()} AS sample, s.frame_idx, s.action, b.pos AS shape_pos, b.action AS shape_action
 FROM (SELECT * FROM seg_s QUALIFY count(*) OVER (PARTITION BY {SEG}) >= 2) s
 JOIN (SELECT video_id, frame_idx, track_id, pos, action FROM fx_boxes) b USING (video_id, frame_idx, track_id)""",
    ),
    "export_tubes": (
        lambda v: W.tube_list(
            Parts(v).segments,
            v.spark.sql("SELECT * FROM VALUES (0, 'shoot'), (1, 'pass') AS t(label_id, label_name)"),
        ),
        ctes("fx_boxes", "fx_frames", extra=ANNOTATED)
        + f""" SELECT concat({_name()}, '.mp4') AS tube, CASE action WHEN 'shoot' THEN '0' WHEN 'pass' THEN '1' ELSE action END AS label, length AS frames FROM seg""",
    ),
    "crop_plan": (_crop("letterbox"), crop_sql("letterbox")),
    "crop_plan_square": (_crop("square"), crop_sql("square")),
    "class_sample": (
        lambda v: W.sample_frames(v.bare_boxes(), 3),
        ctes("fx_boxes", extra=[sample(3)]) + " SELECT * FROM sample",
    ),
    "context_frames": (
        lambda v: W.context_frames(W.sample_frames(v.bare_boxes(), 20), v.frames(), 6),
        context_sql(20, 6, "first"),
    ),
    "context_centre": (
        lambda v: W.context_frames(W.sample_frames(v.bare_boxes(), 20), v.frames(), 2, "centre"),
        context_sql(20, 2, "centre"),
    ),
    "visualize_samples": (
        _visualize,
        ctes("fx_boxes", "fx_frames", extra=[sample(3), RANKED])
        + """ SELECT s.action, s.video_id, s.frame_idx, (n.rank - c.rank)::INT AS "offset", b.pos, b.action AS box_action,
 round_even(b.x1, 0)::BIGINT AS x1, round_even(b.y1, 0)::BIGINT AS y1, round_even(b.x2, 0)::BIGINT AS x2, round_even(b.y2, 0)::BIGINT AS y2
 FROM sample s JOIN ranked c USING (video_id, frame_idx) JOIN ranked n ON n.video_id = s.video_id AND abs(n.rank - c.rank) <= 2
 JOIN fx_boxes b ON b.video_id = s.video_id AND b.frame_idx = n.frame_idx""",
    ),
    "upsample": (
        lambda v: W.upsample(v.frames(), 6, 30),
        ctes("fx_frames", extra=[RANKED])
        + """ SELECT video_id, image_name AS src_name, (rank - 1) * 5 + k AS new_index, concat(printf('%06d', (rank - 1) * 5 + k), '.jpg') AS new_name
 FROM (SELECT *, unnest(range(1, 6)) AS k FROM ranked)""",
    ),
    "upsample_ann": (
        lambda v: W.upsample_annotations(
            v.table("documents").select(
                F.col("doc_id").cast("string").alias("tube"),
                F.col("lang").alias("label"),
                F.when(F.col("doc_id") % 5 == 0, F.lit("n/a"))
                .otherwise(F.col("n_chars").cast("string"))
                .alias("frames"),
            ),
            6,
            30,
        ),
        """SELECT doc_id::VARCHAR AS tube, lang AS label, CASE WHEN doc_id % 5 = 0 THEN 'n/a' ELSE (n_chars * 5)::VARCHAR END AS frames FROM documents""",
    ),
}
