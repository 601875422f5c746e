"""Registered overlap queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackloom.operators import overlap as O
from trackloom.operators.quantiles import five_numbers
from trackloom.plans.fixtures import Views, ctes

VALID = (
    "valid",
    "SELECT video_id, frame_idx, pos, track_id, CASE WHEN action = '' THEN '__unknown__' ELSE action END AS action,"
    " x1, y1, x2, y2 FROM fx_boxes WHERE x2 > x1 AND y2 > y1",
)
_INTER = (
    "greatest(0.0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0, least(a.y2, b.y2) - greatest(a.y1, b.y1))"
)
IOU = (
    f"coalesce(({_INTER}) / nullif((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - ({_INTER}), 0), 0.0)"
)
ALL_PAIRS = (
    "all_pairs",
    f"SELECT a.video_id, a.frame_idx, a.pos AS a_pos, b.pos AS b_pos, a.action AS a_action, b.action AS b_action, {IOU} AS iou"
    " FROM valid a JOIN valid b ON a.video_id = b.video_id AND a.frame_idx = b.frame_idx AND a.pos < b.pos",
)
THRESHOLD = ("th", "SELECT * FROM (VALUES (0.1::DOUBLE), (0.3::DOUBLE), (0.5::DOUBLE)) AS t(threshold)")
PAIRS = ctes("fx_boxes", extra=[VALID, ALL_PAIRS, THRESHOLD])


def summary_sql(value: str, name: str, digits: int = 6) -> str:
    """Five-number summary columns of ``value``."""
    parts = {
        "min": f"min({value})::DOUBLE",
        "p25": f"quantile_cont({value}, 0.25)",
        "mean": f"avg({value})",
        "p75": f"quantile_cont({value}, 0.75)",
        "max": f"max({value})::DOUBLE",
    }
    shown = ", ".join(f"round({e}, {digits}) AS {n}" for n, e in parts.items())
    return f"'{name}' AS metric, count({value}) AS count, {shown}"


def _pair_iou(v: Views):
    return O.frame_pairs(v.boxes()).select(
        *O.FRAME, "a_pos", "b_pos", "a_action", "b_action", F.round("iou", 6).alias("iou")
    )


def _sudden(v: Views):
    return O.sudden_changes(v.boxes()).select(
        F.col("video_id").alias("sample"),
        F.col("frame_idx").alias("frame_idx_a"),
        (F.col("frame_idx") + 1).alias("frame_idx_b"),
        *[F.col(f"{s}_{c}").alias(f"{c}_{s}") for c in ("action", "gid", "pos") for s in "ab"],
        F.round("iou", 6).alias("iou"),
    )


QUERIES = {
    "valid_boxes": (
        lambda v: O.valid_boxes(v.boxes()).select(*O.FRAME, "pos", "action", *O.BOX),
        ctes("fx_boxes", extra=[VALID])
        + " SELECT video_id, frame_idx, pos, action, x1, y1, x2, y2 FROM valid",
    ),
    "pair_iou": (
        _pair_iou,
        PAIRS
        + " SELECT video_id, frame_idx, a_pos, b_pos, a_action, b_action, round(iou, 6) AS iou FROM all_pairs WHERE iou > 0",
    ),
    "overlap_basic": (
        lambda v: O.totals(v.boxes()),
        PAIRS
        + """ SELECT (SELECT count(*) FROM (SELECT DISTINCT video_id, frame_idx FROM valid)) AS frames_with_boxes,
 (SELECT count(*) FROM (SELECT DISTINCT video_id, frame_idx FROM all_pairs WHERE iou > 0)) AS frames_with_overlaps,
 (SELECT count(*) FROM valid) AS total_boxes, (SELECT count(*) FROM all_pairs) AS total_pairs""",
    ),
    "overlap_counts": (
        lambda v: O.counts_by_threshold(v.boxes()),
        PAIRS
        + " SELECT threshold, (SELECT count(*) FROM all_pairs WHERE iou >= threshold) AS pairs FROM th",
    ),
    "overlap_by_action": (
        lambda v: O.same_action(v.boxes()),
        PAIRS
        + """ SELECT threshold, a_action AS action, count(*) AS pairs, count(DISTINCT (video_id, frame_idx)) AS frames
 FROM all_pairs JOIN th ON iou >= threshold WHERE a_action = b_action GROUP BY ALL""",
    ),
    "overlap_action_pairs": (
        lambda v: O.action_pairs(v.boxes()),
        PAIRS
        + """ SELECT threshold, least(a_action, b_action) AS action_a, greatest(a_action, b_action) AS action_b, count(*) AS pairs
 FROM all_pairs JOIN th ON iou >= threshold GROUP BY ALL""",
    ),
    "iou_hist": (
        lambda v: O.iou_histogram(v.boxes()),
        PAIRS
        + """ SELECT bin::INT AS bin, count(iou) AS pairs FROM range(10) r(bin)
 LEFT JOIN all_pairs ON least(9, floor(iou * 10)) = bin GROUP BY 1""",
    ),
    "iou_summary": (
        lambda v: O.iou_summary(v.boxes()),
        PAIRS + f" SELECT {summary_sql('iou', 'iou')} FROM all_pairs",
    ),
    "overlap_degree": (
        lambda v: O.degree_histogram(v.boxes()),
        PAIRS
        + """, n AS (SELECT video_id, frame_idx FROM valid GROUP BY ALL HAVING count(*) >= 2),
 box AS (SELECT threshold, valid.video_id, valid.frame_idx, valid.pos FROM valid JOIN n USING (video_id, frame_idx), th),
 deg AS (SELECT box.threshold, box.video_id, box.frame_idx, box.pos, count(p.iou) AS degree FROM box LEFT JOIN all_pairs p
  ON p.video_id = box.video_id AND p.frame_idx = box.frame_idx AND (p.a_pos = box.pos OR p.b_pos = box.pos)
  AND p.iou >= box.threshold GROUP BY ALL)
 SELECT threshold, degree, CASE WHEN degree > 0 THEN degree - 1 END AS degree_ref, count(*) AS boxes FROM deg GROUP BY ALL""",
    ),
    "frame_max_iou": (
        lambda v: O.frame_maxima(v.boxes()).withColumn("max_iou", F.round("max_iou", 6)),
        PAIRS
        + """ SELECT v.video_id, v.frame_idx, round(coalesce(max(iou), 0.0), 6) AS max_iou
 FROM (SELECT DISTINCT video_id, frame_idx FROM valid) v LEFT JOIN all_pairs USING (video_id, frame_idx) GROUP BY ALL""",
    ),
    "frame_max_summary": (
        lambda v: five_numbers(O.frame_maxima(v.boxes()), [], {"max_iou": F.col("max_iou")}),
        PAIRS
        + f""", m AS (SELECT coalesce(max(iou), 0.0) AS v
 FROM (SELECT DISTINCT video_id, frame_idx FROM valid) v LEFT JOIN all_pairs USING (video_id, frame_idx)
 GROUP BY video_id, frame_idx) SELECT {summary_sql('v', 'max_iou')} FROM m""",
    ),
    "sudden_changes": (
        _sudden,
        ctes("fx_boxes")
        + f""", ok AS (SELECT *, CAST(track_id AS BIGINT) AS gid FROM fx_boxes WHERE x2 > x1 AND y2 > y1)
 SELECT a.video_id AS sample, a.frame_idx AS frame_idx_a, b.frame_idx AS frame_idx_b, a.action AS action_a, b.action AS action_b,
 a.gid AS gid_a, b.gid AS gid_b, a.pos AS pos_a, b.pos AS pos_b, round({IOU}, 6) AS iou
 FROM ok a JOIN ok b ON a.video_id = b.video_id AND b.frame_idx = a.frame_idx + 1
 WHERE NOT EXISTS (SELECT 1 FROM ok c WHERE c.video_id = a.video_id AND c.frame_idx = a.frame_idx + 1 AND c.gid = a.gid)
 AND NOT EXISTS (SELECT 1 FROM ok c WHERE c.video_id = b.video_id AND c.frame_idx = b.frame_idx - 1 AND c.gid = b.gid)""",
    ),
}
