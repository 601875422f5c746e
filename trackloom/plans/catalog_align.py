"""Registered cross-dataset queries and their SQL. Side ms is the first box view, sh the second."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackloom.operators import align as A
from trackloom.operators import overlap as O
from trackloom.plans.catalog_overlap import IOU
from trackloom.plans.fixtures import Views, ctes

RUN = [
    ("al", "SELECT * FROM fx_alignment WHERE status = 'ok'"),
    (
        "common_t",
        """SELECT m.video_id, m.t FROM (SELECT DISTINCT b.video_id, frame_idx - ms_index AS t FROM fx_boxes b JOIN al USING (video_id)) m
 JOIN (SELECT DISTINCT b.video_id, frame_idx - sh_index AS t FROM fx_boxes_b b JOIN al USING (video_id)) s USING (video_id, t) WHERE t >= 0""",
    ),
    (
        "run",
        """SELECT video_id, t, ms_index + t AS ms_idx, sh_index + t AS sh_idx FROM
 (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY t) - 1 AS n FROM common_t) JOIN al USING (video_id) WHERE n = t""",
    ),
    ("ms", "SELECT r.t, b.* FROM fx_boxes b JOIN run r ON r.video_id = b.video_id AND r.ms_idx = b.frame_idx WHERE x2 > x1 AND y2 > y1"),
    ("sh", "SELECT r.t, b.* FROM fx_boxes_b b JOIN run r ON r.video_id = b.video_id AND r.sh_idx = b.frame_idx WHERE x2 > x1 AND y2 > y1"),
    (
        "cross_pairs",
        f"SELECT a.video_id, a.t, a.pos AS a_pos, b.pos AS b_pos, a.action AS a_action, b.action AS b_action, {IOU} AS iou FROM ms a JOIN sh b ON a.video_id = b.video_id AND a.t = b.t",
    ),
    (
        "best",
        """SELECT video_id, t, 'ms' AS side, a_pos AS pos, max(iou) AS best FROM cross_pairs GROUP BY ALL
 UNION ALL SELECT video_id, t, 'sh', b_pos, max(iou) FROM cross_pairs GROUP BY ALL""",
    ),
]
ALIGNED = ctes("fx_boxes", "fx_boxes_b", "fx_alignment", extra=RUN)


class Pair:
    """Run and boxes of the two sides."""

    def __init__(self, v: Views):
        self.a, self.b = v.boxes(), v.boxes_b()
        self.alignment = A.usable_alignment(v.alignment(), ("ok",))
        self.run = A.common_run(self.alignment, v.bare_boxes(), self.b)
        self.ms = A.run_boxes(self.run, self.a, "ms")
        self.sh = A.run_boxes(self.run, self.b, "sh")


def summary_sql(keys: str) -> str:
    parts = []
    for side, name in (("ms", "ms_to_sh"), ("sh", "sh_to_ms")):
        f = f"FILTER (side = '{side}')"
        parts.append(f"count(*) {f} AS {side}_boxes, round(avg(best) {f}, 6) AS mean_{name}")
        for t in (0.5, 0.75):
            parts.append(
                f"round(avg((best >= {t})::INT) {f}, 6) AS frac_{name}_{str(t).replace('.', '_')}"
            )
    return f" SELECT {keys}, {', '.join(parts)} FROM best GROUP BY ALL"


def _over(v: Views):
    p = Pair(v)
    return A.pairs_over(p.ms, p.sh, 0.5).select(
        *A.STEP, "a_pos", "b_pos", "a_action", "b_action", F.round("iou", 6).alias("iou")
    )


def _pairs(v: Views):
    p = Pair(v)
    return A.step_pairs(p.ms, p.sh).select(
        *A.STEP, "a_pos", "b_pos", F.round("iou", 6).alias("iou")
    )


def _best(v: Views):
    p = Pair(v)
    return A.best_matches(p.ms, p.sh)


def _first_high(v: Views):
    p = Pair(v)
    return A.first_high(p.ms, p.sh, 0.9).select(
        *A.STEP, "a_pos", "b_pos", F.round("iou", 6).alias("iou")
    )


def _hist(v: Views):
    p = Pair(v)
    return A.histogram(p.ms, p.sh)


def _actions(v: Views):
    p = Pair(v)
    return A.action_pairs(p.ms, p.sh, 0.5)


def _action_ids(v: Views):
    names = v.spark.sql("SELECT * FROM VALUES ('shoot', 7), ('pass', 3) AS t(label_name, label_id)")
    return A.action_pair_ids(_actions(v), names, names)


def _endings(v: Views):
    return A.endings(A.usable_alignment(v.alignment()), v.bare_boxes(), v.frames())


ENDINGS = ctes(
    "fx_boxes",
    "fx_frames",
    "fx_alignment",
    extra=[
        RUN[0],
        ("mt", "SELECT DISTINCT b.video_id, frame_idx - ms_index AS t FROM fx_boxes b JOIN al USING (video_id) WHERE frame_idx >= ms_index"),
        ("st", "SELECT DISTINCT b.video_id, frame_idx - sh_index AS t FROM fx_frames b JOIN al USING (video_id) WHERE frame_idx >= sh_index"),
        ("ml", "SELECT video_id, count(*) AS m FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY t) - 1 AS n FROM mt) WHERE n = t GROUP BY 1"),
        ("sl", "SELECT video_id, count(*) AS s FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY t) - 1 AS n FROM st) WHERE n = t GROUP BY 1"),
        (
            "e",
            """SELECT video_id, CASE WHEN m < s THEN 'ms' WHEN s < m THEN 'sh' WHEN m = 0 THEN 'unknown' ELSE 'tie' END AS ends_first,
 least(m, s) AS common_len, m AS ms_len, s AS sh_len, greatest(m - s, 0) AS ms_extra, greatest(s - m, 0) AS sh_extra
 FROM (SELECT al.video_id, coalesce(m, 0) AS m, coalesce(s, 0) AS s FROM al LEFT JOIN ml USING (video_id) LEFT JOIN sl USING (video_id))""",
        ),
    ],
)


def _search(v: Views):
    """The second side is the whole first one, brighter and seven frames later; its first frame is looked for."""
    pixels = v.pixels().withColumn("file", F.concat(F.col("frame_idx").cast("string"), F.lit(".jpg")))
    later = pixels.withColumn("frame_idx", F.col("frame_idx") + 7).withColumn("pixels", F.transform("pixels", lambda x: x + 0.25))
    return A.align_search(pixels, later, 0.27).withColumn("mean", F.round("mean", 6))


def _merge(v: Views):
    p = Pair(v)
    sizes = v.bare_boxes().groupBy("video_id", "frame_idx").agg(
        F.max("img_w").alias("img_w"), F.max("img_h").alias("img_h")
    )
    small = p.b.groupBy("video_id", "frame_idx").agg(
        F.lit(640).alias("img_w"), F.lit(480).alias("img_h")
    )
    return A.merge_aligned(p.run, p.a, p.b, small, sizes)


QUERIES = {
    "align_filter": (
        lambda v: A.usable_alignment(v.alignment()),
        ctes("fx_boxes", "fx_alignment")
        + " SELECT * FROM fx_alignment WHERE status IN ('ok', 'no_below_threshold') AND sh_index <> 0 AND ms_index <> 0",
    ),
    "first_common": (
        lambda v: A.common_index(v.bare_boxes(), v.frames()),
        ctes("fx_boxes", "fx_frames")
        + " SELECT video_id, min(frame_idx) AS first_common FROM fx_boxes JOIN fx_frames USING (video_id, frame_idx) GROUP BY 1",
    ),
    "common_run": (lambda v: Pair(v).run, ALIGNED + " SELECT * FROM run"),
    "xds_pair_iou": (
        _pairs,
        ALIGNED + " SELECT video_id, t, a_pos, b_pos, round(iou, 6) AS iou FROM cross_pairs WHERE iou > 0",
    ),
    "xds_pairs_over": (
        _over,
        ALIGNED
        + " SELECT video_id, t, a_pos, b_pos, a_action, b_action, round(iou, 6) AS iou FROM cross_pairs WHERE iou > 0.5",
    ),
    "xds_hist": (
        _hist,
        ALIGNED
        + " SELECT bin::INT AS bin, count(iou) AS pairs FROM range(10) r(bin) LEFT JOIN cross_pairs ON least(9, floor(iou * 10)) = bin GROUP BY 1",
    ),
    "best_iou": (
        lambda v: _best(v).withColumn("best", F.round("best", 6)),
        ALIGNED + " SELECT video_id, t, side, pos, round(best, 6) AS best FROM best",
    ),
    "xds_frame_summary": (
        lambda v: A.match_summary(_best(v), A.STEP),
        ALIGNED + summary_sql("video_id, t"),
    ),
    "xds_summary": (
        lambda v: A.match_summary(_best(v), ["video_id"]),
        ALIGNED + summary_sql("video_id"),
    ),
    "xds_action_pairs": (
        _actions,
        ALIGNED
        + " SELECT b_action AS sh_action, a_action AS ms_action, count(*) AS count FROM cross_pairs WHERE iou > 0.5 GROUP BY ALL",
    ),
    "xds_action_ids": (
        _action_ids,
        ALIGNED
        + """, d AS (SELECT * FROM (VALUES ('shoot', 7), ('pass', 3)) AS t(n, i))
 SELECT concat(s.i, '-', m.i) AS pair, count(*) AS count FROM cross_pairs JOIN d s ON s.n = b_action JOIN d m ON m.n = a_action WHERE iou > 0.5 GROUP BY 1""",
    ),
    "first_high_iou": (
        _first_high,
        ALIGNED
        + """ SELECT video_id, t, a_pos, b_pos, round(iou, 6) AS iou FROM (SELECT *, min(t) OVER (PARTITION BY video_id) AS mt FROM cross_pairs WHERE iou >= 0.9) WHERE t = mt""",
    ),
    "endings": (_endings, ENDINGS + " SELECT * FROM e"),
    "ending_counts": (
        lambda v: A.ending_counts(_endings(v)),
        ENDINGS
        + " SELECT CASE WHEN ms_len > sh_len THEN 'ms' ELSE 'sh' END AS who_more, abs(ms_len - sh_len) AS extra_frames, count(*) AS count FROM e WHERE ms_len <> sh_len GROUP BY ALL",
    ),
    "ending_summary": (
        lambda v: A.ending_summary(_endings(v)),
        ENDINGS
        + """ SELECT count(*) AS videos, count(*) FILTER (ends_first = 'ms') AS ms_ends_first, count(*) FILTER (ends_first = 'sh') AS sh_ends_first,
 count(*) FILTER (ends_first IN ('tie', 'unknown')) AS tie_or_unknown, round(avg(ms_extra), 6) AS avg_ms_extra, round(avg(sh_extra), 6) AS avg_sh_extra FROM e""",
    ),
    "frame_diff": (
        lambda v: v.pixels()
        .alias("a")
        .join(
            v.pixels().where("frame_idx = 7").select("video_id", F.col("pixels").alias("ref")),
            "video_id",
        )
        .select(
            "video_id", "frame_idx", F.round(A.mean_abs_diff(F.col("pixels"), F.col("ref")), 6).alias("mean")
        ),
        ctes("fx_pixels")
        + """ SELECT a.video_id, a.frame_idx, round(list_sum(list_transform(list_zip(a.pixels, b.pixels), lambda z: abs(cast(z[1] AS DOUBLE) - cast(z[2] AS DOUBLE)))) / len(a.pixels), 6) AS mean
 FROM fx_pixels a JOIN fx_pixels b ON a.video_id = b.video_id AND b.frame_idx = 7""",
    ),
    "align_search": (
        _search,
        ctes("fx_pixels")
        + """, s AS (SELECT video_id, list_transform(pixels, lambda x: CAST(x AS DOUBLE) + 0.25::DOUBLE) AS ref FROM fx_pixels WHERE frame_idx = 0),
 c AS (SELECT p.video_id, frame_idx, frame_idx - 7 AS k, list_sum(list_transform(list_zip(pixels, ref), lambda z: abs(cast(z[1] AS DOUBLE) - cast(z[2] AS DOUBLE)))) / len(pixels) AS mean
 FROM fx_pixels p JOIN s USING (video_id) WHERE frame_idx >= 7),
 r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY mean < 0.27 DESC, CASE WHEN mean < 0.27 THEN k ELSE mean END, k) AS n FROM c)
 SELECT video_id, 7::BIGINT AS sh_index, '0.jpg' AS sh_file, frame_idx AS ms_index, concat(frame_idx, '.jpg') AS ms_file, k, round(mean, 6) AS mean,
 CASE WHEN mean < 0.27 THEN 'ok' ELSE 'no_below_threshold' END AS status FROM r WHERE n = 1""",
    ),
    "merge_aligned": (
        _merge,
        ALIGNED
        + """ SELECT b.video_id, sh_idx, 'SH' AS source, pos, track_id, action, x1, y1, x2, y2 FROM fx_boxes_b b JOIN run r ON r.video_id = b.video_id AND r.sh_idx = b.frame_idx
 UNION ALL SELECT b.video_id, sh_idx, 'MS', pos, track_id, action, x1 * (640::DOUBLE / 1280), y1 * (480::DOUBLE / 720), x2 * (640::DOUBLE / 1280), y2 * (480::DOUBLE / 720)
 FROM fx_boxes b JOIN run r ON r.video_id = b.video_id AND r.ms_idx = b.frame_idx""",
    ),
}
