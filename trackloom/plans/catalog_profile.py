"""Registered profile and field queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackloom.functions import fields as X
from trackloom.functions import geometry as G
from trackloom.operators import profile as P
from trackloom.operators import tubes as T
from trackloom.operators.quantiles import five_numbers
from trackloom.plans.catalog_overlap import summary_sql
from trackloom.plans.fixtures import Views, ctes

BOXES = ctes("fx_boxes")
W = "greatest(0.0, x2 - x1)"
H = "greatest(0.0, y2 - y1)"
SIZES = {"width": f"{W} / 1280", "height": f"{H} / 720", "area": f"({W} * {H}) / (1280 * 720)"}
# Tube segments with the fixed step: every copy of a key in a frame after the first opens one.
FIXED = (
    "fixed",
    "SELECT *, CASE WHEN frame_idx - lag(frame_idx) OVER (PARTITION BY video_id, track_id, action ORDER BY frame_idx, pos) = 1"
    " THEN 0 ELSE 1 END AS brk FROM fx_boxes WHERE track_id <> '' AND action <> ''",
)

def shapes(v: Views):
    """Boxes as shape records: the point form and the place of ids vary with the position."""
    form = F.col("pos") % 4
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    points = (
        F.when(form == 0, G.rect_points(x1, y1, x2, y2))
        .when(form == 1, F.array(F.array(x2, y2), F.array(x1, y1)))
        .when(form == 2, F.array(F.array(x1, y1, x2, y2)))
        .otherwise(F.array(F.array(x1, y1)))
    )
    none = F.lit(None).cast("map<string,string>")
    attributes = F.when(
        form == 0, F.create_map(F.lit("action"), F.col("action"), F.lit("id"), F.col("track_id"))
    ).when(form == 1, F.create_map(F.lit("track_id"), F.col("track_id")))
    flags = F.when(
        form == 1,
        F.create_map(F.lit("action"), F.concat(F.lit("f_"), F.col("action"))),
    ).when(
        form == 2,
        F.create_map(
            F.lit("player_id"),
            F.concat(F.lit("p"), F.col("track_id")),
            F.lit("action"),
            F.col("action"),
        ),
    )
    return v.boxes().select(
        "video_id",
        "frame_idx",
        "pos",
        F.lit("player").alias("label"),
        points.alias("points"),
        F.coalesce(attributes, none).alias("attributes"),
        F.coalesce(flags, none).alias("flags"),
        F.concat(F.lit("g"), F.col("track_id")).alias("group_id"),
    )


def _box_extract(v: Views):
    box = G.box_from_points(F.col("points"))
    return shapes(v).select(
        "video_id", "frame_idx", "pos", *[box[c].alias(c) for c in ("x1", "y1", "x2", "y2")]
    )


def _names(v: Views):
    """File names of several styles made from the order table."""
    n = F.col("o_orderkey").cast("string")
    style = F.col("o_orderkey") % 4
    return v.table("orders").select(
        "o_orderkey",
        F.when(style == 0, F.concat(F.lit("/d/a.b/"), n, F.lit(".jpg")))
        .when(style == 1, F.concat(F.lit("v1/img_7_"), n, F.lit(".png")))
        .when(style == 2, F.concat(F.lit("k"), n, F.lit("x.jpeg")))
        .otherwise(F.concat(F.lit("c"), n, F.lit("_02")))
        .alias("path"),
    )


NAMES = """WITH names AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN concat('/d/a.b/', o_orderkey, '.jpg')
 WHEN 1 THEN concat('v1/img_7_', o_orderkey, '.png') WHEN 2 THEN concat('k', o_orderkey, 'x.jpeg')
 ELSE concat('c', o_orderkey, '_02') END AS path FROM orders)"""


def _auto_scale(v: Views):
    factor = F.when(F.col("person_id") % 2 == 0, 1.0).otherwise(100.0)
    mixed = v.interactions().withColumns(
        {c: F.col(c) * factor for c in ("x1", "y1", "x2", "y2")}
    )
    sides = (("x1", 1280), ("y1", 720), ("x2", 1280), ("y2", 720))
    return mixed.select(
        "video_id",
        "frame_id",
        *[
            F.round(G.to_pixels(F.col(c), F.col("x2"), F.col("y2"), F.lit(s)), 3).alias(c)
            for c, s in sides
        ],
    )


QUERIES = {
    "action_dist": (
        lambda v: P.action_distribution(v.bare_boxes()),
        BOXES
        + " SELECT CASE WHEN action = '' THEN '__unknown__' ELSE action END AS action, count(*) AS count FROM fx_boxes GROUP BY 1",
    ),
    "top_k": (
        lambda v: P.top_k(v.bare_boxes(), F.col("video_id"), "video_id", 10),
        BOXES
        + " SELECT video_id, count(*) AS count FROM fx_boxes GROUP BY 1 ORDER BY count DESC, video_id LIMIT 10",
    ),
    "bbox_norm": (
        lambda v: v.boxes().select(
            "video_id",
            "frame_idx",
            "pos",
            *[c.alias(n) for n, c in P.box_sizes().items()],
        ),
        BOXES
        + " SELECT video_id, frame_idx, pos, "
        + ", ".join(f"{e} AS {n}" for n, e in SIZES.items())
        + " FROM fx_boxes",
    ),
    "bbox_quantiles": (
        lambda v: five_numbers(v.bare_boxes(), [], P.box_sizes()),
        BOXES + " UNION ALL ".join(f" SELECT {summary_sql(e, n)} FROM fx_boxes" for n, e in SIZES.items()),
    ),
    "bbox_quantiles_radix": (
        lambda v: five_numbers(v.bare_boxes(), [], P.box_sizes(), large_cells=True, bounded=0),
        BOXES + " UNION ALL ".join(f" SELECT {summary_sql(e, n)} FROM fx_boxes" for n, e in SIZES.items()),
    ),
    "bbox_anomalies": (
        lambda v: P.anomalies(v.bare_boxes()),
        BOXES
        + """ SELECT count(*) FILTER (NOT (x1 BETWEEN 0 AND 1280 AND x2 BETWEEN 0 AND 1280 AND y1 BETWEEN 0 AND 720 AND y2 BETWEEN 0 AND 720)) AS coords_out_of_range,
 count(*) FILTER (x1 >= x2) AS x1_ge_x2, count(*) FILTER (y1 >= y2) AS y1_ge_y2,
 count(*) FILTER (img_w <= 0) AS size_missing, count(*) FILTER (x1 IS NULL) AS missing_values FROM fx_boxes""",
    ),
    "resolutions": (
        lambda v: P.resolutions(v.frames()),
        ctes("fx_frames")
        + " SELECT concat(img_w, 'x', img_h) AS resolution, count(*) AS count FROM fx_frames GROUP BY 1",
    ),
    "image_sizes": (
        lambda v: P.image_sizes(v.frames()),
        ctes("fx_frames")
        + f" SELECT {summary_sql('img_w', 'width_px')} FROM fx_frames UNION ALL SELECT {summary_sql('img_h', 'height_px')} FROM fx_frames",
    ),
    "tubes_per_action": (
        lambda v: P.tubes_per_action(T.tube_segments(v.bare_boxes(), "fixed")),
        ctes("fx_boxes", extra=[FIXED])
        + " SELECT action, sum(brk)::BIGINT AS tubes FROM fixed GROUP BY 1",
    ),
    "shapes_without_track": (
        lambda v: P.shapes_without_track(v.bare_boxes()),
        BOXES
        + " SELECT count(*) FILTER (coalesce(track_id, '') = '') AS ignored_shapes_without_id FROM fx_boxes",
    ),
    "analyze_dirs": (
        lambda v: P.analyze(v.bare_boxes(), v.frames()),
        ctes("fx_boxes", "fx_frames", extra=[FIXED])
        + """, b AS (SELECT coalesce(video_id, '__all__') AS video_id, count(DISTINCT (video_id, frame_idx)) AS frames_with_annotations,
 count(*) AS num_boxes, count(DISTINCT action) AS num_action_labels,
 count(*) FILTER (NOT (x1 BETWEEN 0 AND 1280 AND x2 BETWEEN 0 AND 1280 AND y1 BETWEEN 0 AND 720 AND y2 BETWEEN 0 AND 720)) AS coords_out_of_range,
 count(*) FILTER (x1 >= x2) AS x1_ge_x2, count(*) FILTER (y1 >= y2) AS y1_ge_y2, count(*) FILTER (img_w <= 0) AS size_missing
 FROM fx_boxes GROUP BY ROLLUP (video_id)),
 i AS (SELECT coalesce(video_id, '__all__') AS video_id, count(*) AS num_images FROM fx_frames GROUP BY ROLLUP (video_id)),
 t AS (SELECT coalesce(video_id, '__all__') AS video_id, sum(brk)::BIGINT AS tubes_total FROM fixed GROUP BY ROLLUP (video_id))
 SELECT * FROM b JOIN i USING (video_id) JOIN t USING (video_id)""",
    ),
    "majority_label": (
        lambda v: P.majority_label(v.boxes()),
        BOXES
        + """, c AS (SELECT video_id, CASE WHEN action = '' THEN 'unknown' ELSE action END AS label, count(*) AS n,
 min(frame_idx * 1000 + pos) AS met FROM fx_boxes GROUP BY ALL)
 SELECT video_id, label FROM c QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY n DESC, met) = 1""",
    ),
    "nframes": (
        lambda v: P.last_frames(v.frames()),
        ctes("fx_frames") + " SELECT video_id, max(frame_idx) AS nframes FROM fx_frames GROUP BY 1",
    ),
    "resolution": (
        lambda v: v.frames()
        .groupBy("video_id")
        .agg(
            F.min_by("img_h", "image_name").alias("height"),
            F.min_by("img_w", "image_name").alias("width"),
        ),
        ctes("fx_frames")
        + " SELECT video_id, arg_min(img_h, image_name) AS height, arg_min(img_w, image_name) AS width FROM fx_frames GROUP BY 1",
    ),
    "size_thresholds": (
        lambda v: P.size_thresholds(v.bare_boxes()).select(
            *[
                F.round(f"{s}_{m}", 6).alias(f"{s}_{m}")
                for s in "wh"
                for m in ("mean", "std", "threshold")
            ]
        ),
        BOXES
        + ", s AS (SELECT x2 - x1 AS w, y2 - y1 AS h FROM fx_boxes WHERE x2 > x1 AND y2 > y1) SELECT "
        + ", ".join(
            f"round(avg({s}), 6) AS {s}_mean, round(stddev_pop({s}), 6) AS {s}_std,"
            f" round(avg({s}) + 3 * stddev_pop({s}), 6) AS {s}_threshold"
            for s in "wh"
        )
        + " FROM s",
    ),
    "pred_ratio": (
        lambda v: P.prediction_ratio(v.predictions(), v.frames()),
        ctes("fx_predictions", "fx_frames")
        + """, h AS (SELECT split_part(id, '/', 1) AS sample, count(*) AS n FROM fx_predictions WHERE label_name = 'non_tactical' GROUP BY 1),
 t AS (SELECT video_id AS sample, count(*) AS total_frames FROM fx_frames GROUP BY 1)
 SELECT sample, total_frames, coalesce(n, 0) AS non_tactical_frames, round(coalesce(n, 0) / total_frames, 6) AS non_tactical_ratio
 FROM t LEFT JOIN h USING (sample)""",
    ),
    "no_label_samples": (
        lambda v: P.samples_without(v.predictions(), v.frames()),
        ctes("fx_predictions", "fx_frames")
        + """ SELECT DISTINCT video_id AS sample FROM fx_frames WHERE video_id NOT IN
 (SELECT split_part(id, '/', 1) FROM fx_predictions WHERE label_name = 'non_tactical')""",
    ),
    "box_extract": (
        _box_extract,
        BOXES
        + """ SELECT video_id, frame_idx, pos, CASE WHEN pos % 4 = 3 THEN NULL WHEN pos % 4 = 1 THEN least(x1, x2) ELSE x1 END AS x1,
 CASE WHEN pos % 4 <> 3 THEN y1 END AS y1, CASE WHEN pos % 4 <> 3 THEN x2 END AS x2, CASE WHEN pos % 4 <> 3 THEN y2 END AS y2 FROM fx_boxes""",
    ),
    "action_extract": (
        lambda v: shapes(v).select(
            "video_id",
            "frame_idx",
            "pos",
            X.action_of(F.col("attributes"), F.col("flags")).alias("action"),
        ),
        BOXES
        + """ SELECT video_id, frame_idx, pos, CASE pos % 4 WHEN 1 THEN concat('f_', action) WHEN 3 THEN '' ELSE action END AS action FROM fx_boxes""",
    ),
    "track_extract": (
        lambda v: shapes(v).select(
            "video_id",
            "frame_idx",
            "pos",
            X.track_of(F.col("attributes"), F.col("flags"), F.col("group_id")).alias("track_id"),
        ),
        BOXES
        + """ SELECT video_id, frame_idx, pos, concat(CASE pos % 4 WHEN 2 THEN 'p' WHEN 3 THEN 'g' ELSE '' END, track_id) AS track_id FROM fx_boxes""",
    ),
    "frame_idx": (
        lambda v: _names(v).select("o_orderkey", X.frame_index(F.col("path")).alias("frame_idx")),
        NAMES
        + """ SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey WHEN 1 THEN o_orderkey WHEN 2 THEN NULL ELSE 2 END AS frame_idx FROM names""",
    ),
    "frame_idx_all": (
        lambda v: _names(v).select(
            "o_orderkey",
            X.frame_index(F.col("path"), "all").alias("digits"),
            X.frame_index(F.col("path"), "int").alias("whole"),
        ),
        NAMES
        + """ SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 1 THEN concat('7', o_orderkey) WHEN 3 THEN concat(o_orderkey, '02') ELSE concat(o_orderkey) END AS BIGINT) AS digits,
 CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey END AS whole FROM names""",
    ),
    "stride_rule": (
        lambda v: v.table("orders")
        .select(
            "o_orderkey",
            F.concat(
                F.lit("/data/"),
                F.when(F.col("o_orderkey") % 3 == 0, "SportsHHI_std").otherwise("other"),
                F.lit("/v"),
            ).alias("path"),
        )
        .select("o_orderkey", X.stride_rule(F.col("path")).alias("stride")),
        "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE 1 END AS stride FROM orders",
    ),
    "norm_path": (
        lambda v: v.table("pages").select("page_id", X.norm_path(F.col("url")).alias("path")),
        """SELECT page_id, CASE WHEN list_contains(string_split(translate(trim(url), '\\', '/'), '/'), 'videos')
 THEN array_to_string(string_split(translate(trim(url), '\\', '/'), '/')[list_position(string_split(translate(trim(url), '\\', '/'), '/'), 'videos'):], '/')
 ELSE concat('videos/', string_split(translate(trim(url), '\\', '/'), '/')[-1]) END AS path FROM pages""",
    ),
    "sanitize": (
        lambda v: v.table("documents").select("doc_id", X.sanitize(F.col("text")).alias("name")),
        r"""SELECT doc_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'),
 '[\s\p{Z}]+', '_', 'g'), '[^0-9A-Za-z_\-\.一-龥]', '_', 'g'), ''), 'unknown') AS name FROM documents""",
    ),
    "answer_norm": (
        lambda v: v.table("documents").select("doc_id", X.answer_flag(F.col("text")).alias("answer")),
        r"""SELECT doc_id, coalesce(CAST(nullif(regexp_extract(text, '(?:^|[^\p{L}\p{N}_])([01])(?:$|[^\p{L}\p{N}_])', 1), '') AS INT),
 CAST(nullif(regexp_extract(text, '([01])', 1), '') AS INT), CASE WHEN contains(text, '是') THEN 1 ELSE 0 END) AS answer FROM documents""",
    ),
    "game_count": (
        lambda v: P.game_count(v.frames(), "image_name"),
        ctes("fx_frames")
        + " SELECT count(DISTINCT left(image_name, length(image_name) - 7)) AS games FROM fx_frames",
    ),
    "filter_prefix": (
        lambda v: v.boxes()
        .where(X.matches_prefixes(F.col("video_id"), ["v00", "v03"], ["v007", "v031"]))
        .select("video_id", "frame_idx", "pos"),
        BOXES
        + """ SELECT video_id, frame_idx, pos FROM fx_boxes WHERE (video_id LIKE 'v00%' OR video_id LIKE 'v03%') AND video_id NOT IN ('v007', 'v031')""",
    ),
    "rect_points": (
        lambda v: v.boxes().select(
            "video_id",
            "frame_idx",
            "pos",
            G.rect_points(*[F.col(c) / 7 for c in ("x1", "y1", "x2", "y2")]).alias("points"),
        ),
        BOXES
        + """, r AS (SELECT video_id, frame_idx, pos, round(x1 / 7, 3) AS a, round(y1 / 7, 3) AS b, round(x2 / 7, 3) AS c, round(y2 / 7, 3) AS d FROM fx_boxes)
 SELECT video_id, frame_idx, pos, [[a, b], [c, b], [c, d], [a, d]] AS points FROM r""",
    ),
    "scale_points": (
        lambda v: shapes(v).select(
            "video_id",
            "frame_idx",
            "pos",
            G.scale_points(F.col("points"), F.lit(0.5), F.lit(2.0)).alias("points"),
        ),
        BOXES
        + """ SELECT video_id, frame_idx, pos, CASE pos % 4 WHEN 0 THEN [[x1 / 2, y1 * 2], [x2 / 2, y1 * 2], [x2 / 2, y2 * 2], [x1 / 2, y2 * 2]]
 WHEN 1 THEN [[x2 / 2, y2 * 2], [x1 / 2, y1 * 2]] WHEN 2 THEN [[x1 / 2, y1 * 2, x2 / 2, y2 * 2]] ELSE [[x1 / 2, y1 * 2]] END AS points FROM fx_boxes""",
    ),
    "auto_scale": (
        _auto_scale,
        ctes("fx_interactions")
        + """, k AS (SELECT video_id, frame_id, x1 * f AS x1, y1 * f AS y1, x2 * f AS x2, y2 * f AS y2
 FROM (SELECT *, CASE WHEN person_id % 2 = 0 THEN 1.0::DOUBLE ELSE 100.0::DOUBLE END AS f FROM fx_interactions))
 SELECT video_id, frame_id, round(CASE WHEN n THEN x1 * 1280 ELSE x1 END, 3) AS x1, round(CASE WHEN n THEN y1 * 720 ELSE y1 END, 3) AS y1,
 round(CASE WHEN n THEN x2 * 1280 ELSE x2 END, 3) AS x2, round(CASE WHEN n THEN y2 * 720 ELSE y2 END, 3) AS y2
 FROM (SELECT *, x2 <= 2 AND y2 <= 2 AS n FROM k)""",
    ),
    "res_orient": (
        lambda v: v.table("part").select(
            "p_partkey",
            F.greatest("p_size", F.col("p_partkey") % 40).cast("bigint").alias("width"),
            F.least("p_size", F.col("p_partkey") % 40).cast("bigint").alias("height"),
        ),
        "SELECT p_partkey, greatest(p_size, p_partkey % 40)::BIGINT AS width, least(p_size, p_partkey % 40)::BIGINT AS height FROM part",
    ),
}

