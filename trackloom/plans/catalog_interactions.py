"""Registered interaction and tube-table queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackloom.operators import interaction_records as N
from trackloom.operators import interactions as I
from trackloom.operators import tubes as T
from trackloom.operators import tubetable as B
from trackloom.plans.catalog_overlap import summary_sql
from trackloom.plans.catalog_tubes import ANNOTATED_SQL, lengths_sql
from trackloom.plans.fixtures import Views, ctes
from trackloom.session import cut_lineage

ROWS = ctes("fx_interactions")
NAMED = ctes("fx_interactions", "fx_action_list") + (
    ", n AS (SELECT i.*, action_name, trim(split_part(action_name, ' - ', 1)) AS sport FROM fx_interactions i LEFT JOIN fx_action_list USING (action_id))"
)
# The second box: complete only where the view gives its first coordinate.
SECOND = "x1_2, y1 / 2 AS y1_2, x1_2 + 0.05::DOUBLE AS x2_2, y1 / 2 + 0.1::DOUBLE AS y2_2"


def named(v: Views):
    return I.with_action_names(v.interactions(), v.action_list())


def two_boxes(v: Views, rows=None):
    return (v.interactions() if rows is None else rows).withColumns(
        {
            "y1_2": F.col("y1") / 2,
            "x2_2": F.col("x1_2") + 0.05,
            "y2_2": F.col("y1") / 2 + 0.1,
        }
    )


def anomalies_sql(s: str) -> str:
    sides = [f"{c}{s}" for c in ("x1", "y1", "x2", "y2")]
    inside = " AND ".join(f"coalesce({c} BETWEEN 0 AND 1, FALSE)" for c in sides)
    null = " OR ".join(f"{c} IS NULL" for c in sides)
    return (
        f"count(*) FILTER (NOT ({inside})) AS coords_out_of_range, count(*) FILTER (x1{s} >= x2{s}) AS x1_ge_x2,"
        f" count(*) FILTER (y1{s} >= y2{s}) AS y1_ge_y2, count(*) FILTER ({null}) AS missing_values, count(*) FILTER (NOT ({null})) AS num_boxes"
    )


def box_sql(s: str) -> str:
    parts = {"width": f"x2{s} - x1{s}", "height": f"y2{s} - y1{s}"}
    parts["area"] = f"({parts['width']}) * ({parts['height']})"
    return " UNION ALL ".join(f" SELECT {summary_sql(f'({e})', n, 9)} FROM two" for n, e in parts.items())


TWO = ctes("fx_interactions", extra=[("two", f"SELECT * EXCLUDE (x1_2), {SECOND} FROM fx_interactions")])
DUP_KEY = ["video_id", "frame_id", "action_id", "person_id"]


# Tube table: one tube per (video, action, track).
TUBES = (
    "tubes",
    "SELECT video_id, CASE action WHEN 'hold' THEN 0 WHEN 'pass' THEN 1 ELSE 2 END::BIGINT AS class_id, track_id::BIGINT AS tube_no, frame_idx, x1, y1, x2, y2 FROM fx_boxes WHERE action <> ''",
)
TUBE_SQL = ctes("fx_boxes", extra=[TUBES])
LABELS = "SELECT * FROM (VALUES (0, 'hold'), (1, 'pass')) AS t(label_id, label_name)"


def tube_boxes(v: Views):
    number = F.when(F.col("action") == "hold", 0).when(F.col("action") == "pass", 1).otherwise(2)
    return v.bare_boxes().where(F.col("action") != "").select(
        "video_id",
        number.cast("bigint").alias("class_id"),
        F.col("track_id").cast("bigint").alias("tube_no"),
        "frame_idx",
        *[F.col(c) for c in ("x1", "y1", "x2", "y2")],
    )


def labels(v: Views):
    return v.spark.sql(LABELS)


def resolution(v: Views):
    return v.frames().groupBy("video_id").agg(
        F.max("img_w").alias("height"), F.max("img_h").alias("width")
    )


def _mixed(v: Views):
    """Tube table as raw columns; odd tubes are very wide."""
    odd = F.col("tube_no") % 2 == 1
    return tube_boxes(v).select(
        *B.TUBE,
        F.when(odd, F.col("x1") - 2000).otherwise(F.col("x1")).alias("c1"),
        F.col("y1").alias("c2"),
        F.col("x2").alias("c3"),
        F.col("y2").alias("c4"),
    )


def _sizes(v: Views):
    return B.oriented_sizes(_mixed(v), ("c1", "c2", "c3", "c4"))


SIZES = TUBE_SQL + """, mixed AS (SELECT video_id, class_id, tube_no, CASE WHEN tube_no % 2 = 1 THEN x1 - 2000 ELSE x1 END AS c1, y1 AS c2, x2 AS c3, y2 AS c4 FROM tubes),
 t AS (SELECT video_id, class_id, tube_no, avg((c3 - c1 > 0)::INT) > 0.9 AND avg((c4 - c2 > 0)::INT) > 0.9 AS a_ok,
 avg(c4 - c2) * avg(c3 - c1) AS b_size, avg(c3 - c1) * avg(c4 - c2) AS a_size FROM mixed GROUP BY ALL),
 sizes AS (SELECT m.*, CASE WHEN a_ok AND b_size > a_size THEN c4 - c2 ELSE c3 - c1 END AS width,
 CASE WHEN a_ok AND b_size > a_size THEN c3 - c1 ELSE c4 - c2 END AS height, CASE WHEN a_ok AND b_size > a_size THEN 'yx' ELSE 'xy' END AS box_order
 FROM mixed m JOIN t USING (video_id, class_id, tube_no))"""


def _std_to_tubes(v: Views):
    # The rows are read several times, so they are written once to the checkpoint folder.
    rows = cut_lineage(T.annotated_rows(v.boxes(), v.frames(), v.bare_boxes()))
    return B.from_segments(rows).select(
        *B.TUBE, "frame_idx", "x1", "y1", "x2", "y2"
    )


STD_TUBES = ANNOTATED_SQL + """, met AS (SELECT video_id, track_id, action, min((frame_idx, ord)) AS met FROM seg_s GROUP BY ALL),
 num AS (SELECT s.*, row_number() OVER (PARTITION BY s.video_id, s.action ORDER BY met, s.track_id, s.run_no) - 1 AS tube_no FROM seg s JOIN met USING (video_id, track_id, action)),
 cls AS (SELECT action, row_number() OVER (ORDER BY action) - 1 AS class_id FROM (SELECT DISTINCT action FROM seg))
 SELECT s.video_id, class_id, tube_no, s.frame_idx, x1, y1, x2, y2 FROM seg_s s JOIN num n USING (video_id, track_id, action, run_no) JOIN cls USING (action)"""


def _split_profile(v: Views):
    split = F.when(F.right("video_id", F.lit(1)) < "8", "train").otherwise("test")
    videos = v.frames().groupBy("video_id").agg(
        F.max("frame_idx").alias("nframes"), F.max("img_h").alias("height"), F.max("img_w").alias("width")
    )
    return B.split_profile(videos.withColumn("split", split))


def _proposals(v: Views):
    keys = v.interactions().select(F.concat_ws(",", "video_id", "frame_id").alias("key")).distinct()
    kept = I.keep_actions(v.interactions(), I.label_subset(v.action_list(), "volleyball"))
    return I.keep_proposals(keys, kept)


def interaction_texts(v: Views):
    """Record texts of every frame with an image, with both boxes."""
    rows = I.with_action_names(two_boxes(v, v.interactions_by_frame()), v.action_list())
    images = v.frames().select("video_id", "image_name", F.col("img_w").alias("width"), F.col("img_h").alias("height"))
    placed = N.placed_frames(v.interactions().select("video_id", "frame_id"), images)
    return N.record_texts(rows, placed, N.VALUE_ORDER, secondary=True)


def _side(value: str, times: int) -> str:
    """A rounded pixel side as JSON writes it."""
    return f"(round({value} * {times}, 3)::DOUBLE)::VARCHAR"


def _shape_sql(team: str, suffix: str) -> str:
    a, b, c, d = (_side(f"{n}{suffix}", t) for n, t in (("x1", 1280), ("y1", 720), ("x2", 1280), ("y2", 720)))
    return (
        "concat('{\"label\":\"player\",\"description\":null,\"points\":[[', " + f"{a}, ',', {b}, '],[', {c}, ',', {b}, '],[', {c}, ',', {d}, '],[', {a}, ',', {d}"
        + ", ']],\"group_id\":', person_id, ',\"difficult\":false,\"direction\":0,\"shape_type\":\"rectangle\",\"flags\":{\"visibility\":1.0,\"class_id\":1},'"
        + f", '\"attributes\":{{\"team\":\"{team}\",\"action\":', to_json(coalesce(action_name, '')), '}}}}')"
    )


QUERIES = {
    "hhi_sport": (
        lambda v: named(v)
        .groupBy("action_id", "action_name", "sport")
        .agg(F.count(F.lit(1)).alias("rows")),
        NAMED + " SELECT action_id, action_name, sport, count(*) AS rows FROM n GROUP BY ALL",
    ),
    "hhi_profile": (
        lambda v: I.profile(v.interactions()),
        ROWS
        + """ SELECT count(*) AS num_rows_total, count(*) FILTER (split = 'train') AS num_rows_train, count(*) FILTER (split = 'val') AS num_rows_val,
 count(DISTINCT video_id) AS num_videos, count(DISTINCT action_id) AS num_action_ids_present, count(DISTINCT person_id) AS num_person_ids,
 count(DISTINCT instance_id) AS num_instances FROM fx_interactions""",
    ),
    "hhi_action_counts": (
        lambda v: I.action_counts(named(v)),
        NAMED
        + " SELECT coalesce(action_name, '<unknown>') AS action_name, count(*) AS count, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val FROM n GROUP BY 1",
    ),
    "hhi_sport_counts": (
        lambda v: I.sport_counts(named(v)),
        NAMED + " SELECT coalesce(sport, '<unknown>') AS sport, count(*) AS count FROM n GROUP BY 1",
    ),
    "hhi_top_per_sport": (
        lambda v: I.top_per_sport(named(v), 2).select("sport", "action_name", "count"),
        NAMED
        + """ SELECT sport, action_name, count FROM (SELECT sport, action_name, count(*) AS count FROM n WHERE sport IS NOT NULL GROUP BY ALL)
 QUALIFY row_number() OVER (PARTITION BY sport ORDER BY count DESC, action_name) <= 2""",
    ),
    "hhi_bbox": (lambda v: I.box_summary(two_boxes(v)), TWO + box_sql("")),
    "hhi_bbox_second": (lambda v: I.box_summary(two_boxes(v), "_2"), TWO + box_sql("_2")),
    "hhi_anomalies": (
        lambda v: I.box_anomalies(two_boxes(v)),
        TWO + f" SELECT {anomalies_sql('')} FROM two",
    ),
    "hhi_anomalies_second": (
        lambda v: I.box_anomalies(two_boxes(v), "_2"),
        TWO + f" SELECT {anomalies_sql('_2')} FROM two",
    ),
    "hhi_dups": (
        lambda v: I.duplicate_rows(v.interactions(), DUP_KEY),
        ROWS
        + f" SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(DUP_KEY)} FROM fx_interactions))) AS duplicate_rows FROM fx_interactions",
    ),
    "hhi_unknown": (
        lambda v: I.unknown_ids(v.interactions(), v.action_list()),
        NAMED + " SELECT count(*) AS unknown_action_id_rows FROM n WHERE action_name IS NULL",
    ),
    "hhi_tube_lengths": (
        lambda v: I.tube_lengths(v.interactions(), v.action_list()),
        lengths_sql(
            NAMED
            + """, g AS (SELECT coalesce(action_name, action_id::VARCHAR) AS action, count(*) AS length FROM n
 WHERE action_id IS NOT NULL AND instance_id IS NOT NULL GROUP BY video_id, instance_id, coalesce(action_name, action_id::VARCHAR))""",
            "SELECT action, length FROM g UNION ALL SELECT '__all__', length FROM g",
        ),
    ),
    "label_subset": (
        lambda v: I.keep_actions(v.interactions(), I.label_subset(v.action_list()))
        .join(I.label_subset(v.action_list()).select("action_id", "new_id"), "action_id")
        .select("video_id", "frame_id", "action_id", "new_id"),
        NAMED
        + """ SELECT video_id, frame_id, action_id, new_id FROM n JOIN (SELECT action_id, row_number() OVER (ORDER BY action_id) - 1 AS new_id
 FROM fx_action_list WHERE lower(action_name) LIKE 'basketball%') USING (action_id)""",
    ),
    "proposal_semi": (
        _proposals,
        NAMED
        + " SELECT DISTINCT concat(video_id, ',', frame_id) AS key FROM n WHERE lower(action_name) LIKE 'volleyball%'",
    ),
    "hhi_stack": (
        lambda v: I.stack_boxes(two_boxes(v)).select(
            "video_id", "frame_id", "action_id", "team", "x1", "y1", "x2", "y2"
        ),
        TWO
        + """ SELECT video_id, frame_id, action_id, '0' AS team, x1, y1, x2, y2 FROM two
 UNION ALL SELECT video_id, frame_id, action_id, '1', x1_2, y1_2, x2_2, y2_2 FROM two WHERE x1_2 IS NOT NULL""",
    ),
    "hhi_shapes": (
        lambda v: I.pixel_shapes(I.stack_boxes(two_boxes(v)), F.lit(1280), F.lit(720)).select(
            "video_id", "frame_id", "action_id", "team", "points"
        ),
        TWO
        + """, s AS (SELECT video_id, frame_id, action_id, '0' AS team, x1, y1, x2, y2 FROM two
 UNION ALL SELECT video_id, frame_id, action_id, '1', x1_2, y1_2, x2_2, y2_2 FROM two WHERE x1_2 IS NOT NULL),
 r AS (SELECT *, round(x1 * 1280, 3) AS a, round(y1 * 720, 3) AS b, round(x2 * 1280, 3) AS c, round(y2 * 720, 3) AS d FROM s)
 SELECT video_id, frame_id, action_id, team, [[a, b], [c, b], [c, d], [a, d]] AS points FROM r""",
    ),
    "hhi_records": (
        interaction_texts,
        ctes("fx_frames", "fx_interactions", "fx_action_list")
        + f""", two AS (SELECT i.* EXCLUDE (x1_2), {SECOND}, action_name FROM fx_interactions i LEFT JOIN fx_action_list USING (action_id)),
 w AS (SELECT DISTINCT video_id, frame_id, frame_id::BIGINT AS n FROM fx_interactions),
 e AS (SELECT w.video_id, w.frame_id, image_name FROM w JOIN fx_frames f ON f.video_id = w.video_id AND frame_idx = n),
 l AS (SELECT w.video_id, w.frame_id, min(image_name) AS image_name FROM (SELECT * FROM w ANTI JOIN e USING (video_id, frame_id)) w
 JOIN fx_frames f ON f.video_id = w.video_id AND (contains(image_name, n::VARCHAR) OR contains(image_name, frame_id)) GROUP BY ALL),
 p AS (SELECT * FROM (SELECT * FROM e UNION SELECT * FROM l) QUALIFY row_number() OVER (PARTITION BY video_id, image_name ORDER BY frame_id DESC) = 1),
 s AS (SELECT video_id, frame_id, person_id, action_id, x1, y1, x2, y2, 0 AS team, {_shape_sql("0", "")} AS text FROM two
 UNION ALL SELECT video_id, frame_id, person_id, action_id, x1, y1, x2, y2, 1, {_shape_sql("1", "_2")} FROM two WHERE x1_2 IS NOT NULL)
 SELECT concat(video_id, '/', replace(image_name, '.jpg', '.json')) AS path, concat('{{"version":"2.5.4","flags":{{}},"shapes":[',
 string_agg(text, ',' ORDER BY person_id, action_id, x1, y1, x2, y2, team, text), '],"imagePath":"', image_name, '","imageData":null,"imageHeight":720,"imageWidth":1280}}') AS value
 FROM s JOIN p USING (video_id, frame_id) GROUP BY video_id, image_name""",
    ),
    "limit_frames": (
        lambda v: I.limit_frames(v.interactions(), 20, 15),
        ROWS
        + """ SELECT video_id, frame_id FROM (SELECT DISTINCT video_id, frame_id FROM fx_interactions)
 WHERE video_id IN (SELECT DISTINCT video_id FROM fx_interactions ORDER BY 1 LIMIT 20)
 QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY frame_id) <= 15""",
    ),
    "balanced": (
        lambda v: I.balanced_frames(named(v), ["person_id", "action_id"], 40),
        NAMED
        + """, f AS (SELECT video_id, frame_id, coalesce(arg_min(action_name, person_id * 100 + action_id) FILTER (action_name IS NOT NULL), '') AS action_name FROM n GROUP BY ALL)
 SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY action_name ORDER BY video_id, frame_id) <= 40""",
    ),
    "tube_explode": (
        lambda v: B.explode_tubes(B.nest(tube_boxes(v))),
        TUBE_SQL + " SELECT * FROM tubes",
    ),
    "tube_nest": (
        lambda v: B.nest(tube_boxes(v)).select(*B.TUBE, "part", F.size("rows").cast("bigint").alias("n")),
        TUBE_SQL
        + " SELECT video_id, class_id, tube_no, frame_idx // 512 AS part, count(*) AS n FROM tubes GROUP BY ALL",
    ),
    "tube_values": (
        lambda v: B.explode_tubes(B.nest(tube_boxes(v))),
        TUBE_SQL + " SELECT video_id, class_id, tube_no, frame_idx, x1, y1, x2, y2 FROM tubes",
    ),
    "video_table": (
        lambda v: B.video_table(v.frames()),
        ctes("fx_frames") + " SELECT video_id, max(frame_idx) AS nframes, 720 AS height, 1280 AS width FROM fx_frames GROUP BY 1",
    ),
    "tube_profile": (
        lambda v: B.overview(tube_boxes(v)),
        TUBE_SQL
        + """, g AS (SELECT count(*) AS length FROM tubes GROUP BY video_id, class_id, tube_no)
 SELECT count(*) AS boxes, """
        + ", ".join(
            f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in ("frame_idx", "x1", "y1", "x2", "y2")
        )
        + """, (SELECT count(*) FROM g) AS tubes, (SELECT max(length) FROM g) AS longest, (SELECT min(length) FROM g) AS shortest,
 count(DISTINCT video_id) AS videos, count(DISTINCT class_id) AS classes FROM tubes""",
    ),
    "tubes_per_label": (
        lambda v: B.tubes_per_label(tube_boxes(v)),
        TUBE_SQL
        + " SELECT video_id, class_id, count(DISTINCT tube_no) AS tubes FROM tubes GROUP BY ALL",
    ),
    "pkl_tube_lengths": (
        lambda v: B.lengths(tube_boxes(v), labels(v)),
        lengths_sql(
            TUBE_SQL
            + """, g AS (SELECT CASE class_id WHEN 0 THEN 'hold' WHEN 1 THEN 'pass' ELSE class_id::VARCHAR END AS action, count(*) AS length FROM tubes GROUP BY video_id, class_id, tube_no)""",
            "SELECT action, length FROM g UNION ALL SELECT '__all__', length FROM g",
        ),
    ),
    "bbox_order": (
        lambda v: _sizes(v).select(*B.TUBE, "width", "height", "box_order"),
        SIZES + " SELECT video_id, class_id, tube_no, width, height, box_order FROM sizes",
    ),
    "tube_class_profile": (
        lambda v: B.class_profile(_sizes(v)),
        SIZES
        + """, g AS (SELECT class_id, count(*) AS n FROM sizes GROUP BY video_id, class_id, tube_no),
 d AS (SELECT class_id, count(*) AS instances, round(avg(n), 2) AS duration_avg, sum(n)::BIGINT AS total_boxes FROM g GROUP BY 1)
 SELECT d.*, width_avg, width_max, width_min, height_avg, height_max, height_min FROM d JOIN (SELECT class_id, """
        + ", ".join(
            f"round(avg({c}), 2) AS {c}_avg, round(max({c}), 2) AS {c}_max, round(min({c}), 2) AS {c}_min"
            for c in ("width", "height")
        )
        + " FROM sizes GROUP BY 1) USING (class_id)",
    ),
    "tube_bbox_profile": (
        lambda v: B.box_profile(tube_boxes(v), resolution(v)),
        TUBE_SQL
        + ", nb AS (SELECT x2 / 1280 - x1 / 1280 AS w, y2 / 720 - y1 / 720 AS h FROM tubes)"
        + " UNION ALL ".join(
            f" SELECT {summary_sql(e, n)} FROM nb" for n, e in (("width", "w"), ("height", "h"), ("area", "(w * h)"))
        ),
    ),
    "tube_bbox_anomalies": (
        lambda v: B.box_anomalies(tube_boxes(v), resolution(v)),
        TUBE_SQL
        + """ SELECT count(*) FILTER (x2 / 1280 > 1 + 1e-6 OR x1 / 1280 > 1 + 1e-6 OR y2 / 720 > 1 + 1e-6 OR y1 / 720 > 1 + 1e-6) AS coords_out_of_range,
 count(*) FILTER (x2 <= x1) AS x1_ge_x2, count(*) FILTER (y2 <= y1) AS y1_ge_y2, count(*) AS num_boxes FROM tubes""",
    ),
    "tube_gap_segments": (
        lambda v: B.gap_segments(tube_boxes(v), 2),
        TUBE_SQL
        + """ SELECT video_id, class_id, tube_no, count(*) FILTER (p IS NULL OR frame_idx - p > 2) AS segments
 FROM (SELECT *, lag(frame_idx) OVER (PARTITION BY video_id, class_id, tube_no ORDER BY frame_idx) AS p FROM (SELECT DISTINCT video_id, class_id, tube_no, frame_idx FROM tubes)) GROUP BY ALL""",
    ),
    "tube_split_profile": (
        _split_profile,
        ctes("fx_frames")
        + """ SELECT CASE WHEN right(video_id, 1) < '8' THEN 'train' ELSE 'test' END AS split, '720x1280' AS resolution, count(*) AS videos, sum(nframes)::BIGINT AS frames
 FROM (SELECT video_id, max(frame_idx) AS nframes FROM fx_frames GROUP BY 1) GROUP BY 1""",
    ),
    "label_prefixes": (
        lambda v: B.label_prefixes(v.table("part"), "p_name"),
        "SELECT split_part(p_name, ' ', 1) AS prefix, count(DISTINCT p_name) AS labels FROM part GROUP BY 1",
    ),
    "tube_ids": (
        lambda v: B.global_ids(tube_boxes(v)),
        TUBE_SQL
        + " SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY class_id, tube_no) - 1 AS group_id FROM (SELECT DISTINCT video_id, class_id, tube_no FROM tubes)",
    ),
    "std_to_tubes": (_std_to_tubes, STD_TUBES),
    "tubes_to_std": (
        lambda v: B.to_shapes(
            tube_boxes(v).withColumns({c: F.col(c) / 7 for c in ("x1", "y1", "x2", "y2")}), labels(v), v.frames()
        ),
        ctes("fx_boxes", "fx_frames", extra=[TUBES])
        + """, r AS (SELECT t.*, image_name, round(x1 / 7, 3) AS a, round(y1 / 7, 3) AS b, round(x2 / 7, 3) AS c, round(y2 / 7, 3) AS d FROM tubes t JOIN fx_frames USING (video_id, frame_idx))
 SELECT video_id, frame_idx, image_name, CASE class_id WHEN 0 THEN 'hold' WHEN 1 THEN 'pass' ELSE class_id::VARCHAR END AS action,
 concat('c', class_id, '_t', tube_no) AS track_id, [[a, b], [c, b], [c, d], [a, d]] AS points FROM r""",
    ),
}
