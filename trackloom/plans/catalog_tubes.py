"""Registered tube queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackloom.operators import tubes as T
from trackloom.plans.catalog_overlap import summary_sql
from trackloom.plans.fixtures import Views, ctes

KEY = "video_id, track_id, action"


def mode_sql(keys: str, rows: str) -> str:
    """Most frequent positive step per key, the smaller one on ties."""
    return (
        f"SELECT {keys}, stride FROM (SELECT {keys}, stride, count(*) AS c FROM"
        f" (SELECT {keys}, frame_idx - lag(frame_idx) OVER (PARTITION BY {keys} ORDER BY frame_idx) AS stride"
        f" FROM (SELECT DISTINCT {keys}, frame_idx FROM {rows})) WHERE stride > 0 GROUP BY ALL)"
        f" QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY c DESC, stride) = 1"
    )


STRIDE = ("stride", mode_sql("video_id", "fx_boxes"))
IN_TUBE = "track_id <> '' AND action <> ''"


def segments_ctes(name: str, rows: str, stride: str, op: str = "<>") -> list[tuple[str, str]]:
    """Segment view ``name`` over ``rows`` (KEY, frame_idx, ord); ``stride`` is an expression."""
    return [
        (
            f"{name}_b",
            f"SELECT r.*, CASE WHEN lag(frame_idx) OVER w IS NULL OR frame_idx - lag(frame_idx) OVER w {op} {stride} THEN 1 ELSE 0 END AS brk"
            f" FROM ({rows}) r WINDOW w AS (PARTITION BY {KEY} ORDER BY frame_idx, ord)",
        ),
        (
            f"{name}_s",
            f"SELECT *, sum(brk) OVER (PARTITION BY {KEY} ORDER BY frame_idx, ord ROWS UNBOUNDED PRECEDING) - 1 AS run_no FROM {name}_b",
        ),
        (
            name,
            f"SELECT {KEY}, run_no, min(frame_idx) AS start_f, max(frame_idx) AS end_f, count(*) AS length FROM {name}_s GROUP BY ALL",
        ),
    ]


ROWS = f"SELECT {KEY}, frame_idx, pos AS ord FROM fx_boxes WHERE {IN_TUBE}"
UNIQUE = f"SELECT DISTINCT {KEY}, frame_idx, 0 AS ord FROM fx_boxes WHERE {IN_TUBE}"
WITH_STRIDE = "SELECT r.*, stride FROM ({}) r JOIN stride USING (video_id)"
FIXED = ctes("fx_boxes", extra=segments_ctes("seg", ROWS, "1"))
AUTO = ctes("fx_boxes", extra=[STRIDE, *segments_ctes("seg", WITH_STRIDE.format(ROWS), "stride")])
DEDUP = ctes("fx_boxes", extra=[STRIDE, *segments_ctes("seg", WITH_STRIDE.format(UNIQUE), "stride")])
PER_KEY_STRIDE = ("kstride", mode_sql(KEY, f"({UNIQUE})"))
PER_KEY = ctes(
    "fx_boxes",
    extra=[
        PER_KEY_STRIDE,
        *segments_ctes(
            "seg",
            f"SELECT r.*, coalesce(stride, 1) AS stride FROM ({UNIQUE}) r LEFT JOIN kstride USING ({KEY})",
            "stride",
            ">",
        ),
    ],
)
GROUPED = f" SELECT {KEY}, start_f, end_f, length, count(*) AS n FROM seg GROUP BY ALL"

# Boxes in frames with an image; the step is the mode over those frames.
ANNOTATED = [
    (
        "img",
        "SELECT DISTINCT video_id, frame_idx FROM fx_frames",
    ),
    (
        "usable",
        f"SELECT * FROM fx_boxes WHERE {IN_TUBE} AND (video_id, frame_idx) IN (SELECT (video_id, frame_idx) FROM img)",
    ),
    ("astride", mode_sql("video_id", "usable")),
    *segments_ctes(
        "seg",
        f"SELECT u.{KEY.replace(', ', ', u.')}, u.frame_idx, u.pos AS ord, u.x1, u.y1, u.x2, u.y2, coalesce(stride, 1) AS stride FROM usable u LEFT JOIN astride USING (video_id)",
        "stride",
    ),
]
ANNOTATED_SQL = ctes("fx_boxes", "fx_frames", extra=ANNOTATED)
LENGTHS = f"SELECT action, length FROM seg UNION ALL SELECT '__all__', length FROM seg"


def annotated(v: Views):
    return T.annotated_rows(v.boxes(), v.frames(), v.bare_boxes())


def lengths_sql(head: str, rows: str = LENGTHS) -> str:
    columns = summary_sql("length", "x").split(",", 1)[1]
    return f"{head} SELECT action, {columns} FROM ({rows}) GROUP BY action"


def _equal(segments):
    """Equal segments of a tube as one row with their number."""
    return segments.groupBy(*T.KEY, "start_f", "end_f", "length").agg(F.sum("n").alias("n"))


def _stride(v: Views):
    return T.modal_stride(v.bare_boxes())


QUERIES = {
    "tube_stride": (
        _stride,
        ctes("fx_boxes", extra=[STRIDE]) + " SELECT * FROM stride",
    ),
    "tubes_fixed": (lambda v: _equal(T.tube_segments(v.bare_boxes(), "fixed")), FIXED + GROUPED),
    "tubes_auto": (lambda v: _equal(T.tube_segments(v.bare_boxes(), "auto")), AUTO + GROUPED),
    "tubes_dedup": (
        lambda v: _equal(T.tube_segments(v.bare_boxes(), "auto", dedup=True)),
        DEDUP + GROUPED,
    ),
    "tubes_gap": (
        lambda v: T.tube_segments(v.bare_boxes(), 1, dedup=True, break_if="gt")
        .groupBy(*T.KEY)
        .agg(F.sum("n").alias("split_tubes"))
        .groupBy("action")
        .agg(
            F.count(F.lit(1)).alias("original_tubes"),
            F.sum("split_tubes").alias("split_tubes"),
            (F.sum("split_tubes") - F.count(F.lit(1))).alias("diff"),
        ),
        ctes("fx_boxes", extra=segments_ctes("seg", UNIQUE, "1", ">"))
        + f""" SELECT action, count(*) AS original_tubes, sum(n)::BIGINT AS split_tubes, (sum(n) - count(*))::BIGINT AS diff
 FROM (SELECT {KEY}, count(*) AS n FROM seg GROUP BY ALL) GROUP BY action""",
    ),
    "gap_report": (
        lambda v: T.gap_report(v.bare_boxes()),
        PER_KEY
        + f""" SELECT video_id, count(*) AS num_pairs, sum(n)::BIGINT AS tubes_total, count(*) FILTER (n > 1) AS tubes_with_gaps
 FROM (SELECT {KEY}, count(*) AS n FROM seg GROUP BY ALL) GROUP BY video_id""",
    ),
    "gap_examples": (
        lambda v: T.gap_examples(v.bare_boxes(), 3),
        PER_KEY
        + f""" SELECT * FROM (SELECT {KEY}, sum(brk)::BIGINT AS segments, min(stride) AS local_stride, list(frame_idx ORDER BY frame_idx)[:20] AS frames
 FROM seg_s GROUP BY ALL HAVING sum(brk) > 1) QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY track_id, action) <= 3""",
    ),
    "tubes_annotated": (
        lambda v: T.annotated_rows(v.boxes(), v.frames(), v.bare_boxes()).select(
            *T.SEGMENT, "frame_idx", "pos", "stride", "x1"
        ),
        ANNOTATED_SQL
        + f" SELECT {KEY}, run_no::BIGINT AS run_no, frame_idx, ord AS pos, stride, x1 FROM seg_s",
    ),
    "tube_lengths": (
        lambda v: T.length_summary(T.tube_segments(v.bare_boxes(), "auto", dedup=True)),
        lengths_sql(DEDUP),
    ),
    "tube_outliers": (
        lambda v: T.length_outliers(T.tube_segments(v.bare_boxes(), "auto", dedup=True)).select(
            *T.KEY, "start_f", "end_f", "length", "side", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper")
        ),
        DEDUP
        + f""", q AS (SELECT action, quantile_cont(length, 0.25) AS q1, quantile_cont(length, 0.75) AS q3 FROM seg GROUP BY 1),
 f AS (SELECT action, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q),
 o AS (SELECT seg.*, round(lower, 6) AS lower, round(upper, 6) AS upper, CASE WHEN length < f.lower THEN 'low' WHEN length > f.upper THEN 'high' END AS side FROM seg JOIN f USING (action))
 SELECT {KEY}, start_f, end_f, length, side, lower, upper FROM o WHERE side IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY action, side ORDER BY CASE side WHEN 'low' THEN length ELSE -length END, video_id, track_id, start_f, end_f) <= 50""",
    ),
    "length_bins": (
        lambda v: T.length_bins(T.tube_segments(v.bare_boxes(), "auto")),
        AUTO
        + """ SELECT CASE WHEN b = 26 THEN '25+' ELSE b::VARCHAR END AS bin, count(length) AS count
 FROM range(1, 27) r(b) LEFT JOIN seg ON least(length, 26) = b GROUP BY ALL""",
    ),
    "time_bins": (
        lambda v: T.time_bins(T.tube_segments(v.bare_boxes(), "auto"), 0.2),
        AUTO
        + """ SELECT count(*) FILTER (length * 0.2::DOUBLE <= 0.5) AS le_half,
 count(*) FILTER (length * 0.2::DOUBLE > 0.5 AND length * 0.2::DOUBLE <= 1) AS half_to_one,
 count(*) FILTER (length * 0.2::DOUBLE > 1) AS over_one, count(*) AS num_tubes FROM seg""",
    ),
    "first_frame": (
        lambda v: T.first_boxes(annotated(v)),
        ANNOTATED_SQL
        + f""" SELECT {KEY}, frame_idx, x1, y1, x2, y2 FROM seg_s QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY frame_idx, ord) = 1""",
    ),
    "first_track_frames": (
        lambda v: T.first_track_frames(v.boxes(), "track_id"),
        ctes("fx_boxes")
        + """ SELECT video_id, track_id, frame_idx, x1, y1, x2, y2, concat(video_id, '_', track_id, '_', printf('%06d', frame_idx)) AS file_id
 FROM fx_boxes QUALIFY row_number() OVER (PARTITION BY video_id, track_id ORDER BY frame_idx, pos) = 1""",
    ),
    "tube_ref_box": (
        lambda v: T.reference_boxes(annotated(v)),
        ANNOTATED_SQL
        + f""" SELECT {KEY}, run_no::BIGINT AS run_no, frames, x1 AS ref_x1, y1 AS ref_y1, x2 AS ref_x2, y2 AS ref_y2
 FROM (SELECT *, count(*) OVER (PARTITION BY {KEY}, run_no) AS frames FROM seg_s)
 QUALIFY row_number() OVER (PARTITION BY {KEY}, run_no ORDER BY greatest(0.0, x2 - x1) * greatest(0.0, y2 - y1) DESC, frame_idx, ord) = 1""",
    ),
}
