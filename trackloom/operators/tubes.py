"""Tubes: runs of one (video, track, action) over frame numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions.fields import pad_number, stride_rule
from trackloom.operators.ordering import (
    distinct_diffs,
    first_per_group,
    frame_chunk,
    frame_words,
    has_frame,
    label_runs,
    word_diffs,
)
from trackloom.operators.quantiles import five_numbers

KEY = ["video_id", "track_id", "action"]
SEGMENT = [*KEY, "run_no"]


def in_tube(boxes: DataFrame) -> DataFrame:
    """Boxes that can belong to a tube: both the track id and the action are set."""
    return boxes.where((F.col("track_id") != "") & (F.col("action") != ""))


def _most_frequent(diffs: DataFrame, keys: list[str]) -> DataFrame:
    best = F.max_by("diff", F.struct(F.col("n"), -F.col("diff")))
    return diffs.groupBy(*keys).agg(best.alias("_mode"))


def modes(frames: DataFrame, keys: list[str]) -> DataFrame:
    """Most frequent step between neighbouring frames of each key; the smaller one on ties."""
    return _most_frequent(distinct_diffs(frames, keys, "frame_idx"), keys)


def shared_modes(boxes: DataFrame, images: DataFrame) -> DataFrame:
    """``modes`` of each video over the frames that have a box and are set in ``images`` (rows of ``frame_words``)."""
    both = F.transform(F.arrays_zip(F.col("_words").alias("a"), F.col("_own").alias("b")), lambda w: w["a"].bitwiseAND(w["b"]))
    own = frame_words(boxes).withColumnRenamed("_words", "_own")
    shared = images.join(own, ["video_id", "_chunk"]).select("video_id", "_chunk", both.alias("_words"))
    return _most_frequent(word_diffs(shared), ["video_id"])


def modal_stride(frames: DataFrame) -> DataFrame:
    """Step of each video: the mode, or the path rule when it has a single frame."""
    videos = frames.select("video_id").distinct()
    return videos.join(modes(frames, ["video_id"]), "video_id", "left").select(
        "video_id", F.coalesce("_mode", stride_rule(F.col("video_id"))).alias("stride")
    )


def _with_stride(rows: DataFrame, seen: DataFrame, stride: str | int) -> DataFrame:
    """Rows with the ``stride`` of their video or tube; modes are taken over the frames ``seen``."""
    rule = stride_rule(F.col("video_id"))
    if stride == "fixed":
        return rows.withColumn("stride", rule)
    if stride not in ("auto", "annotated", "per_key"):
        return rows.withColumn("stride", F.lit(int(stride)).cast("bigint"))
    keys = KEY if stride == "per_key" else ["video_id"]
    default = rule if stride == "auto" else F.lit(1).cast("bigint")
    return (
        rows.join(modes(seen, keys), keys, "left")
        .withColumn("stride", F.coalesce("_mode", default))
        .drop("_mode")
    )


def tube_runs(
    boxes: DataFrame,
    stride: str | int = "auto",
    dedup: bool = False,
    break_if: str = "ne",
    any_of: tuple[str, ...] = (),
) -> DataFrame:
    """One row per (video, track, action, frame) with its run.

    ``stride``: a number, ``fixed`` (path rule), ``auto`` (mode over all frames of the video),
    ``annotated`` (mode over the frames with a usable box, else 1) or ``per_key`` (mode over the
    tube's own frames, else 1).
    ``break_if``: ``ne`` breaks at any other step, ``gt`` only at larger ones.
    ``dedup`` counts copies of a key in a frame once; otherwise each further copy opens a tube.
    ``any_of`` names flags of the boxes to keep per frame (true when true for any box).
    """
    usable = in_tube(boxes)
    ends = [F.min("pos").alias("pos_first"), F.max("pos").alias("pos_last")]
    frames = usable.groupBy(*KEY, "frame_idx").agg(
        F.count(F.lit(1)).alias("copies"),
        *(ends if "pos" in boxes.columns else []),
        *[F.bool_or(c).alias(c) for c in any_of],
    )
    frames = _with_stride(frames, boxes if stride == "auto" else usable, stride)

    def breaks(prev: Column, cur: Column) -> Column:
        step = cur - prev
        return step > F.col("stride") if break_if == "gt" else step != F.col("stride")

    return label_runs(
        frames,
        KEY,
        "frame_idx",
        breaks,
        copies=None if dedup else "copies",
        constants=("stride",),
    )


def tube_segments(
    boxes: DataFrame,
    stride: str | int = "auto",
    dedup: bool = False,
    break_if: str = "ne",
) -> DataFrame:
    """Tube segments: (video, track, action, start_f, end_f, length, n).

    ``n`` counts equal one-frame segments made by copies of a key in one frame; all others
    have n = 1.
    """
    runs = tube_runs(boxes, stride, dedup, break_if)
    copies = F.lit(1) if dedup else F.col("copies")
    opened_here = F.col("brk") & (copies > 1)
    singles = F.when(copies > 1, copies - 2 + F.col("brk").cast("bigint")).otherwise(0)

    def part(use: Column, start: Column, single: bool, n: Column) -> Column:
        return F.when(
            use,
            F.struct(
                start.alias("start_f"), F.lit(single).alias("single"), n.cast("bigint").alias("n")
            ),
        )

    parts = F.array_compact(
        F.array(
            part(~opened_here, F.col("head"), False, F.lit(1)),
            part(copies > 1, F.col("tail"), False, F.lit(1)),
            part(singles > 0, F.col("frame_idx"), True, singles),
        )
    )
    return (
        runs.select(*KEY, "frame_idx", F.explode(parts).alias("p"))
        .groupBy(*KEY, F.col("p.start_f").alias("start_f"), F.col("p.single").alias("single"))
        .agg(
            F.max("frame_idx").alias("end_f"),
            F.count(F.lit(1)).alias("length"),
            F.max("p.n").alias("n"),
        )
        .select(*KEY, "start_f", "end_f", "length", "n")
    )


def annotated_rows(boxes: DataFrame, frames: DataFrame, bare: DataFrame | None = None) -> DataFrame:
    """Every usable box in a frame that has an image, with the segment it belongs to.

    Adds ``run_no`` (0-based per tube key), ``stride`` and ``start_f``. The stride is the mode
    over frames that have both an image and a usable box, else 1. Copies of a key in one frame follow each other
    with a step of 0, in the order of ``pos`` where boxes have it. Boxes meet the images of their chunk of frames as bits,
    the stride comes from such bits too, and runs are walked in the same chunks. ``bare`` are the same boxes before they
    were dealt or numbered, where the caller has them; the stride needs no more.
    """
    images = frame_words(frames)
    usable = (
        in_tube(boxes)
        .withColumn("_chunk", frame_chunk("frame_idx"))
        .join(images, ["video_id", "_chunk"])
        .where(has_frame(F.col("_words"), F.col("_chunk"), F.col("frame_idx")))
        .drop("_words", "_chunk")
    )
    # One row per video, so the boxes need not be dealt by video for it; no job runs while the query is built.
    steps = F.broadcast(shared_modes(in_tube(boxes if bare is None else bare), images))
    rows = usable.join(steps, "video_id", "left").withColumn(
        "stride", F.coalesce("_mode", F.lit(1).cast("bigint"))
    )
    runs = label_runs(
        rows.drop("_mode"),
        KEY,
        "frame_idx",
        lambda prev, cur: cur - prev != F.col("stride"),
        constants=("stride",),
        then=("pos",) if "pos" in boxes.columns else (),
    )
    return runs.withColumnRenamed("head", "start_f").drop("prev", "brk", "tail")


def annotated_segments(rows: DataFrame) -> DataFrame:
    """One row per segment of ``annotated_rows``."""
    return rows.groupBy(*SEGMENT).agg(
        F.min("frame_idx").alias("start_f"),
        F.max("frame_idx").alias("end_f"),
        F.count(F.lit(1)).alias("length"),
        F.sum("frame_idx").alias("frame_sum"),
        F.min("stride").alias("stride"),
    )


def with_overall(df: DataFrame, column: str, overall: str = "__all__") -> DataFrame:
    """Each row twice: under its own value of ``column`` and under ``overall``."""
    return df.withColumn(column, F.explode(F.array(F.col(column), F.lit(overall))))


def length_summary(segments: DataFrame, column: str = "action", weight: str | None = "n") -> DataFrame:
    """Count and five-number summary of lengths per value of ``column`` and overall."""
    return five_numbers(
        with_overall(segments, column),
        [column],
        {"length": F.col("length")},
        weight=F.col(weight) if weight else None,
        discrete=True,
    ).drop("metric")


def length_outliers(segments: DataFrame, k: int = 50) -> DataFrame:
    """Up to ``k`` shortest and longest segments per action beyond 1.5 interquartile ranges."""
    fences = (
        five_numbers(segments, ["action"], {"length": F.col("length")}, F.col("n"), True, digits=None)
        .withColumn("iqr", F.col("p75") - F.col("p25"))
        .select(
            "action",
            (F.col("p25") - 1.5 * F.col("iqr")).alias("lower"),
            (F.col("p75") + 1.5 * F.col("iqr")).alias("upper"),
        )
    )
    side = F.when(F.col("length") < F.col("lower"), "low").when(
        F.col("length") > F.col("upper"), "high"
    )
    flagged = (
        segments.join(fences, "action")
        .withColumn("side", side)
        .where(F.col("side").isNotNull())
    )
    extreme = F.when(F.col("side") == "low", F.col("length")).otherwise(-F.col("length"))
    order = [extreme, *[F.col(c) for c in ("video_id", "track_id", "start_f", "end_f")]]
    return first_per_group(flagged, ["action", "side"], order, k)


def length_bins(segments: DataFrame) -> DataFrame:
    """Segments per length: 1 to 25 one bin each, then ``25+``; empty bins are listed."""
    spark = segments.sparkSession
    label = F.when(F.col("length") >= 26, F.lit("25+")).otherwise(F.col("length").cast("string"))
    counts = segments.groupBy(label.alias("bin")).agg(F.sum("n").alias("n"))
    spine = spark.range(1, 27).select(
        F.when(F.col("id") == 26, F.lit("25+")).otherwise(F.col("id").cast("string")).alias("bin")
    )
    return spine.join(counts, "bin", "left").select(
        "bin", F.coalesce("n", F.lit(0)).cast("bigint").alias("count")
    )


def time_bins(segments: DataFrame, seconds_per_frame: float = 0.04) -> DataFrame:
    """Segments of at most half a second, up to one second, and longer."""
    seconds = F.col("length").cast("double") * F.lit(seconds_per_frame)

    def number(test: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n")).otherwise(0)), F.lit(0)).alias(name)

    return segments.agg(
        number(seconds <= 0.5, "le_half"),
        number((seconds > 0.5) & (seconds <= 1.0), "half_to_one"),
        number(seconds > 1.0, "over_one"),
        number(F.lit(True), "num_tubes"),
    )


def gap_report(boxes: DataFrame) -> DataFrame:
    """Per video: tube keys, segments under each key's own stride, and keys with a gap."""
    per_key = (
        tube_segments(boxes, "per_key", dedup=True, break_if="gt")
        .groupBy(*KEY)
        .agg(F.sum("n").alias("n"))
    )
    return per_key.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("num_pairs"),
        F.sum("n").alias("tubes_total"),
        F.count_if(F.col("n") > 1).alias("tubes_with_gaps"),
    )


def gap_examples(boxes: DataFrame, k: int = 20, shown: int = 20) -> DataFrame:
    """First ``k`` tube keys with a gap per video: their step and first ``shown`` frames."""
    runs = tube_runs(boxes, "per_key", dedup=True, break_if="gt")
    broken = (
        runs.groupBy(*KEY)
        .agg(F.count_if("brk").alias("segments"), F.min("stride").alias("local_stride"))
        .where(F.col("segments") > 1)
    )
    picked = first_per_group(broken, ["video_id"], [F.col("track_id"), F.col("action")], k).drop("rn")
    frames = runs.select(*KEY, "frame_idx").join(picked.select(*KEY), KEY, "left_semi")
    listed = (
        first_per_group(frames, KEY, [F.col("frame_idx")], shown)
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_list("frame_idx")).alias("frames"))
    )
    return picked.join(listed, KEY)


def first_boxes(rows: DataFrame) -> DataFrame:
    """First box of each tube key."""
    at = F.struct("frame_idx", "pos")
    return rows.groupBy(*KEY).agg(
        F.min("frame_idx").alias("frame_idx"),
        *[F.min_by(c, at).alias(c) for c in ("x1", "y1", "x2", "y2")],
    )


def first_track_frames(boxes: DataFrame, track: str = "group_id") -> DataFrame:
    """First frame and box of each (video, track), under the name that a classifier is given.

    A name reads ``<video>_<track>_<frame>`` with six digits; boxes without a track id are left out.
    """
    at = F.struct("frame_idx", "pos")
    known = boxes.where(F.coalesce(F.col(track), F.lit("")) != "")
    first = known.groupBy("video_id", F.col(track).alias("track_id")).agg(
        F.min("frame_idx").alias("frame_idx"), *[F.min_by(c, at).alias(c) for c in ("x1", "y1", "x2", "y2")]
    )
    name = F.concat_ws("_", "video_id", "track_id", pad_number(F.col("frame_idx"), 6))
    return first.select("*", name.alias("file_id"))


def reference_boxes(rows: DataFrame) -> DataFrame:
    """Largest box of each segment, the first one among equals."""
    area = F.greatest(F.lit(0.0), F.col("x2") - F.col("x1")) * F.greatest(
        F.lit(0.0), F.col("y2") - F.col("y1")
    )
    sides = ("x1", "y1", "x2", "y2")
    # One struct carries the sides along, so an order is kept and compared once and not for each of them.
    best = F.max(F.struct(area, -F.col("frame_idx"), -F.col("pos"), *sides)).alias("_best")
    found = rows.groupBy(*SEGMENT).agg(F.count(F.lit(1)).alias("frames"), best)
    return found.select(*SEGMENT, "frames", *[F.col(f"_best.{c}").alias(f"ref_{c}") for c in sides])


def segment_name() -> Column:
    """Name ``<video>__tid<track>__seg<nn>``."""
    return F.concat(
        F.col("video_id"),
        F.lit("__tid"),
        F.col("track_id"),
        F.lit("__seg"),
        pad_number(F.col("run_no"), 2),
    )
