"""Dataset profile: distributions, box sizes, anomalies, resolutions, labels and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions.fields import UNKNOWN
from trackloom.operators.quantiles import five_numbers
from trackloom.operators.tubes import tube_segments

ALL = "__all__"


def named_action(name: str = "action", empty: str = UNKNOWN) -> Column:
    return F.when(F.col(name) == "", F.lit(empty)).otherwise(F.col(name))


def distribution(df: DataFrame, column: Column, name: str) -> DataFrame:
    """Count per value, most frequent first, then by value."""
    return (
        df.groupBy(column.alias(name))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), name)
    )


def action_distribution(boxes: DataFrame) -> DataFrame:
    return distribution(boxes, named_action(), "action")


def top_k(df: DataFrame, column: Column, name: str, k: int) -> DataFrame:
    """First ``k`` rows of the distribution (kept per task, then merged)."""
    return distribution(df, column, name).limit(k)


def size(name: str) -> Column:
    """Image side, at least 1; a missing one counts as 1."""
    return F.greatest(F.coalesce(F.col(name), F.lit(0)), F.lit(1))


def box_sizes() -> dict[str, Column]:
    """Width, height and area relative to the image; negative sides count as 0."""
    zero = F.lit(0.0)
    w = F.greatest(zero, F.col("x2") - F.col("x1"))
    h = F.greatest(zero, F.col("y2") - F.col("y1"))
    return {
        "width": w / size("img_w"),
        "height": h / size("img_h"),
        "area": (w * h) / (size("img_w") * size("img_h")),
    }


def anomaly_tests() -> dict[str, Column]:
    w, h = size("img_w"), size("img_h")
    inside = (
        F.col("x1").between(0, w)
        & F.col("x2").between(0, w)
        & F.col("y1").between(0, h)
        & F.col("y2").between(0, h)
    )
    return {
        "coords_out_of_range": ~inside,
        "x1_ge_x2": F.col("x1") >= F.col("x2"),
        "y1_ge_y2": F.col("y1") >= F.col("y2"),
        "size_missing": F.coalesce(F.col("img_w"), F.lit(0)) <= 0,
    }


def anomalies(boxes: DataFrame) -> DataFrame:
    """Boxes out of the image, inverted or empty ones, and boxes without an image size.

    ``missing_values`` counts shapes whose points gave no box (all four coordinates null).
    """
    counts = [F.count_if(F.coalesce(t, F.lit(False))).alias(n) for n, t in anomaly_tests().items()]
    return boxes.agg(*counts, F.count_if(F.col("x1").isNull()).alias("missing_values"))


def resolutions(frames: DataFrame) -> DataFrame:
    """Frames per ``WxH``."""
    text = F.concat(size("img_w").cast("string"), F.lit("x"), size("img_h").cast("string"))
    return distribution(frames, text, "resolution")


def image_sizes(frames: DataFrame) -> DataFrame:
    return five_numbers(
        frames, [], {"width_px": size("img_w"), "height_px": size("img_h")}, discrete=True
    )


def tubes_per_action(segments: DataFrame) -> DataFrame:
    return segments.groupBy("action").agg(F.sum("n").alias("tubes")).orderBy(F.desc("tubes"), "action")


def shapes_without_track(boxes: DataFrame) -> DataFrame:
    """Boxes left out of tubes because no track id is set."""
    missing = F.coalesce(F.col("track_id"), F.lit("")) == ""
    return boxes.agg(F.count_if(missing).alias("ignored_shapes_without_id"))


def analyze(boxes: DataFrame, frames: DataFrame) -> DataFrame:
    """Per-video profile and its total (video ``__all__``)."""
    tests = {n: F.coalesce(t, F.lit(False)) for n, t in anomaly_tests().items()}
    per_action = boxes.groupBy("video_id", named_action().alias("action"), "frame_idx").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(t).alias(name) for name, t in tests.items()]
    )
    sums = ["n", *tests]
    per_frame = per_action.groupBy("video_id", "frame_idx").agg(*[F.sum(c).alias(c) for c in sums])
    per_video = per_frame.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("frames_with_annotations"), *[F.sum(c).alias(c) for c in sums]
    )
    images = frames.groupBy("video_id").agg(
        F.count_if(F.lower("image_name").rlike("\\.jpe?g$")).alias("num_images")
    )
    tubes = (
        tube_segments(boxes, "fixed").groupBy("video_id").agg(F.sum("n").alias("tubes_total"))
    )
    parts = ["frames_with_annotations", *sums, "num_images", "tubes_total"]
    joined = per_video.join(images, "video_id", "left").join(tubes, "video_id", "left")
    counts = joined.rollup("video_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in parts]
    )
    labels = (
        per_action.select("video_id", "action")
        .distinct()
        .rollup("video_id")
        .agg(F.count_distinct("action").alias("num_action_labels"))
    )
    name = F.coalesce("video_id", F.lit(ALL)).alias("video_id")
    return (
        counts.select(name, *parts)
        .join(labels.select(name, "num_action_labels"), "video_id")
        .withColumnRenamed("n", "num_boxes")
    )


def majority_label(boxes: DataFrame, empty: str = "unknown") -> DataFrame:
    """Most frequent action of each video; ties go to the one met first."""
    named = F.trim(F.coalesce(F.col("action"), F.lit("")))
    label = F.when(named == "", F.lit(empty)).otherwise(named)
    counts = boxes.groupBy("video_id", label.alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("frame_idx", "pos")).alias("at")
    )
    best = F.struct(F.col("n"), -F.col("at.frame_idx"), -F.col("at.pos"))
    return counts.groupBy("video_id").agg(F.max_by("label", best).alias("label"))


def last_frames(frames: DataFrame) -> DataFrame:
    """Largest frame number of each video, 0 when none can be read."""
    return frames.groupBy("video_id").agg(
        F.greatest(F.coalesce(F.max("frame_idx"), F.lit(0)), F.lit(0)).alias("nframes")
    )


def size_thresholds(boxes: DataFrame, sigma: float = 3.0) -> DataFrame:
    """Mean, population deviation and limit of width and height over boxes of positive size."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    stats = boxes.where((w > 0) & (h > 0)).agg(
        *[
            F.coalesce(f(v), F.lit(0.0)).alias(f"{n}_{m}")
            for n, v in (("w", w), ("h", h))
            for m, f in (("mean", F.avg), ("std", F.stddev_pop))
        ]
    )
    return stats.select(
        "*",
        *[
            (F.col(f"{n}_mean") + sigma * F.col(f"{n}_std")).alias(f"{n}_threshold")
            for n in ("w", "h")
        ],
    )


def prediction_ratio(
    predictions: DataFrame, frames: DataFrame, label: str = "non_tactical"
) -> DataFrame:
    """Share of frames with ``label`` per sample: frames from the manifest, hits from predictions."""
    hits = (
        predictions.where(F.trim("id") != "")
        .where(F.trim("label_name") == label)
        .groupBy(F.split_part(F.trim("id"), F.lit("/"), F.lit(1)).alias("sample"))
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    totals = frames.groupBy(F.col("video_id").alias("sample")).agg(
        F.count(F.lit(1)).alias("total_frames")
    )
    hit = F.coalesce("hits", F.lit(0))
    return totals.join(hits, "sample", "left").select(
        "sample",
        "total_frames",
        hit.cast("bigint").alias("non_tactical_frames"),
        F.round(hit / F.col("total_frames"), 6).alias("non_tactical_ratio"),
    )


def samples_without(
    predictions: DataFrame, frames: DataFrame, label: str = "non_tactical"
) -> DataFrame:
    """Samples that have no frame with ``label``."""
    with_label = predictions.where(F.trim("label_name") == label).select(
        F.split_part(F.trim("id"), F.lit("/"), F.lit(1)).alias("sample")
    )
    samples = frames.select(F.col("video_id").alias("sample")).distinct()
    return samples.join(with_label.distinct(), "sample", "left_anti")


def game_count(files: DataFrame, column: str = "path") -> DataFrame:
    """Distinct game ids: file stem without its last three characters."""
    from trackloom.functions.fields import stem

    name = stem(F.col(column))
    game = F.substring(name, F.lit(1), F.greatest(F.length(name) - 3, F.lit(0)))
    return files.agg(F.count_distinct(game).alias("games"))
