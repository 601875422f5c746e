"""Rule-based cleaning: long or oversized tubes, listed tubes, name prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.functions.fields import matches_prefixes
from trackloom.operators.profile import size_thresholds
from trackloom.operators.tubes import KEY, tube_runs

# Actions whose tubes may be long.
LONG_ALLOWED = ("hold", "noball")


def judged_segments(
    boxes: DataFrame, sigma: float = 3.0, max_len: int = 64, exceptions=LONG_ALLOWED
) -> tuple[DataFrame, DataFrame]:
    """Tube frames (with the start of their segment) and segments with the reason to remove them.

    A segment goes for its length first, else when any of its boxes is wider or taller than
    mean + sigma deviations over all boxes of positive size.
    """
    limits = size_thresholds(boxes, sigma)
    w_limit, h_limit = (limits.select(f"{s}_threshold").scalar() for s in "wh")
    big = (F.col("x2") - F.col("x1") > w_limit) | (F.col("y2") - F.col("y1") > h_limit)
    runs = tube_runs(
        boxes.withColumn("big", F.coalesce(big, F.lit(False))), "auto", dedup=True, any_of=("big",)
    )
    allowed = [e.strip().lower() for e in exceptions]
    too_long = (F.col("length") > max_len) & ~F.lower("action").isin(allowed)
    segments = (
        runs.groupBy(*KEY, F.col("head").alias("start_f"))
        .agg(
            F.max("frame_idx").alias("end_f"),
            F.count(F.lit(1)).alias("length"),
            F.bool_or("big").alias("big"),
        )
        .withColumn("reason", F.when(too_long, "length").when(F.col("big"), "bigbox"))
    )
    return runs.select(*KEY, "frame_idx", F.col("head").alias("start_f")), segments


def clean_boxes(
    boxes: DataFrame, sigma: float = 3.0, max_len: int = 64, exceptions=LONG_ALLOWED, bare: DataFrame | None = None
) -> DataFrame:
    """Boxes that survive the length and size rules; shapes without a box are dropped.

    The rules are applied in frame 0 too, where the copied rule skipped it by accident. The
    frames of removed segments are known from segmentation, so removal is an equi-join. ``bare`` are the same boxes before
    they were dealt or numbered, where the caller has them; segments are judged on those.
    """
    frames, segments = judged_segments(boxes if bare is None else bare, sigma, max_len, exceptions)
    doomed = segments.where(F.col("reason").isNotNull()).select(*KEY, "start_f")
    removed = frames.join(doomed, [*KEY, "start_f"], "left_semi").select(*KEY, "frame_idx")
    return boxes.where(F.col("x1").isNotNull()).join(removed, [*KEY, "frame_idx"], "left_anti")


def clean_summary(
    boxes: DataFrame, sigma: float = 3.0, max_len: int = 64, exceptions=LONG_ALLOWED
) -> DataFrame:
    """Segments by outcome and boxes before and after cleaning, one row."""
    _frames, segments = judged_segments(boxes, sigma, max_len, exceptions)
    outcome = segments.agg(
        F.count(F.lit(1)).alias("num_segments_total"),
        F.count_if(F.col("reason") == "length").alias("removed_by_length"),
        F.count_if(F.col("reason") == "bigbox").alias("removed_by_bigbox"),
        F.count_if(F.col("reason").isNull()).alias("kept_segments"),
    )
    before = boxes.agg(F.count(F.lit(1)).alias("n"))
    after = clean_boxes(boxes, sigma, max_len, exceptions).agg(F.count(F.lit(1)).alias("n"))
    return outcome.select(
        "*", before.scalar().alias("shapes_before"), after.scalar().alias("shapes_after")
    )


def remove_tubes(boxes: DataFrame, listed: DataFrame, track: str = "track_id") -> DataFrame:
    """Boxes whose (video, track) is not listed; a box without a track id stays."""
    gone = listed.select("video_id", F.col("track_id").alias(track)).distinct()
    return boxes.join(gone, ["video_id", track], "left_anti")


def remove_tubes_summary(boxes: DataFrame, listed: DataFrame) -> DataFrame:
    """Samples, frames and shapes before and after; frames left empty are not written."""
    kept = remove_tubes(boxes, listed)

    def counts(df: DataFrame, when: str) -> DataFrame:
        per_frame = df.groupBy("video_id", "frame_idx").agg(F.count(F.lit(1)).alias("n"))
        return per_frame.agg(
            F.count(F.lit(1)).alias(f"frames_{when}"),
            F.coalesce(F.sum("n"), F.lit(0)).alias(f"shapes_{when}"),
        )

    samples = boxes.select("video_id").distinct()
    affected = samples.join(listed.select("video_id"), "video_id", "left_semi")
    after = counts(kept, "after")
    return counts(boxes, "before").select(
        "*",
        after.select("frames_after").scalar().alias("frames_after"),
        after.select("shapes_after").scalar().alias("shapes_after"),
        samples.agg(F.count(F.lit(1))).scalar().alias("samples"),
        affected.agg(F.count(F.lit(1))).scalar().alias("affected_samples"),
    )


def filter_samples(samples: DataFrame, include: list[str], exclude: list[str]) -> DataFrame:
    """Samples with whether their name passes the prefix lists."""
    return samples.withColumn("kept", matches_prefixes(F.col("video_id"), include, exclude))
