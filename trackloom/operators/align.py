"""Two annotated datasets matched frame by frame from an alignment table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions.geometry import is_valid_box
from trackloom.operators.ordering import label_runs
from trackloom.operators.overlap import bin_counts, cross_pairs

# Alignment statuses that are used.
ALLOWED = ("ok", "no_below_threshold")
STEP = ["video_id", "t"]


def usable_alignment(
    alignment: DataFrame, allow: tuple[str, ...] = ALLOWED, video_id: str | None = None
) -> DataFrame:
    """Alignment rows of an allowed status whose two starts are given (0 means absent)."""
    rows = alignment.where(F.trim("status").isin(*allow) if allow else F.lit(True))
    if video_id:
        rows = rows.where(F.col("video_id") == video_id)
    return rows.where((F.coalesce("sh_index", F.lit(0)) != 0) & (F.coalesce("ms_index", F.lit(0)) != 0))


def common_index(ms_frames: DataFrame, sh_frames: DataFrame) -> DataFrame:
    """Smallest frame number that both datasets have, per video."""
    keys = ["video_id", "frame_idx"]
    both = ms_frames.select(*keys).join(sh_frames.select(*keys), keys, "left_semi")
    return both.groupBy("video_id").agg(F.min("frame_idx").alias("first_common"))


def _prefix(steps: DataFrame) -> DataFrame:
    """Steps t = 0, 1, ... of each video up to the first hole."""
    runs = label_runs(steps, ["video_id"], "t", lambda prev, cur: cur - prev != 1)
    return runs.where(F.col("head") == 0).select(*STEP)


def _steps(alignment: DataFrame, frames: DataFrame, start: str) -> DataFrame:
    """Frames at or after the start, counted from it."""
    return (
        frames.select("video_id", "frame_idx")
        .distinct()
        .join(alignment.select("video_id", start), "video_id")
        .select("video_id", (F.col("frame_idx") - F.col(start)).alias("t"))
        .where(F.col("t") >= 0)
    )


def common_run(
    alignment: DataFrame, ms_frames: DataFrame, sh_frames: DataFrame, max_frames: int | None = None
) -> DataFrame:
    """Steps (video_id, t, ms_idx, sh_idx) from the starts until either side has no frame."""
    both = _steps(alignment, ms_frames, "ms_index").join(
        _steps(alignment, sh_frames, "sh_index"), STEP
    )
    run = _prefix(both)
    if max_frames:
        run = run.where(F.col("t") < max_frames)
    starts = alignment.select("video_id", "ms_index", "sh_index")
    return run.join(starts, "video_id").select(
        *STEP,
        (F.col("ms_index") + F.col("t")).alias("ms_idx"),
        (F.col("sh_index") + F.col("t")).alias("sh_idx"),
    )


def run_boxes(run: DataFrame, boxes: DataFrame, side: str) -> DataFrame:
    """Valid boxes of one side at each step of the run, numbered as in their frame."""
    valid = boxes.where(is_valid_box()).withColumnRenamed("frame_idx", f"{side}_idx")
    return valid.join(run.select(*STEP, f"{side}_idx"), ["video_id", f"{side}_idx"])


def both_sides(ms: DataFrame, sh: DataFrame) -> DataFrame:
    """Steps where both sides have boxes, with their numbers."""
    n = F.count(F.lit(1))
    a = ms.groupBy(*STEP).agg(n.alias("ms_boxes"))
    b = sh.groupBy(*STEP).agg(n.alias("sh_boxes"))
    return a.join(b, STEP)


def step_pairs(ms: DataFrame, sh: DataFrame) -> DataFrame:
    """Pairs of boxes of the two sides with IoU > 0; side a is ms, side b is sh."""
    return cross_pairs(ms, sh, STEP)


def histogram(ms: DataFrame, sh: DataFrame) -> DataFrame:
    """Ten IoU bins over all cross pairs."""
    total = both_sides(ms, sh).agg(
        F.coalesce(F.sum(F.col("ms_boxes") * F.col("sh_boxes")), F.lit(0)).alias("n")
    )
    return bin_counts(step_pairs(ms, sh), total)


def best_matches(ms: DataFrame, sh: DataFrame) -> DataFrame:
    """Best IoU of every box towards the other side, 0 without a match.

    Only steps where both sides have boxes count. Columns: video_id, t, side, pos, best.
    """
    pairs = step_pairs(ms, sh)
    steps = both_sides(ms, sh).select(*STEP)

    def side(boxes: DataFrame, name: str, pos: str) -> DataFrame:
        best = pairs.groupBy(*STEP, F.col(pos).alias("pos")).agg(F.max("iou").alias("best"))
        return (
            boxes.select(*STEP, "pos")
            .join(steps, STEP, "left_semi")
            .join(best, [*STEP, "pos"], "left")
            .select(*STEP, F.lit(name).alias("side"), "pos", F.coalesce("best", F.lit(0.0)).alias("best"))
        )

    return side(ms, "ms", "a_pos").unionByName(side(sh, "sh", "b_pos"))


def match_summary(best: DataFrame, keys: list[str], thresholds=(0.5, 0.75)) -> DataFrame:
    """Boxes, mean best IoU and share at or above each threshold, both ways, per key."""
    aggs = []
    for side, name in (("ms", "ms_to_sh"), ("sh", "sh_to_ms")):
        mine = F.col("side") == side
        aggs.append(F.count_if(mine).alias(f"{side}_boxes"))
        aggs.append(F.round(F.avg(F.when(mine, F.col("best"))), 6).alias(f"mean_{name}"))
        for t in thresholds:
            hit = F.when(mine, (F.col("best") >= t).cast("double"))
            label = str(t).replace(".", "_")
            aggs.append(F.round(F.avg(hit), 6).alias(f"frac_{name}_{label}"))
    return best.groupBy(*keys).agg(*aggs)


def action_pairs(
    ms: DataFrame, sh: DataFrame, threshold: float = 0.5
) -> DataFrame:
    """Pairs above the threshold by (sh action, ms action)."""
    return (
        step_pairs(ms, sh)
        .where(F.col("iou") > threshold)
        .groupBy(F.col("b_action").alias("sh_action"), F.col("a_action").alias("ms_action"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def action_pair_ids(
    counts: DataFrame, sh_names: DataFrame | None = None, ms_names: DataFrame | None = None
) -> DataFrame:
    """The same counts by action ids: from the name tables, else from names that are numbers.

    Name tables have (label_name, label_id); pairs without both ids are left out.
    """

    def ids(df: DataFrame, side: str, names: DataFrame | None) -> DataFrame:
        action = F.col(f"{side}_action")
        digits = F.when(F.trim(action).rlike("^[0-9]+$"), F.trim(action)).try_cast("bigint")
        if names is None:
            return df.withColumn(f"{side}_id", digits)
        table = names.select(
            F.col("label_name").alias(f"{side}_action"), F.col("label_id").cast("bigint").alias("_id")
        )
        return (
            df.join(table, f"{side}_action", "left")
            .withColumn(f"{side}_id", F.coalesce("_id", digits))
            .drop("_id")
        )

    both = ids(ids(counts, "sh", sh_names), "ms", ms_names)
    pair = F.concat_ws("-", F.col("sh_id").cast("string"), F.col("ms_id").cast("string"))
    return (
        both.where(F.col("sh_id").isNotNull() & F.col("ms_id").isNotNull())
        .groupBy(pair.alias("pair"))
        .agg(F.sum("count").alias("count"))
    )


def pairs_over(
    ms: DataFrame, sh: DataFrame, threshold: float
) -> DataFrame:
    """Every pair above the threshold, one row each."""
    return step_pairs(ms, sh).where(F.col("iou") > threshold)


def first_high(
    ms: DataFrame, sh: DataFrame, threshold: float = 0.9
) -> DataFrame:
    """Pairs of the first step per video that has any IoU at or above the threshold."""
    high = step_pairs(ms, sh).where(F.col("iou") >= threshold)
    first = high.groupBy("video_id").agg(F.min("t").alias("t"))
    return high.join(first, STEP, "left_semi")


def endings(alignment: DataFrame, ms_frames: DataFrame, sh_frames: DataFrame) -> DataFrame:
    """Which side ends first per video, common length, own lengths and extra frames."""
    lengths = {}
    for side, frames in (("ms", ms_frames), ("sh", sh_frames)):
        run = _prefix(_steps(alignment, frames, f"{side}_index"))
        lengths[side] = run.groupBy("video_id").agg(F.count(F.lit(1)).alias(f"{side}_len"))
    present = ms_frames.select("video_id").intersect(sh_frames.select("video_id"))
    ms, sh = (F.coalesce(f"{s}_len", F.lit(0)).cast("bigint") for s in ("ms", "sh"))
    who = (
        F.when(ms < sh, "ms").when(sh < ms, "sh").when(ms == 0, "unknown").otherwise("tie")
    )
    return (
        alignment.select("video_id")
        .join(present, "video_id", "left_semi")
        .join(lengths["ms"], "video_id", "left")
        .join(lengths["sh"], "video_id", "left")
        .select(
            "video_id",
            who.alias("ends_first"),
            F.least(ms, sh).alias("common_len"),
            ms.alias("ms_len"),
            sh.alias("sh_len"),
            F.greatest(ms - sh, F.lit(0)).alias("ms_extra"),
            F.greatest(sh - ms, F.lit(0)).alias("sh_extra"),
        )
    )


def ending_counts(per_video: DataFrame) -> DataFrame:
    """Videos by longer side and number of extra frames; equal lengths are left out."""
    diff = F.abs(F.col("ms_len") - F.col("sh_len"))
    return (
        per_video.where(diff > 0)
        .groupBy(
            F.when(F.col("ms_len") > F.col("sh_len"), "ms").otherwise("sh").alias("who_more"),
            diff.alias("extra_frames"),
        )
        .agg(F.count(F.lit(1)).alias("count"))
    )


def ending_summary(per_video: DataFrame) -> DataFrame:
    return per_video.agg(
        F.count(F.lit(1)).alias("videos"),
        F.count_if(F.col("ends_first") == "ms").alias("ms_ends_first"),
        F.count_if(F.col("ends_first") == "sh").alias("sh_ends_first"),
        F.count_if(F.col("ends_first").isin("tie", "unknown")).alias("tie_or_unknown"),
        F.round(F.coalesce(F.avg("ms_extra"), F.lit(0.0)), 6).alias("avg_ms_extra"),
        F.round(F.coalesce(F.avg("sh_extra"), F.lit(0.0)), 6).alias("avg_sh_extra"),
    )


def mean_abs_diff(a: Column, b: Column) -> Column:
    """Mean absolute difference of two pixel arrays of equal length."""
    diffs = F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0), lambda s, x: s + x) / F.size(a)


def align_search(
    ms: DataFrame,
    sh: DataFrame,
    threshold: float,
    max_k: int | None = None,
    difference: Callable[[Column, Column], Column] = mean_abs_diff,
) -> DataFrame:
    """Offset of each video's first common sh frame in the ms frames.

    Inputs have (video_id, frame_idx, file, pixels) and, where the number of pixels does not
    tell the image size, ``dims``; null pixels mean that the image cannot be read. Images of
    another size are passed over. ``difference`` compares two pixel columns. Candidates are the ms frames from the first
    common number on, up to ``max_k`` later. The first one below the threshold wins, else the
    one with the smallest difference.

    Statuses: ok, no_below_threshold, no_match, sh_read_fail, no_common_index, missing_frames.
    Only the one reference frame of a video is joined to its candidates, and hits are found by
    map-side combined minima.
    """
    ms, sh = (
        d if "dims" in d.columns else d.withColumn("dims", F.size("pixels").cast("string"))
        for d in (ms, sh)
    )
    videos = ms.select("video_id").union(sh.select("video_id")).distinct()
    sides = (
        videos.join(ms.select("video_id").distinct().withColumn("_ms", F.lit(True)), "video_id", "left")
        .join(sh.select("video_id").distinct().withColumn("_sh", F.lit(True)), "video_id", "left")
    )
    first = common_index(ms, sh)
    reference = (
        sh.join(first, "video_id")
        .where(F.col("frame_idx") == F.col("first_common"))
        .groupBy("video_id")
        .agg(
            F.min("first_common").alias("sh_index"),
            F.min("file").alias("sh_file"),
            F.min_by("pixels", "file").alias("sh_pixels"),
            F.min_by("dims", "file").alias("sh_dims"),
        )
    )
    k = F.col("frame_idx") - F.col("sh_index")
    near = (k >= 0) & (k <= max_k) if max_k and max_k > 0 else k >= 0
    same_size = F.col("pixels").isNotNull() & (F.col("dims") == F.col("sh_dims"))
    scored = (
        ms.join(reference.where(F.col("sh_pixels").isNotNull()), "video_id")
        .where(near & same_size)
        .select("video_id", "frame_idx", "file", k.alias("k"), difference(F.col("pixels"), F.col("sh_pixels")).alias("mean"))
    )
    hit = F.col("mean") < threshold
    record = F.struct(F.col("frame_idx").alias("ms_index"), F.col("file").alias("ms_file"), "k", "mean")
    best = scored.groupBy("video_id").agg(
        F.min_by(record, F.when(hit, F.struct("k", "file"))).alias("hit"),
        F.min_by(record, F.struct("mean", "k", "file")).alias("near"),
        F.bool_or(hit).alias("has_hit"),
    )
    chosen = F.when(F.col("has_hit"), F.col("hit")).otherwise(F.col("near"))
    status = (
        F.when(F.col("_ms").isNull() | F.col("_sh").isNull(), "missing_frames")
        .when(F.col("sh_index").isNull(), "no_common_index")
        .when(F.col("sh_pixels").isNull(), "sh_read_fail")
        .when(F.col("near").isNull(), "no_match")
        .when(F.col("has_hit"), "ok")
        .otherwise("no_below_threshold")
    )
    return (
        sides.join(reference, "video_id", "left")
        .join(best, "video_id", "left")
        .select(
            "video_id",
            "sh_index",
            "sh_file",
            *[chosen[c].alias(c) for c in ("ms_index", "ms_file", "k", "mean")],
            status.alias("status"),
        )
    )


def merge_aligned(
    run: DataFrame, ms_boxes: DataFrame, sh_boxes: DataFrame, sh_sizes: DataFrame, ms_sizes: DataFrame
) -> DataFrame:
    """Shapes of both sides in the sh frame, ms boxes scaled to its size, with their source.

    Sizes are (video_id, frame_idx, img_w, img_h) of the frames; steps whose sh size is unknown
    are skipped, an unknown ms size counts as 1.
    """
    known = sh_sizes.where((F.col("img_w") > 0) & (F.col("img_h") > 0)).select(
        "video_id",
        F.col("frame_idx").alias("sh_idx"),
        F.col("img_w").alias("_w"),
        F.col("img_h").alias("_h"),
    )
    sized = run.join(known, ["video_id", "sh_idx"])
    columns = ["video_id", "sh_idx", "source", "pos", "track_id", "action", "x1", "y1", "x2", "y2"]
    sh = (
        sh_boxes.withColumnRenamed("frame_idx", "sh_idx")
        .join(sized.select("video_id", "sh_idx"), ["video_id", "sh_idx"], "left_semi")
        .withColumn("source", F.lit("SH"))
        .select(*columns)
    )
    ms_size = ms_sizes.select(
        "video_id",
        F.col("frame_idx").alias("ms_idx"),
        F.col("img_w").alias("_mw"),
        F.col("img_h").alias("_mh"),
    )
    scales = sized.join(ms_size, ["video_id", "ms_idx"], "left").select(
        "video_id",
        "ms_idx",
        "sh_idx",
        (F.col("_w") / F.greatest(F.coalesce("_mw", F.lit(1)), F.lit(1))).alias("sx"),
        (F.col("_h") / F.greatest(F.coalesce("_mh", F.lit(1)), F.lit(1))).alias("sy"),
    )
    ms = (
        ms_boxes.withColumnRenamed("frame_idx", "ms_idx")
        .join(scales, ["video_id", "ms_idx"])
        .withColumns({c: F.col(c) * F.col("sx") for c in ("x1", "x2")})
        .withColumns({c: F.col(c) * F.col("sy") for c in ("y1", "y2")})
        .withColumn("source", F.lit("MS"))
        .select(*columns)
    )
    return sh.unionByName(ms)

