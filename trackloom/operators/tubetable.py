"""Tube tables: one row per (video, class, tube, frame), and their nested form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions.geometry import rect_points
from trackloom.operators.ordering import label_runs, row_numbers
from trackloom.operators.quantiles import five_numbers
from trackloom.operators.tubes import SEGMENT, length_summary

TUBE = ["video_id", "class_id", "tube_no"]
PART_FRAMES = 512


def class_ids(rows: DataFrame) -> DataFrame:
    """Class ids of the actions met, in name order from 0 (a small vocabulary)."""
    names = rows.select("action").distinct()
    return row_numbers(names, [], [F.col("action")], F.left("action", F.lit(1)), "_n").select(
        "action", (F.col("_n") - 1).alias("class_id")
    )


def from_segments(rows: DataFrame) -> DataFrame:
    """Tube table of annotated rows.

    Tubes of a class are numbered by the first appearance of their track, then by segment.
    """
    first = F.min(F.struct("frame_idx", "pos")).alias("met")
    appearance = rows.groupBy("video_id", "track_id", "action").agg(first)
    segments = rows.select(*SEGMENT).distinct().join(appearance, ["video_id", "track_id", "action"])
    order = [F.col("met"), F.col("track_id"), F.col("run_no")]
    chunk = F.struct("met", "track_id", F.floor(F.col("run_no") / 1024))
    numbered = row_numbers(segments, ["video_id", "action"], order, chunk, "_n").join(
        class_ids(rows), "action"
    )
    return rows.join(
        numbered.select(*SEGMENT, "class_id", (F.col("_n") - 1).alias("tube_no")), SEGMENT
    ).select(*TUBE, "frame_idx", "pos", "x1", "y1", "x2", "y2")


def nest(tube_boxes: DataFrame) -> DataFrame:
    """Nested form: arrays of [frame, x1, y1, x2, y2] per tube.

    A tube has one box per frame and is cut into parts of a fixed span of frames, so a part is
    an array of bounded length however long the tube is.
    """
    row = F.array(
        F.col("frame_idx").cast("double"), *[F.col(c) for c in ("x1", "y1", "x2", "y2")]
    )
    part = F.floor(F.col("frame_idx") / PART_FRAMES).alias("part")
    return tube_boxes.groupBy(*TUBE, part).agg(F.sort_array(F.collect_list(row)).alias("rows"))


def explode_tubes(nested: DataFrame) -> DataFrame:
    """Tube table of the nested form: column 0 is the frame, the last four the box.

    Rows with fewer than five numbers are skipped.
    """
    row = F.col("_row")
    box = F.slice(row, -4, 4)
    return (
        nested.withColumn("_row", F.explode("rows"))
        .where(F.size("_row") >= 5)
        .select(
            *TUBE,
            row[0].cast("bigint").alias("frame_idx"),
            *[box[i].alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))],
        )
    )


def video_table(frames: DataFrame) -> DataFrame:
    """(video_id, nframes, height, width): the largest frame number and the size of the first image that has one, else 0."""
    sized = F.when((F.col("img_w") > 0) & (F.col("img_h") > 0), F.col("image_name"))
    return frames.groupBy("video_id").agg(
        F.greatest(F.coalesce(F.max("frame_idx"), F.lit(0)), F.lit(0)).alias("nframes"),
        F.coalesce(F.min_by("img_h", sized), F.lit(0)).alias("height"),
        F.coalesce(F.min_by("img_w", sized), F.lit(0)).alias("width"),
    )


def overview(tube_boxes: DataFrame) -> DataFrame:
    """Counts and value ranges of a tube table, one row."""
    tubes = tube_boxes.groupBy(*TUBE).agg(F.count(F.lit(1)).alias("length"))
    per_tube = tubes.agg(
        F.count(F.lit(1)).alias("tubes"),
        F.max("length").alias("longest"),
        F.min("length").alias("shortest"),
    )
    videos = tubes.select("video_id").distinct().agg(F.count(F.lit(1)).alias("n"))
    classes = tubes.select("class_id").distinct().agg(F.count(F.lit(1)).alias("n"))
    ranges = [
        f(c).alias(f"{c}_{n}")
        for c in ("frame_idx", "x1", "y1", "x2", "y2")
        for n, f in (("min", F.min), ("max", F.max))
    ]
    return tube_boxes.agg(F.count(F.lit(1)).alias("boxes"), *ranges).select(
        "*",
        *[per_tube.select(c).scalar().alias(c) for c in ("tubes", "longest", "shortest")],
        videos.scalar().alias("videos"),
        classes.scalar().alias("classes"),
    )


def lengths(tube_boxes: DataFrame, labels: DataFrame) -> DataFrame:
    """Length summary of tubes per class name and overall."""
    names = labels.select(F.col("label_id").cast("bigint").alias("class_id"), "label_name")
    tubes = (
        tube_boxes.groupBy(*TUBE)
        .agg(F.count(F.lit(1)).alias("length"))
        .join(names, "class_id", "left")
        .withColumn("action", F.coalesce("label_name", F.col("class_id").cast("string")))
    )
    return length_summary(tubes, weight=None)


def file_lengths(tubes: DataFrame) -> DataFrame:
    """``lengths`` of the tubes of several files (``path``), each with the label names of its own file."""
    each = tubes.groupBy("path", *TUBE, F.col("label_name").alias("action"))
    return length_summary(each.agg(F.count(F.lit(1)).alias("length")), weight=None)


def oriented_sizes(tube_boxes: DataFrame, columns: tuple[str, str, str, str]) -> DataFrame:
    """Widths and heights of four raw columns under the order inferred per tube.

    ``columns`` are the raw box columns in file order; order ``yx`` reads them as y1, x1, y2, x2.
    """
    c1, c2, c3, c4 = (F.col(c) for c in columns)
    wide, tall = c3 - c1, c4 - c2

    def good(size: Column) -> Column:
        return F.avg((size > 0).cast("double")) > 0.9

    a_ok = good(wide) & good(tall)
    per_tube = tube_boxes.groupBy(*TUBE).agg(
        a_ok.alias("a_ok"),
        (good(tall) & good(wide)).alias("b_ok"),
        (F.avg(wide) * F.avg(tall)).alias("a_size"),
        (F.avg(tall) * F.avg(wide)).alias("b_size"),
    )
    swap = F.col("b_ok") & (~F.col("a_ok") | (F.col("b_size") > F.col("a_size")))
    return tube_boxes.join(per_tube.select(*TUBE, swap.alias("_swap")), TUBE).select(
        *TUBE,
        F.when(F.col("_swap"), tall).otherwise(wide).alias("width"),
        F.when(F.col("_swap"), wide).otherwise(tall).alias("height"),
        F.when(F.col("_swap"), "yx").otherwise("xy").alias("box_order"),
    )


def class_profile(sizes: DataFrame) -> DataFrame:
    """Per class: tubes, mean length, boxes, and width and height average, largest, smallest."""
    per_tube = sizes.groupBy(*TUBE).agg(
        F.count(F.lit(1)).alias("n"),
        *[
            f(c).alias(f"{c}_{n}")
            for c in ("width", "height")
            for n, f in (("sum", F.sum), ("max", F.max), ("min", F.min))
        ],
    )
    return per_tube.groupBy("class_id").agg(
        F.count(F.lit(1)).alias("instances"),
        F.round(F.avg("n"), 2).alias("duration_avg"),
        F.sum("n").alias("total_boxes"),
        *[
            F.round(e, 2).alias(f"{c}_{n}")
            for c in ("width", "height")
            for n, e in (
                ("avg", F.sum(f"{c}_sum") / F.sum("n")),
                ("max", F.max(f"{c}_max")),
                ("min", F.min(f"{c}_min")),
            )
        ],
    )


def _normalised(boxes: DataFrame, resolution: DataFrame) -> DataFrame:
    """Boxes over the image size; the larger side is the width. Without a size they stay."""
    sized = boxes.join(
        resolution.select("video_id", F.col("height").alias("_a"), F.col("width").alias("_b")),
        "video_id",
        "left",
    ).withColumns({"_w": F.greatest("_a", "_b"), "_h": F.least("_a", "_b")})
    known = F.coalesce((F.col("_w") > 0) & (F.col("_h") > 0), F.lit(False))
    return sized.withColumn("_known", known).withColumns(
        {
            **{f"n_{c}": F.when(known, F.col(c) / F.col("_w")).otherwise(F.col(c)) for c in ("x1", "x2")},
            **{f"n_{c}": F.when(known, F.col(c) / F.col("_h")).otherwise(F.col(c)) for c in ("y1", "y2")},
        }
    )


def box_profile(tube_boxes: DataFrame, resolution: DataFrame) -> DataFrame:
    """Five-number summary of normalised width, height and area."""
    boxes = _normalised(tube_boxes, resolution)
    w, h = F.col("n_x2") - F.col("n_x1"), F.col("n_y2") - F.col("n_y1")
    return five_numbers(boxes, [], {"width": w, "height": h, "area": w * h})


def box_anomalies(tube_boxes: DataFrame, resolution: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Boxes out of the image (beyond the tolerance, where its size is known) and inverted ones."""
    outside = F.lit(False)
    for c in ("n_x1", "n_y1", "n_x2", "n_y2"):
        outside = outside | (F.col(c) < -tolerance) | (F.col(c) > 1 + tolerance)
    return _normalised(tube_boxes, resolution).agg(
        F.count_if(F.col("_known") & outside).alias("coords_out_of_range"),
        F.count_if(F.col("x2") - F.col("x1") <= 0).alias("x1_ge_x2"),
        F.count_if(F.col("y2") - F.col("y1") <= 0).alias("y1_ge_y2"),
        F.count(F.lit(1)).alias("num_boxes"),
    )


def tubes_per_label(tube_boxes: DataFrame) -> DataFrame:
    """Tubes per video and class."""
    return (
        tube_boxes.select(*TUBE)
        .distinct()
        .groupBy("video_id", "class_id")
        .agg(F.count(F.lit(1)).alias("tubes"))
    )


def label_prefixes(labels: DataFrame, name: str = "label_name") -> DataFrame:
    """Distinct labels by their first word."""
    return (
        labels.select(name)
        .distinct()
        .groupBy(F.split_part(name, F.lit(" "), F.lit(1)).alias("prefix"))
        .agg(F.count(F.lit(1)).alias("labels"))
    )


def split_profile(videos: DataFrame) -> DataFrame:
    """Per split and resolution: videos and frames. Input (split, nframes, height, width)."""
    text = F.concat_ws("x", F.col("height").cast("string"), F.col("width").cast("string"))
    return videos.groupBy("split", text.alias("resolution")).agg(
        F.count(F.lit(1)).alias("videos"), F.sum("nframes").alias("frames")
    )


def global_ids(tube_boxes: DataFrame) -> DataFrame:
    """Running tube id per video over (class, tube), from 0."""
    tubes = tube_boxes.select(*TUBE).distinct()
    order = [F.col("class_id"), F.col("tube_no")]
    chunk = F.struct("class_id", F.floor(F.col("tube_no") / 1024))
    return row_numbers(tubes, ["video_id"], order, chunk, "_n").select(
        *TUBE, (F.col("_n") - 1).alias("group_id")
    )


def to_shapes(tube_boxes: DataFrame, labels: DataFrame | None, frames: DataFrame) -> DataFrame:
    """Shapes of a tube table in the frames that have an image: corners, label and track id.

    Without ``labels`` the rows have a ``label_name`` of their own. Rows without a box are left out.
    """
    if labels is not None:
        names = labels.select(F.col("label_id").cast("bigint").alias("class_id"), "label_name")
        tube_boxes = tube_boxes.join(names, "class_id", "left")
    text = F.col("class_id").cast("string")
    return (
        tube_boxes.where(F.col("x1").isNotNull())
        .join(frames.select("video_id", "frame_idx", "image_name"), ["video_id", "frame_idx"])
        .select(
            "video_id",
            "frame_idx",
            "image_name",
            F.coalesce("label_name", text).alias("action"),
            F.concat(F.lit("c"), text, F.lit("_t"), F.col("tube_no").cast("string")).alias("track_id"),
            rect_points(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]).alias("points"),
        )
    )


def gap_segments(tube_boxes: DataFrame, tolerance: int = 1) -> DataFrame:
    """Segments per tube when a step larger than the tolerance splits it."""
    frames = tube_boxes.select(*TUBE, "frame_idx").distinct()
    runs = label_runs(frames, TUBE, "frame_idx", lambda prev, cur: cur - prev > tolerance)
    return runs.groupBy(*TUBE).agg(F.count_if(F.col("brk")).alias("segments"))
