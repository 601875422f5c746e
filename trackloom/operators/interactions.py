"""Interaction rows: one or two normalised boxes with action, person and instance ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions.fields import sport_of
from trackloom.functions.geometry import rect_points
from trackloom.operators.ordering import first_per_group
from trackloom.operators.quantiles import five_numbers
from trackloom.operators.tubes import length_summary

NO_NAME = "<unknown>"


def with_action_names(rows: DataFrame, actions: DataFrame) -> DataFrame:
    """Rows with ``action_name`` and ``sport`` (both null for an unknown id)."""
    names = actions.select(F.col("action_id").cast("bigint").alias("action_id"), "action_name")
    return rows.join(names, "action_id", "left").withColumn("sport", sport_of(F.col("action_name")))


def profile(rows: DataFrame) -> DataFrame:
    """Row and distinct-id counts, one row.

    Distinct ids are counted from the distinct (kind, id) pairs, which spread over tasks.
    """
    kinds = {
        "num_videos": F.col("video_id"),
        "num_action_ids_present": F.col("action_id").cast("string"),
        "num_person_ids": F.col("person_id").cast("string"),
        "num_instances": F.col("instance_id").cast("string"),
    }
    ids = rows.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("id")) for k, c in kinds.items()])).alias("p")
    ).select("p.kind", "p.id")
    distinct = ids.where(F.col("id").isNotNull()).distinct()
    found = distinct.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
    counts = rows.agg(
        F.count(F.lit(1)).alias("num_rows_total"),
        F.count_if(F.col("split") == "train").alias("num_rows_train"),
        F.count_if(F.col("split") == "val").alias("num_rows_val"),
    )
    return counts.select("*", *[found.select(k).scalar().alias(k) for k in kinds])


def action_counts(named: DataFrame) -> DataFrame:
    """Rows per action name, in all and per split."""
    name = F.coalesce("action_name", F.lit(NO_NAME)).alias("action_name")
    return named.groupBy(name).agg(
        F.count(F.lit(1)).alias("count"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "val").alias("val"),
    )


def sport_counts(named: DataFrame) -> DataFrame:
    return named.groupBy(F.coalesce("sport", F.lit(NO_NAME)).alias("sport")).agg(
        F.count(F.lit(1)).alias("count")
    )


def top_per_sport(named: DataFrame, k: int = 10) -> DataFrame:
    counts = (
        named.where(F.col("sport").isNotNull())
        .groupBy("sport", "action_name")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return first_per_group(counts, ["sport"], [F.desc("count"), F.col("action_name")], k)


def _sides(suffix: str) -> list[Column]:
    return [F.col(f"{c}{suffix}") for c in ("x1", "y1", "x2", "y2")]


def box_summary(rows: DataFrame, suffix: str = "") -> DataFrame:
    """Five-number summary of width, height and area as given (not clamped)."""
    x1, y1, x2, y2 = _sides(suffix)
    w, h = x2 - x1, y2 - y1
    return five_numbers(rows, [], {"width": w, "height": h, "area": w * h}, digits=9)


def box_anomalies(rows: DataFrame, suffix: str = "") -> DataFrame:
    """Out-of-range (nulls included), inverted and missing boxes, one row."""
    x1, y1, x2, y2 = _sides(suffix)
    inside = F.lit(True)
    missing = F.lit(False)
    for c in (x1, y1, x2, y2):
        inside = inside & F.coalesce(c.between(0, 1), F.lit(False))
        missing = missing | c.isNull()
    return rows.agg(
        F.count_if(~inside).alias("coords_out_of_range"),
        F.count_if(x1 >= x2).alias("x1_ge_x2"),
        F.count_if(y1 >= y2).alias("y1_ge_y2"),
        F.count_if(missing).alias("missing_values"),
        F.count_if(~missing).alias("num_boxes"),
    )


def duplicate_rows(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows that repeat an earlier row's key; nulls are equal to each other."""
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def unknown_ids(rows: DataFrame, actions: DataFrame) -> DataFrame:
    """Rows whose action id is null or not in the list."""
    known = actions.select(F.col("action_id").cast("bigint").alias("action_id"))
    return rows.join(known, "action_id", "left_anti").agg(
        F.count(F.lit(1)).alias("unknown_action_id_rows")
    )


def tube_lengths(rows: DataFrame, actions: DataFrame) -> DataFrame:
    """Length summary of (video, instance, action) groups; rows without either id are left out."""
    usable = rows.where(F.col("action_id").isNotNull() & F.col("instance_id").isNotNull())
    name = F.coalesce("action_name", F.col("action_id").cast("string"))
    tubes = (
        with_action_names(usable, actions)
        .groupBy("video_id", "instance_id", name.alias("action"))
        .agg(F.count(F.lit(1)).alias("length"))
    )
    return length_summary(tubes, weight=None)


def label_subset(actions: DataFrame, prefix: str = "basketball") -> DataFrame:
    """Actions whose name starts with the prefix (any case), with new ids from 0 in id order.

    The action list is a small vocabulary.
    """
    kept = actions.where(F.startswith(F.lower("action_name"), F.lit(prefix.lower())))
    numbered = first_per_group(
        kept.withColumn("_all", F.lit(0)), ["_all"], [F.col("action_id")], 2**31 - 1, "_n"
    )
    return numbered.select("action_id", "action_name", (F.col("_n") - 1).cast("bigint").alias("new_id"))


def keep_actions(rows: DataFrame, subset: DataFrame) -> DataFrame:
    """Rows of the subset's actions."""
    ids = subset.select(F.col("action_id").cast("bigint").alias("action_id"))
    return rows.join(ids, "action_id", "left_semi")


def keep_proposals(proposals: DataFrame, rows: DataFrame) -> DataFrame:
    """Proposals (key ``video,frame``) whose frame survives in ``rows``."""
    keyed = proposals.where(F.contains("key", F.lit(","))).withColumns(
        {
            "video_id": F.split_part("key", F.lit(","), F.lit(1)),
            "frame_id": F.regexp_replace("key", "^[^,]*,", ""),
        }
    )
    return keyed.join(rows.select("video_id", "frame_id"), ["video_id", "frame_id"], "left_semi").drop(
        "video_id", "frame_id"
    )


def stack_boxes(rows: DataFrame, secondary: bool = True) -> DataFrame:
    """One row per box: the first one as team 0, a complete second one as team 1."""

    def box(team: str, suffix: str) -> Column:
        sides = [c.alias(n) for c, n in zip(_sides(suffix), ("x1", "y1", "x2", "y2"))]
        return F.struct(F.lit(team).alias("team"), *sides)

    complete = F.lit(True)
    for c in _sides("_2"):
        complete = complete & c.isNotNull()
    boxes = F.array(box("0", ""))
    if secondary:
        boxes = F.when(complete, F.array(box("0", ""), box("1", "_2"))).otherwise(boxes)
    second = [f"{c}_2" for c in ("x1", "y1", "x2", "y2")]
    return (
        rows.withColumn("_b", F.explode(boxes))
        .drop("x1", "y1", "x2", "y2", *second)
        .select("*", "_b.*")
        .drop("_b")
    )


def pixel_shapes(stacked: DataFrame, width: Column, height: Column) -> DataFrame:
    """Stacked boxes with pixel corners (three decimals)."""
    x1, y1, x2, y2 = _sides("")
    return stacked.withColumn("points", rect_points(x1 * width, y1 * height, x2 * width, y2 * height))


def limit_frames(rows: DataFrame, videos: int | None = None, per_video: int | None = None) -> DataFrame:
    """Distinct frames of the first ``videos`` videos, at most ``per_video`` each, in name order."""
    frames = rows.select("video_id", "frame_id").distinct()
    if videos is not None:
        first = rows.select("video_id").distinct().orderBy("video_id").limit(videos)
        frames = frames.join(first, "video_id", "left_semi")
    if per_video is not None:
        frames = first_per_group(frames, ["video_id"], [F.col("frame_id")], per_video).drop("rn")
    return frames


def balanced_frames(named: DataFrame, order: list[str], per_action: int) -> DataFrame:
    """First ``per_action`` frames of each action by (video, frame).

    A frame's action is the first non-empty one among its rows in ``order``.
    """
    name = F.coalesce("action_name", F.lit(""))
    frames = named.groupBy("video_id", "frame_id").agg(
        F.coalesce(
            F.min_by(F.when(name != "", name), F.when(name != "", F.struct(*order))), F.lit("")
        ).alias("action_name")
    )
    by_name = [F.col("video_id"), F.col("frame_id")]
    return first_per_group(frames, ["action_name"], by_name, per_action).drop("rn")
