"""Interaction rows as one record per frame, for the frames that a choice of limits leaves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions.fields import stem
from trackloom.operators.interactions import balanced_frames, limit_frames
from trackloom.sources.files import find_frames

SIDES = ("x1", "y1", "x2", "y2")
#: Columns that order the rows of a frame where the input gives no row number.
VALUE_ORDER = ["person_id", "action_id", "x1", "y1", "x2", "y2"]
#: What a written shape and record state besides the annotation.
RECORD_VERSION, SHAPE_LABEL = "2.5.4", "player"
WHOLE = {"ignoreNullFields": "false"}


def chosen_frames(
    named: DataFrame,
    order: list[str],
    only: list[str] | None = None,
    videos: int | None = None,
    per_video: int | None = None,
    per_action: int | None = None,
) -> DataFrame:
    """Distinct (video_id, frame_id) that are left of ``named``: a list of videos, then the first videos and the first
    frames of each by name, then the first frames of each action. Rows without a box count here too.
    """
    rows = named if only is None else named.where(F.col("video_id").isin(only))
    frames = limit_frames(rows, videos, per_video)
    if per_action is None:
        return frames
    left = rows.join(frames, ["video_id", "frame_id"], "left_semi")
    return balanced_frames(left, order, per_action).select("video_id", "frame_id")


def _shape_text(box: Column) -> Column:
    """Text of the shape of a box in pixels."""
    x1, y1, x2, y2 = (box[side] for side in SIDES)
    shape = F.struct(
        F.lit(SHAPE_LABEL).alias("label"),
        F.lit(None).cast("string").alias("description"),
        F.array(F.array(x1, y1), F.array(x2, y1), F.array(x2, y2), F.array(x1, y2)).alias("points"),
        box["person_id"].alias("group_id"),
        F.lit(False).alias("difficult"),
        F.lit(0).alias("direction"),
        F.lit("rectangle").alias("shape_type"),
        F.struct(F.lit(1.0).alias("visibility"), F.lit(1).alias("class_id")).alias("flags"),
        F.struct(box["team"].alias("team"), F.coalesce(box["action_name"], F.lit("")).alias("action")).alias("attributes"),
    )
    return F.to_json(shape, WHOLE)


def placed_frames(frames: DataFrame, images: DataFrame) -> DataFrame:
    """Rows of ``place_frames`` that have an image."""
    found = find_frames(frames, images.select("video_id", "image_name"))
    last = (
        found.where(F.col("image_name").isNotNull())
        .groupBy("image_name", "video_id")
        .agg(F.max("frame_id").alias("frame_id"))
    )
    sizes = images.groupBy("image_name", "video_id").agg(
        F.coalesce(F.max("width"), F.lit(0)).cast("int").alias("width"),
        F.coalesce(F.max("height"), F.lit(0)).cast("int").alias("height"),
    )
    return last.join(sizes, ["image_name", "video_id"]).select("video_id", "frame_id", "image_name", "width", "height")


def place_frames(frames: DataFrame, images: DataFrame) -> DataFrame:
    """(video_id, frame_id, image_name, width, height): the image of each frame, null where there is none.

    ``images`` has (video_id, image_name, width, height); an unknown size counts as 0. Of frames that name one image the
    last by frame id has it, and the others have none.
    """
    return frames.join(placed_frames(frames, images), ["video_id", "frame_id"], "left")


def frame_keys(rows: DataFrame) -> DataFrame:
    """Rows with frame ids of at least four digits; rows without a video or frame are left out."""
    padded = F.when(F.length("frame_id") >= 4, F.col("frame_id")).otherwise(F.lpad("frame_id", 4, "0"))
    return rows.where(F.col("video_id").isNotNull() & F.col("frame_id").isNotNull()).withColumn("frame_id", padded)


def record_texts(named: DataFrame, placed: DataFrame, order: list[str], secondary: bool = False) -> DataFrame:
    """(path, value): a record ``<video>/<stem>.json`` for every frame that has an image.

    ``named`` has the columns of interaction rows with ``action_name``; their boxes are shares of the image size. A row
    whose first box is incomplete gives no shape, as does an incomplete second box. Shapes stand in ``order``, a
    row's second box behind its first one. The shapes of a frame are one text, so a frame is the unit that is gathered; it
    is gathered as its rows are, and shapes are made of them where the text is.
    """
    whole = F.lit(True)
    for side in SIDES:
        whole = whole & F.col(side).isNotNull()
    places = placed.where(F.col("image_name").isNotNull())
    second = [f"{side}_2" for side in SIDES] if secondary else []
    kept = dict.fromkeys([*order, "person_id", "action_name", *SIDES, *second])
    gathered = (
        named.where(whole)
        .groupBy("frame_id", "video_id")
        .agg(F.collect_list(F.struct(*kept)).alias("_lines"))
        .join(places, ["frame_id", "video_id"])
    )

    def boxes(line: Column) -> Column:
        def box(team: str, suffix: str) -> Column:
            sides = zip(SIDES, ("width", "height", "width", "height"))
            pixels = [F.round(line[f"{side}{suffix}"] * F.col(size), 3).alias(side) for side, size in sides]
            first = [line[c].alias(f"_{c}") for c in order]
            return F.struct(*first, F.lit(team).alias("team"), line["person_id"].alias("person_id"), line["action_name"].alias("action_name"), *pixels)

        if not secondary:
            return F.array(box("0", ""))
        complete = F.lit(True)
        for side in second:
            complete = complete & line[side].isNotNull()
        return F.when(complete, F.array(box("0", ""), box("1", "_2"))).otherwise(F.array(box("0", "")))

    # Sides are rounded in a list of their own, so that each is rounded once; equal rows are put in order by their texts.
    # What orders the shapes is not a struct inside a struct, whose comparison is set up anew for every pair.
    keys = [*[f"_{c}" for c in order], "team"]
    made = F.transform(
        F.flatten(F.transform("_lines", boxes)), lambda b: F.struct(*[b[k].alias(k) for k in keys], _shape_text(b).alias("text"))
    )
    texts = F.array_join(F.transform(F.sort_array(made), lambda s: s["text"]), ",")
    head = F.struct(F.lit(RECORD_VERSION).alias("version"), F.create_map().cast("map<string,string>").alias("flags"))
    tail = F.struct(
        F.col("image_name").alias("imagePath"),
        F.lit(None).cast("string").alias("imageData"),
        F.col("height").alias("imageHeight"),
        F.col("width").alias("imageWidth"),
    )
    front, back = F.to_json(head, WHOLE), F.to_json(tail, WHOLE)
    return gathered.select(
        F.concat("video_id", F.lit("/"), stem(F.col("image_name")), F.lit(".json")).alias("path"),
        F.concat(
            F.left(front, F.length(front) - 1), F.lit(',"shapes":['), texts, F.lit("],"), F.right(back, F.length(back) - 1)
        ).alias("value"),
    )


def placement_summary(placed: DataFrame, records: DataFrame) -> DataFrame:
    """Frames chosen, records written, and frames without an image of their own, one row."""
    counts = placed.agg(
        F.count(F.lit(1)).alias("frames_chosen"), F.count_if(F.col("image_name").isNull()).alias("frames_without_image")
    )
    return counts.select("*", records.agg(F.count(F.lit(1))).scalar().alias("records"))
