"""Per-frame annotation records: read into boxes, written back as records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom import schema
from trackloom.functions.fields import action_of, frame_index, pad_number, track_of
from trackloom.functions.geometry import box_from_points, rect_points
from trackloom.functions.rows import once
from trackloom.operators.ordering import frame_chunk

# Records as maps, so that every key survives a rewrite.
RECORD = "map<string,variant>"
SHAPES = "array<map<string,variant>>"


def sample_of(path: Column) -> Column:
    """Sample name of a file path: its folder, or the folder above an ``img`` or ``json`` one."""
    return F.regexp_extract(path, "([^/]+)/(?:(?:img|json)/)?[^/]*$", 1)


def read_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """JSON files (one record each) as texts with their path."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .text(paths, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )


def read_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records (path and the four core fields) of JSON files; unreadable files are skipped."""
    return parse_text(read_texts(spark, paths))


def parse_text(texts: DataFrame, text: str = "value", path: str = "path") -> DataFrame:
    """Records from a column of JSON texts (one record each); broken texts are skipped."""
    whole = texts.where(F.try_parse_json(text).isNotNull())
    parsed = once(whole, _r=F.from_json(text, schema.LABELME, {"mode": "PERMISSIVE"}))
    return parsed.select(*[c for c in texts.columns if c != text], "_r.*")


def to_boxes(records: DataFrame, path: str = "path", index_rule: str = "suffix") -> DataFrame:
    """One row per shape of the records.

    Missing fields become empty text or zero. A shape whose points give no box keeps null
    coordinates. Frames whose name holds no number keep a null index here; see ``fill_index``.
    """
    file = F.col(path)
    # What a record's shapes share is worked out before they are listed.
    heads = once(records, _video=sample_of(file), _frame=frame_index(file, index_rule))
    return (
        heads.select(
            F.col("_video").alias("video_id"),
            F.col("_frame").alias("frame_idx"),
            file.alias("path"),
            F.coalesce("imagePath", F.lit("")).alias("image_path"),
            F.coalesce("imageWidth", F.lit(0)).alias("img_w"),
            F.coalesce("imageHeight", F.lit(0)).alias("img_h"),
            F.posexplode(F.coalesce("shapes", F.array().cast(schema.LABELME["shapes"].dataType))),
        )
        .withColumn("_box", box_from_points(F.col("col.points")))
        .select(
            "video_id",
            "frame_idx",
            "path",
            "image_path",
            (F.col("pos") + 1).cast("bigint").alias("pos"),
            F.coalesce(
                track_of(F.col("col.attributes"), F.col("col.flags"), F.col("col.group_id")), F.lit("")
            ).alias("track_id"),
            F.col("col.group_id").alias("group_id"),
            action_of(F.col("col.attributes"), F.col("col.flags")).alias("action"),
            F.coalesce("col.label", F.lit("")).alias("label"),
            "_box.x1",
            "_box.y1",
            "_box.x2",
            "_box.y2",
            "img_w",
            "img_h",
        )
    )


def frames_of(records: DataFrame, path: str = "path", index_rule: str = "suffix") -> DataFrame:
    """One row per record: (video_id, frame_idx, path, image_name, img_w, img_h)."""
    file = F.col(path)
    return records.select(
        sample_of(file).alias("video_id"),
        frame_index(file, index_rule).alias("frame_idx"),
        file.alias("path"),
        F.coalesce("imagePath", F.lit("")).alias("image_name"),
        F.coalesce("imageWidth", F.lit(0)).alias("img_w"),
        F.coalesce("imageHeight", F.lit(0)).alias("img_h"),
    )


def fill_index(boxes: DataFrame, frames: DataFrame) -> DataFrame:
    """Boxes whose frames without a number get their 0-based place in file order instead."""
    from trackloom.operators.windows import name_ranks

    ranks = name_ranks(frames.select("video_id", "path"), "path").select(
        "video_id", "path", (F.col("rank") - 1).alias("_place")
    )
    numbered = boxes.where(F.col("frame_idx").isNotNull())
    nameless = boxes.where(F.col("frame_idx").isNull()).join(ranks, ["video_id", "path"])
    return numbered.unionByName(
        nameless.withColumn("frame_idx", F.col("_place")).drop("_place")
    )


def read_boxes(spark: SparkSession, paths: str | list[str], index_rule: str = "suffix") -> DataFrame:
    return to_boxes(read_records(spark, paths), index_rule=index_rule)


def read_raw(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole JSON objects as VARIANT, for rewrites that keep every key."""
    texts = read_texts(spark, paths)
    return texts.select("path", F.try_parse_json("value").alias("raw")).where(F.col("raw").isNotNull())


def shape_struct(box: Column) -> Column:
    """Shape of a box (a struct of corners, track id and action)."""
    return F.struct(
        F.coalesce(F.nullif(box["action"], F.lit("")), F.lit("player")).alias("label"),
        rect_points(*[box[c] for c in ("x1", "y1", "x2", "y2")]).alias("points"),
        box["track_id"].alias("group_id"),
        F.lit("rectangle").alias("shape_type"),
        F.create_map().cast("map<string,string>").alias("flags"),
        F.create_map(
            F.lit("action"), box["action"], F.lit("track_id"), box["track_id"]
        ).alias("attributes"),
    )


def rebuilt(record: Column, shapes: Column) -> Column:
    """JSON text of a record (a map of VARIANT) with other shapes and every other key as it was."""
    rest = F.map_filter(record, lambda k, _v: k != "shapes")
    return F.to_json(F.map_concat(rest, F.create_map(F.lit("shapes"), F.to_variant_object(shapes))))


def keep_shapes(texts: DataFrame, kept: DataFrame, emptied: bool = True) -> DataFrame:
    """Record texts (path, value) with the shapes that ``kept`` (path, pos from 1) names.

    A shape and all keys beside it stay as they were. Records left without shapes are written
    when ``emptied``, else dropped; unreadable records are dropped. Adds ``n_before`` and ``n_after``.
    """
    places = kept.groupBy(F.col("path").alias("_path")).agg(F.collect_set(F.col("pos").cast("int")).alias("_kept"))
    listed = F.coalesce(F.try_variant_get(F.col("_record")["shapes"], "$", SHAPES), F.array().cast(SHAPES))
    left = F.filter("_shapes", lambda _s, i: F.coalesce(F.array_contains("_kept", i + 1), F.lit(False)))
    whole = texts.where(F.try_parse_json("value").isNotNull())
    read = once(whole.join(places, F.col("path") == F.col("_path"), "left"), _record=F.from_json("value", RECORD))
    marked = once(once(read, _shapes=listed), _left=left)
    out = once(
        marked.drop("value"),
        value=rebuilt(F.col("_record"), F.col("_left")),
        n_before=F.size("_shapes"),
        n_after=F.size("_left"),
    ).select("path", "value", "n_before", "n_after")
    return out if emptied else out.where("n_after > 0")


def frame_records(boxes: DataFrame, image_name: Column | None = None) -> DataFrame:
    """Records (video_id, frame_idx, imagePath, sizes, shapes) for boxes that have none: one per frame.

    Boxes read from records are written back by ``keep_shapes``.
    """
    name = image_name if image_name is not None else F.concat(
        pad_number(F.col("frame_idx"), 6), F.lit(".jpg")
    )
    # Grouped by chunk as well, so boxes that were dealt by video and chunk stay where they are.
    box = F.struct("pos", "x1", "y1", "x2", "y2", "track_id", "action")
    return (
        boxes.groupBy("video_id", frame_chunk("frame_idx").alias("_chunk"), "frame_idx")
        .agg(
            F.first(name).alias("imagePath"),
            F.max("img_w").alias("imageWidth"),
            F.max("img_h").alias("imageHeight"),
            F.sort_array(F.collect_list(box)).alias("_boxes"),
        )
        .withColumn("shapes", F.transform("_boxes", shape_struct))
        .drop("_chunk", "_boxes")
    )


def write_records(records: DataFrame, out: str) -> None:
    """Records as JSON lines, one folder per sample."""
    records.write.mode("errorifexists").partitionBy("video_id").json(out)
