"""Label rewriting for per-frame records and for category tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions.fields import track_of
from trackloom.functions.rows import once
from trackloom.operators.ordering import first_per_group


def clean_mapping(rows: DataFrame, order: str | None = None) -> DataFrame:
    """Mapping (label, label2): trimmed, blank sources ignored, the last row of a label wins.

    An empty target means that the label is deleted. ``order`` names a column with the row order.
    """
    source = F.trim("label")
    pairs = rows.where(~source.isin("", "nan", "None")).select(
        source.alias("label"),
        F.trim(F.coalesce("label2", F.lit(""))).alias("label2"),
        (F.col(order) if order else F.lit(0)).alias("_at"),
    )
    return pairs.groupBy("label").agg(F.max_by("label2", "_at").alias("label2"))


def relabel(boxes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Boxes with mapped labels; deleted ones and boxes without any label are dropped.

    The action is mapped when it is set, else the shape's label. Unmapped names pass unchanged.
    """
    action = F.trim(F.coalesce("action", F.lit("")))
    uses_action = action != ""
    source = F.when(uses_action, action).otherwise(F.trim(F.coalesce("label", F.lit(""))))
    joined = boxes.withColumn("_source", source).join(
        mapping.select(F.col("label").alias("_source"), F.col("label2").alias("_target")),
        "_source",
        "left",
    )
    target = F.coalesce("_target", "_source")
    kept = joined.where((F.col("_source") != "") & (target != ""))
    return kept.withColumns(
        {
            "label": F.when(uses_action, F.col("label")).otherwise(target),
            "action": F.when(uses_action, target).otherwise(F.col("action")),
        }
    ).select(*boxes.columns)


def relabel_summary(boxes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Records and samples that lose all shapes, and shapes before and after, one row."""
    keys = ["video_id", "frame_idx"]
    before = boxes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    after = relabel(boxes, mapping).groupBy(*keys).agg(F.count(F.lit(1)).alias("left"))
    left = F.coalesce("left", F.lit(0))
    per_video = (
        before.join(after, keys, "left")
        .groupBy("video_id")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.count_if(left == 0).alias("deleted"),
            F.sum("n").alias("n"),
            F.sum(left).alias("left"),
        )
    )
    return per_video.agg(
        F.count(F.lit(1)).alias("samples_total"),
        F.count_if(F.col("deleted") < F.col("files")).alias("samples_converted"),
        F.count_if(F.col("deleted") == F.col("files")).alias("samples_deleted_after"),
        F.sum("files").alias("json_files_total"),
        F.sum("deleted").alias("json_files_deleted"),
        F.sum("n").alias("annotations_before"),
        F.sum("left").alias("annotations_after"),
    )


def remap_categories(categories: DataFrame, mapping: DataFrame) -> DataFrame:
    """Old category ids with their new name and id: (doc_id, category_id, new_name, new_id).

    ``categories`` has (doc_id, pos, category_id, name). Categories with the same target are
    merged, deleted ones dropped, ids run from 1 in the order names are first met.
    """
    by_id = categories.groupBy("doc_id", "category_id").agg(
        F.max_by(F.trim("name"), "pos").alias("name"), F.min("pos").alias("pos")
    )
    mapped = (
        by_id.join(
            mapping.select(F.col("label").alias("name"), F.col("label2").alias("_target")),
            "name",
            "left",
        )
        .withColumn("new_name", F.coalesce("_target", "name"))
        .where(F.col("new_name") != "")
        .drop("_target")
    )
    names = mapped.groupBy("doc_id", "new_name").agg(F.min("pos").alias("_at"))
    # A document's categories come from one record, so they are a small group.
    numbered = first_per_group(names, ["doc_id"], [F.col("_at")], 2**31 - 1, "new_id")
    return mapped.join(numbered.select("doc_id", "new_name", "new_id"), ["doc_id", "new_name"]).select(
        "doc_id", "category_id", "new_name", F.col("new_id").cast("bigint").alias("new_id")
    )


def remap_annotations(annotations: DataFrame, remapped: DataFrame) -> DataFrame:
    """Annotations with new category ids; those of deleted or unknown categories are dropped."""
    return (
        annotations.join(remapped.drop("new_name"), ["doc_id", "category_id"])
        .drop("category_id")
        .withColumnRenamed("new_id", "category_id")
    )


def detect_format(text: Column) -> Column:
    """``labelme``, ``coco`` or ``unknown`` for a JSON text."""
    value = F.try_parse_json(text)

    def is_list(path: str) -> Column:
        return F.try_variant_get(value, path, "array<variant>").isNotNull()

    return (
        F.when(is_list("$.shapes"), "labelme")
        .when(is_list("$.annotations") & is_list("$.categories"), "coco")
        .otherwise("unknown")
    )


RECORD = "map<string,variant>"
SHAPES = "array<map<string,variant>>"


def _text_of(value: Column) -> Column:
    """Trimmed text of a VARIANT that holds text, else an empty text."""
    text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
    return F.trim(F.coalesce(text, F.lit("")))


def _with_key(entries: Column, key: str, value: Column) -> Column:
    rest = F.map_filter(entries, lambda k, _v: k != key)
    return F.map_concat(rest, F.create_map(F.lit(key), value))


def _rebuilt(record: Column, shapes: Column) -> Column:
    return F.to_json(_with_key(record, "shapes", F.to_variant_object(shapes)))


def relabel_records(texts: DataFrame, mapping: DataFrame, text: str = "value") -> DataFrame:
    """Record texts with mapped labels and every other key kept.

    The rules are those of ``relabel``, applied inside each record, so nothing is shuffled; the
    mapping (a small vocabulary) enters as one map value. Records of another format pass
    unchanged. Adds ``n_before`` and ``n_after``, the shapes before and after.
    """
    names = mapping.agg(
        F.map_from_entries(F.collect_list(F.struct("label", "label2")))
    ).scalar()
    record = F.when(detect_format(F.col(text)) == "labelme", F.from_json(text, RECORD))
    parsed = once(texts.withColumn("_names", names), _record=record)

    # Each step names what the next one reads several times.
    def opened(shape: Column) -> Column:
        return F.struct(shape.alias("shape"), F.try_variant_get(shape["attributes"], "$", RECORD).alias("attributes"))

    def named(s: Column) -> Column:
        action, label = _text_of(s["attributes"]["action"]), _text_of(s["shape"]["label"])
        return F.struct(s["shape"].alias("shape"), s["attributes"].alias("attributes"), action.alias("action"), label.alias("label"))

    def sourced(s: Column) -> Column:
        own = s["action"] != ""
        source = F.when(own, s["action"]).otherwise(s["label"])
        return F.struct(s["shape"].alias("shape"), s["attributes"].alias("attributes"), own.alias("own"), source.alias("source"))

    def aimed(s: Column) -> Column:
        target = F.when(s["source"] != "", F.coalesce(F.col("_names")[s["source"]], s["source"])).otherwise("")
        return F.struct(s["shape"].alias("shape"), s["attributes"].alias("attributes"), s["own"].alias("own"), target.alias("target"))

    def rewrite(s: Column) -> Column:
        target = s["target"].cast("variant")
        as_action = F.to_variant_object(_with_key(s["attributes"], "action", target))
        return F.when(s["own"], _with_key(s["shape"], "attributes", as_action)).otherwise(_with_key(s["shape"], "label", target))

    read = once(parsed, _shapes=F.try_variant_get(F.col("_record")["shapes"], "$", SHAPES))
    aims = F.col("_shapes")
    for step in (opened, named, sourced, aimed):
        aims = F.transform(aims, step)
    kept = once(read, _kept=F.transform(F.filter(aims, lambda s: s["target"] != ""), rewrite))
    return once(
        kept,
        **{
            text: F.when(F.col("_kept").isNotNull(), _rebuilt(F.col("_record"), F.col("_kept"))).otherwise(F.col(text)),
            "n_before": F.coalesce(F.size("_shapes"), F.lit(0)),
            "n_after": F.coalesce(F.size("_kept"), F.lit(0)),
        },
    ).select(*texts.columns, "n_before", "n_after")


def keep_track(texts: DataFrame, track: Column, text: str = "value") -> DataFrame:
    """Record texts with the shapes of one track only and every other key kept."""
    read = once(texts, _record=F.from_json(text, RECORD))

    def text_map(value: Column) -> Column:
        return F.try_variant_get(value, "$", "map<string,string>")

    def opened(shape: Column) -> Column:
        group = F.try_variant_get(shape["group_id"], "$", "string")
        maps = [text_map(shape[c]).alias(c) for c in ("attributes", "flags")]
        return F.struct(shape.alias("shape"), *maps, group.alias("group"))

    shapes = F.transform(F.try_variant_get(F.col("_record")["shapes"], "$", SHAPES), opened)
    own = F.filter(shapes, lambda s: track_of(s["attributes"], s["flags"], s["group"]) == track)
    kept = F.transform(own, lambda s: s["shape"])
    return once(read, **{text: _rebuilt(F.col("_record"), kept)}).select(*texts.columns)
