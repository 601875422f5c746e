"""Readers of the list, dictionary and table files around a dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackloom import schema
from trackloom.functions.fields import SPLIT_HEADERS
from trackloom.operators.relabel import clean_mapping


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files in file order (``row_no`` grows along a file)."""
    return spark.read.text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("row_no")
    )


def read_list_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines (path, row_no, value) of the CSV files of a folder, numbered from 0 in each file.

    A list is read whole by one task, which is what gives its lines their numbers.
    """
    texts = spark.read.option("pathGlobFilter", "*.[cC][sS][vV]").text(folder, wholetext=True)
    cut = F.split(F.regexp_replace("value", "\\r?\\n$", ""), "\\r?\\n", -1)
    return texts.select(F.col("_metadata.file_path").alias("path"), F.posexplode(cut).alias("row_no", "value"))


def split_lines(lines: DataFrame) -> DataFrame:
    """(path, label) of tolerant ``path[,label]`` lines: header words skipped, no label → unknown."""
    parts = F.from_csv("value", F.lit("c0 string, c1 string"), {"mode": "PERMISSIVE"})
    cut = lines.withColumn("_p", parts)
    first, second = F.trim(F.col("_p.c0")), F.trim(F.col("_p.c1"))
    kept = cut.where(F.coalesce(first, F.lit("")) != "").where(~F.lower(first).isin(*SPLIT_HEADERS))
    has_label = F.contains("value", F.lit(","))
    return kept.select(
        *[c for c in lines.columns if c not in ("value", "path")],
        first.alias("path"),
        F.when(has_label, F.coalesce(second, F.lit(""))).otherwise(F.lit("unknown")).alias("label"),
    )


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return split_lines(_lines(spark, path)).withColumn("split", F.lit(split))


def split_samples(listing: DataFrame) -> DataFrame:
    """Sample names of a split list: the part after ``videos/``, else the base name."""
    path = F.col("path")
    sample = F.when(F.startswith(path, F.lit("videos/")), F.regexp_replace(path, "^videos/", "")).otherwise(
        F.regexp_extract(path, "([^/]*)$", 1)
    )
    return listing.select(sample.alias("video_id"), "split").where(F.col("video_id") != "").distinct()


def label_entries(texts: DataFrame, text: str = "value") -> DataFrame:
    """(label_id, label_name) of a dictionary text in any of its three forms.

    A list numbers its names from 0. A map whose keys are all whole numbers maps ids to names,
    any other map names to ids.
    """
    others = [c for c in texts.columns if c != text]
    value = F.trim(F.col(text))
    as_list = (
        texts.where(F.startswith(value, F.lit("[")))
        .select(*others, F.posexplode(F.from_json(text, T.ArrayType(T.StringType()))))
        .select(*others, F.col("pos").cast("bigint").alias("label_id"), F.col("col").alias("label_name"))
    )
    mapped = texts.where(F.startswith(value, F.lit("{"))).withColumn(
        "_m", F.map_entries(F.from_json(text, T.MapType(T.StringType(), T.StringType())))
    )
    by_id = F.forall("_m", lambda e: e["key"].rlike("^[0-9]+$"))
    # A repeated key keeps its last value.
    last = F.filter(
        "_m",
        lambda e, i: ~F.exists(F.slice("_m", i + 2, F.size("_m")), lambda x: x["key"] == e["key"]),
    )
    as_map = (
        mapped.select(*others, by_id.alias("_by_id"), F.inline(last))
        .select(
            *others,
            F.when(F.col("_by_id"), F.col("key")).otherwise(F.col("value")).try_cast("bigint").alias("label_id"),
            F.when(F.col("_by_id"), F.col("value")).otherwise(F.col("key")).alias("label_name"),
        )
    )
    return as_list.unionByName(as_map).where(
        F.col("label_id").isNotNull() & F.col("label_name").isNotNull()
    )


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return label_entries(spark.read.text(path, wholetext=True).select("value"))


def action_blocks(texts: DataFrame, text: str = "value") -> DataFrame:
    """(action_id, action_name, label_type) of block texts; blocks without id or name are skipped.

    A later block of the same id replaces an earlier one.
    """
    others = [c for c in texts.columns if c != text]
    blocks = texts.select(*others, F.posexplode(F.split(text, "\\}")).alias("_at", "_b"))

    def field(name: str) -> Column:
        return F.trim(F.regexp_extract("_b", f"(?m)^\\s*(?:\\w+ *\\{{)?\\s*{name}:(.*)$", 1))

    quoted = F.regexp_extract(field("name"), '^[^"]*"([^"]*)', 1)
    name = F.when(F.contains(field("name"), F.lit('"')), quoted).otherwise(field("name"))
    return (
        blocks.select(
            *others,
            "_at",
            field("label_id").try_cast("bigint").alias("action_id"),
            name.alias("action_name"),
            F.nullif(field("label_type"), F.lit("")).alias("label_type"),
        )
        .where(F.col("action_id").isNotNull() & (F.col("action_name") != ""))
        .groupBy(*others, "action_id")
        .agg(
            F.max_by("action_name", "_at").alias("action_name"),
            F.max_by("label_type", "_at").alias("label_type"),
        )
    )


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    return action_blocks(spark.read.text(path, wholetext=True).select("value"))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Label mapping of a CSV whose header has ``label`` and ``label2`` in any case."""
    raw = spark.read.option("header", True).csv(path)
    named = {c.strip().lower(): c for c in raw.columns}
    missing = [c for c in ("label", "label2") if c not in named]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}; found {raw.columns}")
    rows = raw.select(
        F.col(f"`{named['label']}`").alias("label"),
        F.col(f"`{named['label2']}`").alias("label2"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    return clean_mapping(rows.where(F.col("label").isNotNull()), "row_no")


def removal_lines(lines: DataFrame) -> DataFrame:
    """(video_id, track_id) of ``video,track`` lines; tabs count as commas, ``#`` starts a comment line."""
    parts = F.filter(
        F.transform(F.split(F.translate("value", "\t", ","), ","), lambda p: F.trim(p)), lambda p: p != ""
    )
    return (
        lines.where(~F.startswith(F.trim("value"), F.lit("#")))
        .select(parts.alias("_p"))
        .where(F.size("_p") >= 2)
        .select(F.col("_p")[0].alias("video_id"), F.col("_p")[1].alias("track_id"))
        .distinct()
    )


def read_removals(spark: SparkSession, path: str) -> DataFrame:
    return removal_lines(_lines(spark, path))


def classifier_lines(lines: DataFrame) -> DataFrame:
    """(video_id, track_id, frame_id, label) of ``video_track_frame,label`` lines."""
    parts = F.transform(F.split(F.trim("value"), ","), lambda p: F.trim(p))
    pattern = "^(.*)_([^_]*)_([^_]*)$"
    name = F.col("_p")[0]
    return (
        lines.where((F.trim("value") != "") & ~F.startswith(F.trim("value"), F.lit("#")))
        .select(*[c for c in lines.columns if c != "value"], parts.alias("_p"))
        .where((F.size("_p") >= 2) & name.rlike(pattern))
        .select(
            *[c for c in lines.columns if c != "value"],
            *[
                F.regexp_extract(name, pattern, i).alias(c)
                for i, c in enumerate(("video_id", "track_id", "frame_id"), 1)
            ],
            F.col("_p")[1].alias("label"),
        )
    )


def zero_pairs(parsed: DataFrame) -> DataFrame:
    """(video_id, track_id) of the lines labelled 0, repeated ones kept."""
    return parsed.where(F.col("label") == "0").select("video_id", "track_id")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions (id, label_name) of a CSV with a header; rows without an id are skipped."""
    raw = spark.read.option("header", True).csv(path)
    missing = [c for c in ("id", "label_name") if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}; found {raw.columns}")
    return raw.select("id", "label_name").where(F.coalesce(F.trim("id"), F.lit("")) != "")


def read_alignment(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema.ALIGNMENT).csv(path)


def typed_interactions(text_rows: DataFrame) -> DataFrame:
    """Interaction rows with numbers where they parse and null elsewhere; names stay text."""
    texts, whole = ("video_id", "frame_id"), ("action_id", "person_id", "instance_id")

    def typed(name: str) -> Column:
        if name in texts:
            return F.col(name)
        number = F.col(name).try_cast("double")
        return (number.cast("bigint") if name in whole else number).alias(name)

    others = [c for c in text_rows.columns if c not in schema.INTERACTION_COLUMNS]
    return text_rows.select(*others, *[typed(c) for c in schema.INTERACTION_COLUMNS])


def read_interactions(spark: SparkSession, paths: dict[str, str], numbered: bool = False) -> DataFrame:
    """Headerless 13-column CSV files by split, stacked with their split name.

    ``numbered`` adds ``part_no`` (place of the split) and ``row_no``, which grows along a file.
    """
    fields = ", ".join(f"{c} string" for c in schema.INTERACTION_COLUMNS)
    out = None
    for number, (split, path) in enumerate(paths.items()):
        raw = spark.read.schema(fields).csv(path)
        if numbered:
            raw = raw.withColumns({"part_no": F.lit(number), "row_no": F.monotonically_increasing_id()})
        part = typed_interactions(raw).withColumn("split", F.lit(split))
        out = part if out is None else out.unionByName(part)
    return out
