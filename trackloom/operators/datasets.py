"""Splits, subsets, merges and listings of whole datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions.fields import add_prefix, base_name, norm_path, sanitize, stem
from trackloom.operators.ordering import first_per_group, row_numbers
from trackloom.operators.profile import majority_label

SPLITS = ("train", "val", "test")
# Column names tried for the video path, in order.
VIDEO_COLUMNS = ("video", "video_path", "path", "file", "filename", "name")
# Image extensions tried for a record, in order.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png")


def ratio_split(
    df: DataFrame, key: Column, ratios: tuple[float, float, float] = (8.0, 1.0, 1.0), seed: int = 42
) -> DataFrame:
    """Rows with a ``split``: seeded hash order of ``key`` cut at half-even rounded shares.

    The hash order is exact over the whole table yet sorted in 4096 even chunks (the first three
    digits of the hash), so no task sees all rows.
    """
    if min(ratios) < 0 or sum(ratios) <= 0:
        raise ValueError("ratios must not be negative and must not all be zero")
    shares = [float(r) / float(sum(ratios)) for r in ratios]
    text = F.coalesce(key.cast("string"), F.lit(""))
    hashed = df.withColumns(
        {"_hash": F.md5(F.concat(text, F.lit(f"#{seed}")).cast("binary")), "_key": text}
    )
    ranked = row_numbers(
        hashed, [], [F.col("_hash"), F.col("_key")], F.left("_hash", F.lit(3)), "_rank", total="_total"
    )
    train = F.bround(F.col("_total") * shares[0])
    val = train + F.bround(F.col("_total") * shares[1])
    split = F.when(F.col("_rank") <= train, "train").when(F.col("_rank") <= val, "val")
    return ranked.withColumn("split", split.otherwise("test")).drop("_hash", "_key", "_rank", "_total")


def split_samples(
    samples: DataFrame,
    frames: DataFrame,
    labels: DataFrame,
    boxes: DataFrame | None = None,
    ratios=(8.0, 1.0, 1.0),
    seed: int = 42,
) -> DataFrame:
    """Split lists (split, tube, label, frames) of samples.

    With ``boxes`` the label is the sample's most frequent action, as an id where ``labels``
    knows it; otherwise it is ``unknown``.
    """
    from trackloom.operators.profile import last_frames

    counted = samples.select("video_id").distinct().join(last_frames(frames), "video_id", "left")
    if boxes is None:
        named = counted.withColumn("label", F.lit("unknown"))
    else:
        named = counted.join(majority_label(boxes), "video_id", "left").withColumn(
            "label", F.coalesce("label", F.lit("unknown"))
        )
    ids = labels.select(
        F.col("label_name").alias("label"), F.col("label_id").cast("string").alias("_id")
    )
    tubes = named.join(ids, "label", "left").select(
        F.concat(F.lit("videos/"), F.col("video_id")).alias("tube"),
        F.coalesce("_id", "label").alias("label"),
        F.coalesce("nframes", F.lit(0)).cast("bigint").alias("frames"),
    )
    return ratio_split(tubes, F.col("tube"), ratios, seed)


def video_column(df: DataFrame) -> str:
    """Column that holds the video path: the lowest by (place among the known names, text before other kinds, position).

    Of columns that differ in case only, the last one has the known name.
    """
    place = {name: i for i, name in enumerate(VIDEO_COLUMNS)}

    def rank(column: tuple[int, tuple[str, str]]) -> tuple[int, int, int]:
        position, (name, kind) = column
        known = place.get(name.lower(), len(place))
        return known, kind != "string" and known == len(place), -position if known < len(place) else position

    return min(enumerate(df.dtypes), key=rank)[1][0]


def split_listing(
    listing: DataFrame,
    ratios=(8.0, 1.0, 1.0),
    seed: int = 42,
    column: str | None = None,
    prefix: str = "videos/",
) -> DataFrame:
    """Listing split by ratio, without its ``frames`` column and with the path prefix added."""
    kept = listing.drop("frames")
    column = column or video_column(kept)
    path = add_prefix(F.col(column).cast("string"), prefix) if prefix else F.col(column)
    return ratio_split(kept.withColumn(column, path), F.col(column), ratios, seed)


def cover_subset(boxes: DataFrame, per_class: int = 3) -> list[str]:
    """Samples, in pick order, that give every action at least ``per_class`` samples.

    Each pick has the largest gain (actions still in need), then the most actions, then the
    first name. Samples with the same set of actions differ by name only and at most
    ``per_class`` of them can ever gain, so the candidates are the first few names per action
    set; their number grows with the variety of sets, not with the samples. Each round is one
    aggregation over the candidates that returns one row.
    """
    actions = (
        boxes.where(F.col("action") != "")
        .groupBy("video_id")
        .agg(F.sort_array(F.collect_set("action")).alias("actions"))
    )
    candidates = (
        first_per_group(actions, ["actions"], [F.col("video_id")], per_class).drop("rn").persist()
    )
    picked: list[str] = []
    need: dict[str, int] = {}
    met: set[str] = set()
    try:
        while True:
            done = [a for a in sorted(met) if need[a] <= 0]
            gain = F.size(F.array_except("actions", F.array(*[F.lit(a) for a in done]).cast("array<string>")))
            best = (
                candidates.where(~F.col("video_id").isin(picked) if picked else F.lit(True))
                .withColumn("gain", gain)
                .where(F.col("gain") > 0)
                .orderBy(F.desc("gain"), F.desc(F.size("actions")), "video_id")
                .first()
            )
            if best is None:
                return picked
            picked.append(best["video_id"])
            for action in best["actions"]:
                met.add(action)
                need[action] = need.get(action, per_class) - 1
    finally:
        candidates.unpersist()


def label_names(dims: DataFrame) -> DataFrame:
    """New label ids over the union of all inputs' label names, in name order from 0.

    The label vocabulary is small; it is numbered in one place.
    """
    names = dims.select("label_name").distinct()
    return row_numbers(
        names, [], [F.col("label_name")], F.left("label_name", F.lit(1)), "_n"
    ).select((F.col("_n") - 1).alias("label_id"), "label_name")


def _known_rows(listings: DataFrame, dims: DataFrame) -> DataFrame:
    """Split rows with their new label id and normalised path."""
    number = F.col("label").try_cast("bigint")
    old = dims.select("input_no", F.col("label_id").alias("_num"), F.col("label_name").alias("_name"))
    named = (
        listings.withColumn("_num", number)
        .join(old, ["input_no", "_num"], "left")
        .withColumn("label_name", F.when(F.col("_num").isNull(), F.col("label")).otherwise(F.col("_name")))
        .where(F.coalesce("label_name", F.lit("")) != "")
    )
    return named.join(label_names(dims), "label_name").withColumn("path", norm_path(F.col("path")))


def merge_listings(listings: DataFrame, dims: DataFrame) -> DataFrame:
    """Merged split lists: (split, path, label).

    ``listings`` has (input_no, row_no, split, path, label), ``dims`` (input_no, label_id,
    label_name). Whole-number labels are ids of their own input, others are names; labels
    outside the union are dropped. Of equal paths in a split the first row is kept.
    """
    return _known_rows(listings, dims).groupBy("split", "path").agg(
        F.min_by(F.col("label_id").cast("string"), F.struct("input_no", "row_no")).alias("label")
    )


def merge_summary(listings: DataFrame, dims: DataFrame) -> DataFrame:
    """Per split: rows read, rows with a known label, paths kept, and collisions (rows whose path was there before)."""
    known = _known_rows(listings, dims).groupBy("split", "path").agg(F.count(F.lit(1)).alias("_n"))
    kept = known.groupBy("split").agg(
        F.sum("_n").alias("rows_known"), F.count(F.lit(1)).alias("paths"), F.sum(F.col("_n") - 1).alias("collisions")
    )
    read = listings.groupBy("split").agg(F.count(F.lit(1)).alias("rows_read"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows_known", "paths", "collisions")]
    return read.join(kept, "split", "left").select("split", "rows_read", *zero)


def listing_labels(splits: DataFrame, labels: DataFrame) -> DataFrame:
    """Split rows with normalised path and label name (the id's text where no name is known)."""
    names = labels.select(
        F.col("label_id").cast("bigint").alias("_num"), F.col("label_name").alias("_name")
    )
    number = F.col("label").try_cast("bigint")
    return (
        splits.withColumn("_num", number)
        .join(names, "_num", "left")
        .select(
            "split",
            norm_path(F.col("path")).alias("path"),
            "label",
            F.coalesce("_name", F.col("_num").cast("string"), "label").alias("label_name"),
        )
    )


def listing_stats(splits: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows per split and label, by id and by name."""
    return (
        listing_labels(splits, labels)
        .groupBy("split", "label", "label_name")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def listing_totals(splits: DataFrame) -> DataFrame:
    """Rows and distinct normalised paths per split and over all (``__all__``)."""
    paths = splits.select("split", norm_path(F.col("path")).alias("path"))
    both = paths.withColumn("split", F.explode(F.array("split", F.lit("__all__"))))
    # Counting per path first keeps a split's distinct count off a single task.
    per_path = both.groupBy("split", "path").agg(F.count(F.lit(1)).alias("n"))
    return per_path.groupBy("split").agg(
        F.sum("n").alias("num_samples"), F.count(F.lit(1)).alias("unique_samples")
    )


def missing_paths(splits: DataFrame, existing: DataFrame) -> DataFrame:
    """Listed paths that do not exist."""
    listed = splits.select(norm_path(F.col("path")).alias("path")).distinct()
    return listed.join(existing.select("path"), "path", "left_anti")


def split_audit(splits: DataFrame) -> DataFrame:
    """Named counts: size, distinct and repeated paths per split, paths shared by two splits,
    and the ratio of the most to the least frequent label."""
    per_path = splits.groupBy("path").agg(
        *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    )
    measures: dict[str, Column] = {}
    for s in SPLITS:
        measures[f"{s}_size"] = F.sum(s)
        measures[f"{s}_unique"] = F.count_if(F.col(s) > 0)
        measures[f"{s}_duplicates"] = F.sum(s) - F.count_if(F.col(s) > 0)
    for a, b in (("train", "val"), ("train", "test"), ("val", "test")):
        measures[f"{a}_{b}_shared"] = F.count_if((F.col(a) > 0) & (F.col(b) > 0))
    row = per_path.agg(*[m.cast("double").alias(n) for n, m in measures.items()])
    by_label = splits.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    ratio = by_label.agg(F.round(F.max("n") / F.min("n"), 6).alias("imbalance"))
    pairs = F.array(
        *[F.struct(F.lit(n).alias("measure"), F.coalesce(n, F.lit(0.0)).alias("value")) for n in measures]
    )
    return row.select(F.inline(pairs)).unionByName(
        ratio.select(F.lit("imbalance").alias("measure"), F.col("imbalance").alias("value"))
    )


def label_distribution(splits: DataFrame, labels: DataFrame) -> DataFrame:
    """Count and share of each label, named, over all rows and per split."""
    both = splits.withColumn("split", F.explode(F.array("split", F.lit("overall"))))
    counts = both.groupBy("split", "label").agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("split").agg(F.sum("count").alias("_total"))
    names = labels.select(F.col("label_id").cast("string").alias("label"), "label_name")
    return (
        counts.join(totals, "split")
        .join(names, "label", "left")
        .select(
            "split",
            F.col("label").alias("label_id"),
            F.coalesce("label_name", F.lit("UNKNOWN")).alias("label_name"),
            "count",
            F.round(F.col("count") / F.col("_total"), 6).alias("proportion"),
        )
    )


def unique_names(
    df: DataFrame, name: str, order: list[Column], chunk: Column, suffix: str = "_dup"
) -> DataFrame:
    """``name`` made unique: the second and later rows get ``<stem><suffix><n><extension>``.

    Only names that repeat are numbered; ``chunk`` grows with ``order`` and cuts a name that
    very many rows share.
    """
    repeated = df.groupBy(name).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(name)
    single = df.join(repeated, name, "left_anti").withColumn("_copy", F.lit(1).cast("bigint"))
    several = row_numbers(df.join(repeated, name, "left_semi"), [name], order, chunk, "_copy")
    extension = F.regexp_extract(F.col(name), "(?<=.)(\\.[^.]*)$", 1)
    renamed = F.concat(
        stem(F.col(name)), F.lit(suffix), (F.col("_copy") - 1).cast("string"), extension
    )
    rows = single.unionByName(several)
    return rows.withColumn(
        name, F.when(F.col("_copy") > 1, renamed).otherwise(F.col(name))
    ).drop("_copy")


def flatten_names(files: DataFrame) -> DataFrame:
    """Flat copy plan of (dataset, action, sample, file): new name and rewritten image path.

    The image of a record is the file of the same stem in its folder, by extension preference,
    else ``.jpg``.
    """
    folder = ["dataset", "action", "sample"]
    prefix = F.concat_ws("__", *folder)
    cut = files.withColumns(
        {
            "_stem": stem(F.col("file")),
            "_ext": F.lower(F.regexp_extract("file", "(?<=.)(\\.[^.]*)$", 1)),
        }
    )
    images = (
        cut.where(F.col("_ext").isin(*IMAGE_EXTENSIONS))
        .groupBy(*folder, "_stem")
        .agg(F.min(F.array_position(F.array(*map(F.lit, IMAGE_EXTENSIONS)), F.col("_ext"))).alias("_best"))
    )
    best = F.element_at(F.array(*map(F.lit, IMAGE_EXTENSIONS)), F.col("_best").cast("int"))
    named = (
        cut.join(images, [*folder, "_stem"], "left")
        .withColumn("new_name", F.concat(prefix, F.lit("__"), F.col("file")))
        .withColumn(
            "image_path",
            F.when(
                F.col("_ext") == ".json",
                F.concat(prefix, F.lit("__"), F.col("_stem"), F.coalesce(best, F.lit(".jpg"))),
            ),
        )
        .drop("_stem", "_ext", "_best")
    )
    order = [F.col(c) for c in (*folder, "file")]
    chunk = F.struct("dataset", "action", F.left("sample", F.lit(4)))
    return unique_names(named, "new_name", order, chunk)


def merge_single(files: DataFrame, name: str = "merged_all") -> DataFrame:
    """Copy plan of all samples into one: every file prefixed with its sample."""
    new = F.concat("video_id", F.lit("__"), F.col("file"))
    return files.select(
        F.concat_ws("/", F.lit("videos"), "video_id", "file").alias("src_path"),
        F.concat(F.lit(f"videos/{name}/"), new).alias("dst_path"),
    )


def rename_by_action(boxes: DataFrame, name_format: str = "{action}__{orig}") -> DataFrame:
    """New name of each sample from its most frequent (sanitised) action and its own name."""
    safe = boxes.withColumn("action", sanitize(F.coalesce("action", F.lit(""))))
    named = majority_label(safe).withColumn(
        "new_name", sanitize(_fill(name_format, F.col("label"), F.col("video_id")))
    )
    chunk = F.left("video_id", F.lit(4))
    return unique_names(named.select("video_id", "new_name"), "new_name", [F.col("video_id")], chunk)


def _fill(name_format: str, action: Column, orig: Column) -> Column:
    out = F.replace(F.lit(name_format), F.lit("{action}"), action)
    return F.replace(out, F.lit("{orig}"), orig)


def sample_manifest(samples: DataFrame, out_root: str) -> DataFrame:
    """Copy plan of samples: source folder, target folder."""
    return samples.select(
        F.concat(F.lit("videos/"), F.col("video_id")).alias("src_path"),
        F.concat(F.lit(f"{out_root.rstrip('/')}/videos/"), F.col("video_id")).alias("dst_path"),
    )


def folder_layout(dirs: DataFrame) -> DataFrame:
    """Target sample names of image folders: the base name, made unique with ``_<n>``."""
    named = dirs.select("dir", base_name(F.col("dir")).alias("sample"))
    return unique_names(named, "sample", [F.col("dir")], F.left("dir", F.lit(24)), "_")


def layout_manifest(files: DataFrame, named: DataFrame, out_root: str) -> DataFrame:
    """Copy plan (src_path, dst_path) of every file below a named folder, with its place below it.

    ``named`` has (dir, sample); its folders don't hold each other, so a file belongs to one at most. A file meets its
    folder through the list of the folders above it.
    """
    parts = F.split("path", "/")
    inside = files.where(F.size(parts) > 1).select(
        "path",
        F.explode(F.sequence(F.lit(1), F.size(parts) - 1)).alias("_depth"),
        parts.alias("_parts"),
    )
    keyed = inside.withColumn("dir", F.array_join(F.slice("_parts", F.lit(1), F.col("_depth")), "/"))
    rest = F.array_join(F.slice("_parts", F.col("_depth") + 1, F.size("_parts")), "/")
    target = F.concat(F.lit(f"{out_root.rstrip('/')}/videos/"), F.col("sample"), F.lit("/"), rest)
    return keyed.join(named, "dir").select(F.col("path").alias("src_path"), target.alias("dst_path"))
