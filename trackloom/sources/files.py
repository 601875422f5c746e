"""Folder discovery and image lookup over a table of file paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.fields import base_name, frame_index, stem
from trackloom.functions.rows import once

# The three image extension sets in use.
IMAGES = {
    "jpg": (".jpg", ".jpeg"),
    "listed": (".jpg", ".jpeg", ".png"),
    "all": (".jpg", ".jpeg", ".png", ".bmp", ".webp"),
}
# Extension preference when an image is looked up by stem.
PREFERRED = (".jpg", ".jpeg", ".png")
# Extensions of a frame's image, in order.
EXACT = (".jpg", ".JPG", ".jpeg", ".JPEG")

#: Numbers of names that are dealt together.
NEAR = 16384


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Paths below a folder; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path")
    )


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, "(?<=[^/])(\\.[^./]*)$", 1))


def is_image(path: Column, kind: str = "listed") -> Column:
    return extension(path).isin(*IMAGES[kind])


def parent(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def list_samples(files: DataFrame) -> DataFrame:
    """Sample folders (children of a ``videos`` folder) that hold a record."""
    sample = F.regexp_extract("path", "(?:^|/)videos/([^/]+)/(?:.*/)?[^/]*$", 1)
    return (
        files.where(extension(F.col("path")) == ".json")
        .select(sample.alias("video_id"))
        .where(F.col("video_id") != "")
        .distinct()
    )


def _ancestors(folder: Column) -> Column:
    """All folders above a folder."""
    parts = F.split(folder, "/")
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
        lambda i: F.when(i < F.size(parts), F.array_join(F.slice(parts, 1, i), "/")),
    )


def leaf_dirs(files: DataFrame) -> DataFrame:
    """Topmost folders that hold records on each branch."""
    dirs = (
        files.where(extension(F.col("path")) == ".json")
        .select(parent(F.col("path")).alias("dir"))
        .distinct()
    )
    above = dirs.select("dir", F.explode(_ancestors(F.col("dir"))).alias("up"))
    nested = above.join(dirs.select(F.col("dir").alias("up")), "up", "left_semi").select("dir")
    return dirs.join(nested.distinct(), "dir", "left_anti")


def sample_dirs(files: DataFrame, kind: str = "listed") -> DataFrame:
    """Deepest folders that hold images."""
    dirs = files.where(is_image(F.col("path"), kind)).select(parent(F.col("path")).alias("dir")).distinct()
    above = dirs.select(F.explode(_ancestors(F.col("dir"))).alias("dir")).where(F.col("dir").isNotNull())
    return dirs.join(above.distinct(), "dir", "left_anti")


def second_level_dirs(files: DataFrame, root: str, kind: str = "listed") -> DataFrame:
    """Sample folders of a two-level layout: ``<action>/<sample>``, else an action folder of images."""
    rest = F.regexp_extract("path", f"^\\Q{root.rstrip('/')}\\E/(.*)$", 1)
    cut = files.withColumn("_rest", rest).where(F.col("_rest") != "")
    deep = cut.select(F.regexp_extract("_rest", "^([^/]+/[^/]+)/", 1).alias("dir")).where(F.col("dir") != "")
    flat = (
        cut.where(is_image(F.col("path"), kind))
        .select(F.regexp_extract("_rest", "^([^/]+)/[^/]+$", 1).alias("dir"))
        .where(F.col("dir") != "")
    )
    with_children = deep.select(F.split_part("dir", F.lit("/"), F.lit(1)).alias("dir")).distinct()
    return deep.distinct().unionByName(flat.distinct().join(with_children, "dir", "left_anti"))


def frame_manifest(files: DataFrame, kind: str = "listed", index_rule: str = "suffix") -> DataFrame:
    """Images with sample, name and frame number."""
    path = F.col("path")
    return files.where(is_image(path, kind)).select(
        base_name(parent(path)).alias("video_id"),
        base_name(path).alias("image_name"),
        frame_index(path, index_rule).alias("frame_idx"),
    )


def first_per_index(manifest: DataFrame) -> DataFrame:
    """First file by name of each frame number."""
    return (
        manifest.where(F.col("frame_idx").isNotNull())
        .groupBy("video_id", "frame_idx")
        .agg(F.min("image_name").alias("image_name"))
    )


def frames_index(images: DataFrame, records: DataFrame) -> DataFrame:
    """Record name per image frame: the one with the same number, else the name it would have."""
    known = records.groupBy("video_id", "frame_idx").agg(F.min("record_name").alias("_record"))
    return (
        first_per_index(images)
        .join(known, ["video_id", "frame_idx"], "left")
        .select(
            "video_id",
            "frame_idx",
            "image_name",
            F.coalesce("_record", F.concat(stem(F.col("image_name")), F.lit(".json"))).alias("record_name"),
            F.col("_record").isNotNull().alias("has_record"),
        )
    )


def pair_images(records: DataFrame, images: DataFrame) -> DataFrame:
    """Image of each record: the named one if it exists, else one of the same stem.

    Among equal stems the extension decides, then the name. Input (video_id, record_name,
    image_path) and (video_id, image_name).
    """
    named = images.select("video_id", F.col("image_name").alias("image_path"), F.lit(True).alias("_named"))
    rank = F.coalesce(
        F.nullif(
            F.array_position(F.array(*map(F.lit, PREFERRED)), extension(F.col("image_name"))), F.lit(0)
        ),
        F.lit(len(PREFERRED) + 1),
    )
    by_stem = (
        images.withColumn("_stem", stem(F.col("image_name")))
        .groupBy("video_id", "_stem")
        .agg(F.min_by("image_name", F.struct(rank, F.col("image_name"))).alias("_other"))
    )
    return (
        records.withColumn("_stem", stem(F.col("record_name")))
        .join(named.distinct(), ["video_id", "image_path"], "left")
        .join(by_stem, ["video_id", "_stem"], "left")
        .select(
            "video_id",
            "record_name",
            F.when(F.col("_named"), F.col("image_path")).otherwise(F.col("_other")).alias("image_name"),
        )
    )


def _bases(frame_id: Column) -> Column:
    """Candidate stems of a frame id, best first."""
    number = frame_id.try_cast("bigint")
    text = number.cast("string")

    def padded(width: int) -> Column:
        return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))

    numeric = F.array(
        F.concat(F.lit("img_"), padded(5)), padded(6), text, F.concat(F.lit("img_"), text)
    )
    literal = F.array(F.concat(F.lit("img_"), frame_id), frame_id)
    return F.array_distinct(F.when(number.isNotNull(), F.concat(numeric, literal)).otherwise(literal))


def _first_in_names(images: DataFrame, most: DataFrame) -> DataFrame:
    """First image name with each number in its digits: (_n, video_id, _inside); ``most`` bounds the numbers of a video.

    Names whose last numbers are near are dealt together, so that a number that many of them contain leaves the task as
    one row. The tasks are as many as the session's shuffles have, because the names are few bytes and their numbers are not.
    """
    name = F.col("image_name")
    last = F.regexp_extract(name, "([0-9]+)[^0-9]*$", 1)
    dealt = (
        images.select("video_id", "image_name")
        .where(extension(name).isin(".jpg", ".jpeg"))
        .withColumn("_near", F.floor(F.right(last, F.lit(18)).try_cast("bigint") / NEAR))
        .where(F.col("_near").isNotNull())
        .repartition(int(images.sparkSession.conf.get("spark.sql.shuffle.partitions")), "video_id", "_near")
    )
    digits = F.substring("_run", F.col("_at"), F.lit(1))
    room = F.least(F.length("_run") - F.col("_at") + 1, F.length(F.col("_most").cast("string")))
    return (
        dealt.join(F.broadcast(most), "video_id")
        .select("video_id", "image_name", "_most", F.explode(F.regexp_extract_all(name, F.lit("[0-9]+"), F.lit(0))).alias("_run"))
        .select("*", F.explode(F.sequence(F.lit(1), F.length("_run"))).alias("_at"))
        # The text of a number has no zeros in front, so a zero stands alone.
        .select("*", F.explode(F.sequence(F.lit(1), F.when(digits == "0", F.lit(1)).otherwise(room))).alias("_len"))
        .select(F.substring("_run", F.col("_at"), F.col("_len")).try_cast("bigint").alias("_n"), "video_id", "image_name", "_most")
        .where(F.col("_n") <= F.col("_most"))
        .groupBy("_n", "video_id")
        .agg(F.min("image_name").alias("_inside"))
    )


def _find_numbers(keys: DataFrame, images: DataFrame) -> DataFrame:
    """``find_frames`` of distinct (_n, video_id, frame_id), whose ids are the numbers ``_n``.

    A name of a known pattern holds its frame's number behind an optional ``img_``, and every pattern holds the
    number's text. So ids, whole names and numbers inside names meet by number and video, each as one row.
    """
    name = F.col("image_name")
    ext = F.coalesce(*[F.when(F.endswith(name, F.lit(e)), F.lit(i)) for i, e in enumerate(EXACT)])
    base = F.left(name, F.length(name) - F.length(F.get(F.array(*map(F.lit, EXACT)), F.col("_ext"))))
    plain = F.when(F.startswith("_base", F.lit("img_")), F.substring("_base", 5, 2**31 - 1)).otherwise(F.col("_base"))
    known = once(images.select("video_id", "image_name"), _ext=ext).where(F.col("_ext").isNotNull())
    known = once(known.select("video_id", "_ext", base.alias("_base")), _n=plain.try_cast("bigint"))
    bases = _bases(F.col("frame_id"))
    place = F.nullif(F.array_position(bases, F.col("_base")), F.lit(0)) * len(EXACT) + F.col("_ext")
    best = (
        keys.join(known.where("_n >= 0"), ["_n", "video_id"], "left")
        .groupBy("_n", "video_id", "frame_id")
        .agg(F.min(place.cast("int")).alias("_best"))
    )
    # The name is put together from its place, so that only numbers are compared and kept.
    at = F.floor(F.col("_best") / len(EXACT)).cast("int") - 1
    exact = F.concat(F.get(bases, at), F.get(F.array(*map(F.lit, EXACT)), F.col("_best") % len(EXACT)))
    most = keys.groupBy("video_id").agg(F.max("_n").alias("_most"))
    return best.join(_first_in_names(images, most), ["_n", "video_id"], "left").select(
        "video_id", "frame_id", F.coalesce(exact, "_inside").alias("image_name")
    )


def find_frames(wanted: DataFrame, images: DataFrame) -> DataFrame:
    """Image name of each wanted (video_id, frame_id), null when there is none.

    Known name patterns are tried first. What is left is looked up by six-digit prefix or suffix
    and by any candidate stem inside the name. Ids that are numbers, which need one lookup each, are dealt by number and
    video and never again; other ids go through all their stems.
    """
    number = F.col("frame_id").try_cast("bigint")
    spread = F.when(number >= 0, number).otherwise(-1 - F.pmod(F.xxhash64("frame_id"), F.lit(2**62)))
    # No folder has this name. Without nulls to filter, and with ids that come out of a list, nothing is filtered or left
    # out in front of the shuffle, so that all branches read the same one.
    nowhere = F.lit("\0")
    dealt = wanted.select(
        F.coalesce(spread, F.lit(-1)).alias("_n"), F.coalesce("video_id", nowhere).alias("video_id"), "frame_id"
    ).repartition("_n", "video_id")
    kinds = once(dealt, frame_id=F.col("frame_id"), _text=F.col("_n") < 0)
    keys = kinds.where(~F.col("_text")).select("_n", "video_id", "frame_id").distinct()
    texts = kinds.where("_text").select("video_id", "frame_id").distinct()
    names = images.select("video_id", "image_name")
    names = once(names, image_name=F.col("image_name"))
    some = names.join(F.broadcast(texts.select("video_id").distinct()), "video_id", "left_semi")
    found = _find_numbers(keys, names).unionByName(_find_texts(texts, some))
    return found.withColumn("video_id", F.nullif("video_id", nowhere))


def _find_texts(keys: DataFrame, images: DataFrame) -> DataFrame:
    """``find_frames`` of distinct ids of any form: substrings of the names are the join key, so images are not compared
    one by one.
    """
    exts = F.array(*map(F.lit, EXACT))
    based = keys.select("*", F.posexplode(_bases(F.col("frame_id"))).alias("_b", "_base"))
    candidates = based.select("*", F.posexplode(exts).alias("_e", "_ext")).withColumn(
        "image_name", F.concat("_base", "_ext")
    )
    exact = (
        candidates.join(images.select("video_id", "image_name"), ["video_id", "image_name"])
        .groupBy("video_id", "frame_id")
        .agg(F.min_by("image_name", F.struct("_b", "_e")).alias("image_name"))
    )
    open_keys = based.join(exact, ["video_id", "frame_id"], "left_anti")
    prefix = F.col("frame_id").try_cast("bigint").cast("string")
    prefix = F.when(F.length(prefix) >= 6, prefix).otherwise(F.lpad(prefix, 6, "0"))
    pieces = open_keys.select("video_id", "frame_id", F.col("_base").alias("piece")).unionByName(
        open_keys.select("video_id", "frame_id", prefix.alias("piece")).where(F.col("piece").isNotNull())
    )
    name = F.col("image_name")
    # Names are cut at every place into the lengths that the pieces of their video have, so that a name gives at most its
    # length times as many rows as there are different lengths.
    lengths = pieces.groupBy("video_id").agg(F.collect_set(F.length("piece")).alias("_lengths"))
    photos = images.where(extension(name).isin(".jpg", ".jpeg")).join(lengths, "video_id")
    inside = (
        photos.select("video_id", "image_name", F.explode("_lengths").alias("_len"))
        .where((F.col("_len") >= 1) & (F.col("_len") <= F.length(name)))
        .select("*", F.explode(F.sequence(F.lit(1), F.length(name) - F.col("_len") + 1)).alias("_at"))
        .select("video_id", "image_name", F.substring(name, F.col("_at"), F.col("_len")).alias("piece"))
        # Only the first name of a piece is wanted, so a piece of very many names meets the frames as one row.
        .groupBy("video_id", "piece")
        .agg(F.min("image_name").alias("image_name"))
    )
    loose = (
        pieces.distinct()
        .join(inside, ["video_id", "piece"])
        .groupBy("video_id", "frame_id")
        .agg(F.min("image_name").alias("image_name"))
    )
    found = exact.unionByName(loose)
    return keys.join(found, ["video_id", "frame_id"], "left")
