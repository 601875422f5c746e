"""Image pixels and sizes through the built-in image source (bytes are blue, green, red)."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.fields import base_name, frame_index
from trackloom.sources.files import parent


def read_images(spark: SparkSession, root: str, index_rule: str = "all") -> DataFrame:
    """Images with sample, frame number, size, channels and pixel bytes; unreadable ones have null bytes."""
    path = F.col("image.origin")
    good = F.col("image.height") > 0
    return (
        spark.read.format("image")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(
            base_name(parent(path)).alias("video_id"),
            base_name(path).alias("file"),
            frame_index(path, index_rule).alias("frame_idx"),
            F.col("image.height").alias("height"),
            F.col("image.width").alias("width"),
            F.col("image.nChannels").alias("channels"),
            F.when(good, F.col("image.data")).alias("pixels"),
        )
    )


def resolutions(images: DataFrame) -> DataFrame:
    """Size of the first readable image of each sample by name."""
    good = images.where((F.col("height") > 0) & (F.col("width") > 0))
    return good.groupBy("video_id").agg(
        F.min_by("height", "file").alias("height"), F.min_by("width", "file").alias("width")
    )


def size_in_header(stream) -> tuple[int, int] | None:
    """(width, height) that the header of a JPEG or PNG file states; no pixel is read. None for other files."""
    head = stream.read(24)
    if head.startswith(b"\x89PNG\r\n\x1a\n") and len(head) == 24:
        return struct.unpack(">II", head[16:24])
    if not head.startswith(b"\xff\xd8"):
        return None
    at = 2
    while True:
        stream.seek(at)
        segment = stream.read(9)
        if len(segment) < 4 or segment[0] != 0xFF:
            return None
        kind = segment[1]
        if kind == 0xFF:
            at += 1
        elif kind == 0x01 or 0xD0 <= kind <= 0xD8:
            at += 2
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            if len(segment) < 9:
                return None
            height, width = struct.unpack(">HH", segment[5:9])
            return width, height
        elif kind in (0xD9, 0xDA):
            return None
        else:
            at += 2 + struct.unpack(">H", segment[2:4])[0]


def header_sizes(files: DataFrame, path: str = "path") -> DataFrame:
    """``files`` with ``width`` and ``height`` of the images at ``path`` (null where the header states none).

    Each task opens the files of its rows and reads their headers; a file that can't be opened fails the job.
    """
    from trackloom.sources.record_files import _filesystem

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = []
            for name in batch[path]:
                system, local = _filesystem(name)
                with system.open_input_file(local) as stream:
                    sizes.append(size_in_header(stream) or (None, None))
            batch["width"] = pd.array([s[0] for s in sizes], dtype="Int64")
            batch["height"] = pd.array([s[1] for s in sizes], dtype="Int64")
            yield batch

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return files.mapInPandas(read, f"{fields}, width bigint, height bigint")


def pixel_difference(gray: bool = False):
    """Vectorised mean absolute difference of two pixel byte columns of equal length.

    ``gray`` compares luma values, rounded as 8-bit images are; otherwise all channel bytes.
    """

    @F.pandas_udf("double")
    def difference(a: pd.Series, b: pd.Series) -> pd.Series:
        import numpy as np

        def values(data):
            flat = np.frombuffer(data, dtype=np.uint8)
            if not gray:
                return flat.astype(np.float64)
            blue, green, red = (flat[i::3].astype(np.float64) for i in range(3))
            return np.rint(0.299 * red + 0.587 * green + 0.114 * blue)

        out = [
            None
            if x is None or y is None or len(x) != len(y) or not len(x)
            else float(np.abs(values(x) - values(y)).mean())
            for x, y in zip(a, b)
        ]
        return pd.Series(out, dtype="float64")

    return difference
