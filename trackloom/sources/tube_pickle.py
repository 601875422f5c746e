"""Tube pickles: read with an allow-list, one task per file, into a tube table."""

from __future__ import annotations

import io
import pickle
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# The only globals a tube pickle may name.
ALLOWED = {
    ("numpy", "ndarray"),
    ("numpy", "dtype"),
    ("numpy.core.multiarray", "_reconstruct"),
    ("numpy.core.multiarray", "scalar"),
    ("numpy.core.numeric", "_frombuffer"),
    ("numpy._core.multiarray", "_reconstruct"),
    ("numpy._core.multiarray", "scalar"),
    ("numpy._core.numeric", "_frombuffer"),
    ("_codecs", "encode"),
    ("collections", "OrderedDict"),
    ("collections", "defaultdict"),
    ("builtins", "list"),
    ("builtins", "dict"),
}
SCHEMA = (
    "path string, video_id string, class_id bigint, label_name string, tube_no bigint,"
    " frame_idx bigint, x1 double, y1 double, x2 double, y2 double"
)
META_SCHEMA = (
    "path string, video_id string, split string, nframes bigint, height bigint, width bigint"
)


class _Allowed(pickle.Unpickler):
    def find_class(self, module: str, name: str):
        if (module, name) not in ALLOWED:
            raise pickle.UnpicklingError(f"not allowed in a tube file: {module}.{name}")
        return super().find_class(module, name)


def load(content: bytes) -> dict:
    return _Allowed(io.BytesIO(content)).load()


def _tubes(path: str, data: dict) -> Iterator:
    """One frame of rows per tube."""
    import numpy as np
    import pandas as pd

    labels = data.get("labels") or []
    for video, classes in (data.get("gttubes") or {}).items():
        for class_id, tubes in classes.items() if isinstance(classes, dict) else ():
            number = int(class_id)
            name = labels[number] if 0 <= number < len(labels) else str(class_id)
            for tube_no, tube in enumerate(tubes if isinstance(tubes, list) else ()):
                rows = np.asarray(tube, dtype=float)
                if rows.ndim != 2 or not rows.size:
                    continue
                # a row too short for a frame and a box still counts as a frame of its tube
                box = rows[:, -4:].astype(object) if rows.shape[1] > 4 else np.full((len(rows), 4), None)
                yield pd.DataFrame(
                    {
                        "path": path,
                        "video_id": str(video),
                        "class_id": number,
                        "label_name": str(name),
                        "tube_no": tube_no,
                        "frame_idx": rows[:, 0].astype("int64"),
                        "x1": box[:, 0],
                        "y1": box[:, 1],
                        "x2": box[:, 2],
                        "y2": box[:, 3],
                    }
                )


def read_tubes(spark: SparkSession, path: str) -> DataFrame:
    """Tube table of pickle files; rows of fewer than five numbers have a null box."""

    def parse(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                yield from _tubes(name, load(content))

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(parse, SCHEMA)


def read_videos(spark: SparkSession, path: str) -> DataFrame:
    """Videos of pickle files with frame count, size and split (null when none lists them)."""

    def parse(batches):
        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                data = load(content)
                split = {}
                for key in ("train_videos", "val_videos", "test_videos"):
                    for group in data.get(key) or ():
                        for video in group if isinstance(group, (list, tuple)) else (group,):
                            split.setdefault(video, key.removesuffix("_videos"))
                sizes = data.get("resolution") or {}
                rows = [
                    (
                        name,
                        str(v),
                        split.get(v),
                        int((data.get("nframes") or {}).get(v, 0)),
                        *[int(s) for s in (sizes.get(v) or (0, 0))[:2]],
                    )
                    for v in data.get("videos") or (data.get("gttubes") or {})
                ]
                yield pd.DataFrame(
                    rows, columns=["path", "video_id", "split", "nframes", "height", "width"]
                )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(parse, META_SCHEMA)
