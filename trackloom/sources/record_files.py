"""A sink with one file per record: ``df.write.format("record_files")`` for rows of a relative path and a text.

Every task writes its files into a folder of its own attempt and moves whole files from there into the staged tree, which
lies beside the output folder. The driver renames the staged tree to the output folder once all tasks have reported, so
the output appears at once and whole. A failed task or a failed job leaves nothing behind under the output's name; a task
that runs again writes the same files again.
"""

from __future__ import annotations

import posixpath
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StringType, StructType

#: Files of a task that are held back before they move into the staged tree.
MOVE_EVERY = 1000
#: How often the staged tree is deleted again while tasks that were cancelled still end.
ABORT_TRIES = 50


def _filesystem(path: str):
    """(file system, path in it): of a URI, or of the machine for a plain path."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _checked(relative: str) -> str:
    clean = posixpath.normpath(relative or "")
    if clean in ("", ".") or clean.startswith(("/", "..")):
        raise ValueError(f"not a path below the output folder: {relative!r}")
    return clean


@dataclass
class Written(WriterCommitMessage):
    files: int


class RecordFilesWriter(DataSourceWriter):
    def __init__(self, out: str):
        self.out = out.rstrip("/")
        files, path = _filesystem(self.out)
        if files.get_file_info(path).type.name != "NotFound":
            raise FileExistsError(f"{self.out} is there already")
        folder, name = posixpath.split(self.out)
        self.stage = posixpath.join(folder, f".{name}-{uuid.uuid4().hex}")
        files, stage = _filesystem(self.stage)
        for part in ("attempts", "data"):
            files.create_dir(f"{stage}/{part}", recursive=True)

    def write(self, iterator: Iterator[Row]) -> Written:
        files, stage = _filesystem(self.stage)
        attempt = f"{stage}/attempts/{uuid.uuid4().hex}"
        files.create_dir(attempt, recursive=False)
        made: set[str] = set()
        held: list[str] = []
        count = 0

        def move() -> None:
            for k, relative in enumerate(held):
                target = f"{stage}/data/{relative}"
                parent = f"{stage}/data"
                for folder in relative.split("/")[:-1]:
                    parent += f"/{folder}"
                    if parent not in made:
                        files.create_dir(parent, recursive=False)
                        made.add(parent)
                files.move(f"{attempt}/{k}", target)
            held.clear()

        for row in iterator:
            relative = _checked(row[0])
            with files.open_output_stream(f"{attempt}/{len(held)}") as stream:
                stream.write((row[1] or "").encode())
            held.append(relative)
            count += 1
            if len(held) == MOVE_EVERY:
                move()
        move()
        return Written(count)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        if any(m is None for m in messages):
            raise RuntimeError("a task did not report its files")
        files, stage = _filesystem(self.stage)
        files.move(f"{stage}/data", _filesystem(self.out)[1])
        files.delete_dir(stage)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Other tasks may still write while the tree goes; they make no folder above their own, so they end too."""
        files, stage = _filesystem(self.stage)
        for _ in range(ABORT_TRIES):
            try:
                files.delete_dir(stage)
            except FileNotFoundError:
                return
            except OSError:
                time.sleep(0.2)


class RecordFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "record_files"

    def writer(self, schema: StructType, overwrite: bool) -> RecordFilesWriter:
        if [type(f.dataType) for f in schema.fields] != [StringType, StringType]:
            raise TypeError("record files are rows of two texts: the relative path and the content")
        if overwrite:
            raise ValueError("record files are never overwritten; name a new folder")
        return RecordFilesWriter(self.options["path"])


def sample_path(path: Column) -> Column:
    """``<sample>/<file>`` of a record's path, with the ``json`` or ``img`` folder between them if there is one."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    decoded = F.when(F.startswith(path, F.lit("file:")), plain).otherwise(path)
    return F.regexp_extract(decoded, "([^/]+/(?:(?:img|json)/)?[^/]+)$", 1)


def write_record_files(records: DataFrame, out: str) -> None:
    """Rows (path, value) as files ``out/<sample>/<file>``.

    Fails before anything is written if two records would be one file, or if ``out`` is there.
    """
    named = records.select(sample_path(F.col("path")).alias("path"), "value")
    twice = named.groupBy("path").count().where("count > 1").select("path").first()
    if twice:
        raise ValueError(f"two records would be the file {twice['path']!r}")
    records.sparkSession.dataSource.register(RecordFiles)
    named.write.format("record_files").mode("append").save(out)
