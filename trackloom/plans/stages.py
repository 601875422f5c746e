"""Chains of stages that keep their tables, so that a run goes on where an earlier one ended.

The key of a stage is a digest of its name, its options, the files that it reads and the keys of the stages before it. Its
tables are written under one manifest; they are used again if a manifest of that key is there, so a stage that was
interrupted is built again and a stage whose input or options changed is built under another key, with all that follow it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.sources.versioned import read_tables, write_tables

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Stage:
    """``build`` makes named tables from the tables of the stages ``after``; ``files`` are paths that it reads beside them.

    ``options`` are plain values (as JSON has them) that ``build`` depends on.
    """

    name: str
    build: Callable[[dict[str, Tables]], Tables]
    after: tuple[str, ...] = ()
    files: tuple[str, ...] = ()
    options: dict = field(default_factory=dict)


def files_digest(spark: SparkSession, path: str) -> str:
    """Digest of the names, lengths and times of all files below a path; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    row = F.xxhash64("path", "length", "modificationTime")
    found = listed.select("path", "length", "modificationTime").agg(
        F.count(F.lit(1)), F.sum("length"), F.bit_xor(row), F.sum(row.cast("decimal(38,0)"))
    )
    return hashlib.sha256(repr(tuple(found.first())).encode()).hexdigest()


def stage_key(stage: Stage, files: list[str], before: list[str]) -> str:
    text = json.dumps([stage.name, stage.options, files, before], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def run_stages(spark: SparkSession, out: str, stages: list[Stage]) -> dict[str, Tables]:
    """The tables of every stage, read from ``out``; stages are in an order in which each follows those it needs."""
    done: dict[str, Tables] = {}
    keys: dict[str, str] = {}
    for stage in stages:
        if stage.name in done:
            raise ValueError(f"two stages are named {stage.name!r}")
        keys[stage.name] = stage_key(stage, [files_digest(spark, f) for f in stage.files], [keys[n] for n in stage.after])
        target = f"{out.rstrip('/')}/{stage.name}-{keys[stage.name]}"
        try:
            done[stage.name] = read_tables(spark, target)
        except FileNotFoundError:
            write_tables(stage.build({n: done[n] for n in stage.after}), target)
            done[stage.name] = read_tables(spark, target)
    return done
