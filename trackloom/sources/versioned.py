"""Several tables that become visible together.

Each writing goes into a folder of its own version; the manifest, which names the version and its tables, is moved into place
last. Readers go by the manifest: before it is there the folder is refused, and while a new version is being
written they keep reading the one before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from trackloom.sources.record_files import _filesystem

MANIFEST = "manifest.json"


def write_tables(tables: dict[str, DataFrame], out: str) -> str:
    """Writes the tables as a new version of ``out`` and returns its name. A table that fails leaves the version unseen."""
    out, version = out.rstrip("/"), f"v-{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.mode("errorifexists").parquet(f"{out}/{version}/{name}")
    files, path = _filesystem(out)
    text = json.dumps({"version": version, "tables": {n: t.schema.jsonValue() for n, t in tables.items()}}, sort_keys=True)
    with files.open_output_stream(f"{path}/{version}/{MANIFEST}") as stream:
        stream.write(text.encode())
    files.move(f"{path}/{version}/{MANIFEST}", f"{path}/{MANIFEST}")
    return version


def read_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of the version that the manifest names."""
    out = out.rstrip("/")
    files, path = _filesystem(out)
    if files.get_file_info(f"{path}/{MANIFEST}").type.name == "NotFound":
        raise FileNotFoundError(f"{out} has no complete version")
    with files.open_input_stream(f"{path}/{MANIFEST}") as stream:
        found = json.loads(stream.read())
    return {
        name: spark.read.schema(StructType.fromJson(schema)).parquet(f"{out}/{found['version']}/{name}")
        for name, schema in found["tables"].items()
    }
