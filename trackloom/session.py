"""Session helpers."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of local applications that name none, by application.
_own_dirs: dict[str, str] = {}


def build_session(app: str = "trackloom", cpus: str | None = None) -> SparkSession:
    """Session for local runs; on a cluster ``spark-submit`` supplies master and sizes."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if cpus:
        builder = (
            builder.master(f"local[{cpus}]")
            .config("spark.sql.shuffle.partitions", cpus)
            .config("spark.driver.memory", os.environ.get("TRACKLOOM_DRIVER_MEMORY", "12g"))
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder the cluster names in ``spark.checkpoint.dir``; only a local session may go without one.

    A local session without the setting gets a folder of its own under ``/tmp``, which goes when Python ends. No setting
    is changed: core settings of a running session can't be.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        application = spark.sparkContext.applicationId
        if application not in _own_dirs:
            if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            _own_dirs[application] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
            atexit.register(shutil.rmtree, _own_dirs[application], ignore_errors=True)
        named = _own_dirs[application]
    return named.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For results that are read several times: the table outlives lost executors, is read column
    by column, and has a known size for the planner.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
