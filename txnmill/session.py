"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import math
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Object store addresses are read in place by Hadoop's connector, where it is installed.
    "spark.hadoop.fs.s3.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    # Methods above this size are never compiled by HotSpot; smaller generated ones are.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app: str = "txnmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC and adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_own_folder: tempfile.TemporaryDirectory | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, readable by every executor.

    Only where the session names none (local runs and tests) is a temporary folder made.
    """
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.TemporaryDirectory(prefix="txnmill-")
        atexit.register(_own_folder.cleanup)
    return _own_folder.name


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing has to be cleared first."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, name: str = "stage"):
    """Write ``df`` to the shared folder and read it back, so a lost executor cannot undo it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a part: below the first dealing them out gains nothing, above the second a part is much for one task.
FEWEST, MOST = 20_000, 250_000


def parts_of(spark: SparkSession, rows: int) -> int:
    """How many even parts keep every core of the session busy on ``rows`` rows; 1 where they are too few to deal."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(rows // FEWEST, cores * math.ceil(rows / MOST / cores)))


def dealt(df, rows: int, name: str = "dealt"):
    """``df``, of ``rows`` rows, written to the shared folder in even parts. A file of one row group is one task, and so
    is all that is computed from it, until its rows are dealt out. Few rows stay as they are."""
    parts = parts_of(df.sparkSession, rows)
    return df if parts == 1 else cut_lineage(df.repartition(parts), name)
