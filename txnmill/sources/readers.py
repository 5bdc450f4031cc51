"""Table readers."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas


class SourceError(ValueError):
    """The path is missing or its format is not supported."""


def map_scheme(spark: SparkSession, scheme: str, implementation: str) -> None:
    """Addresses ``scheme://`` are read by this Hadoop file system class, for instance those of an object store."""
    spark.conf.set(f"fs.{scheme}.impl", implementation)


def mount(spark: SparkSession, scheme: str, authority: str, target: str) -> None:
    """``scheme://authority/`` stands for the address ``target``, on the driver and in every task.

    Hadoop resolves the address when a file is opened, so paths are used as they are given and nothing is copied.
    """
    map_scheme(spark, scheme, "org.apache.hadoop.fs.viewfs.ViewFileSystemOverloadScheme")
    spark.conf.set(f"fs.viewfs.mounttable.{authority}.linkFallback", target)
    real = target.split(":", 1)[0] if ":" in target else "file"
    known = {"file": "org.apache.hadoop.fs.LocalFileSystem", "viewfs": "org.apache.hadoop.fs.viewfs.ViewFileSystem"}
    if real in known:
        spark.conf.set(f"fs.viewfs.overload.scheme.target.{real}.impl", known[real])


def read_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW) -> DataFrame:
    """CSV with a header and a declared schema, so no pass is spent on inference."""
    return _load(spark.read.schema(schema).option("header", True).format("csv"), path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return _load(spark.read.format("parquet"), path)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType = schemas.RAW, allowed: tuple[str, ...] = ("parquet", "csv")
) -> DataFrame:
    """Format by suffix: ``.parquet`` or ``.csv``, restricted to ``allowed``."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix not in allowed:
        raise SourceError(f"unsupported format: {path}")
    return read_csv(spark, path, schema) if suffix == "csv" else read_parquet(spark, path)


def _load(reader, path: str) -> DataFrame:
    try:
        return reader.load(path)
    except (AnalysisException, Py4JJavaError) as e:
        raise SourceError(f"cannot read {path}: {e}") from e
