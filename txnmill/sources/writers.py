"""Table sinks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def dated_path(root: str, day: date) -> str:
    """root/YYYY/MM/DD"""
    return f"{root.rstrip('/')}/{day:%Y/%m/%d}"


def write_splits(df: DataFrame, path: str) -> str:
    """One table with a directory per split, so that reading one split skips the others.

    Rows stay in the tasks that made them: each task writes at most one file per split.
    """
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_split(spark, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("append").json(path)
    return path


def write_sorted(df: DataFrame, path: str, *order: str) -> str:
    """Range-partitioned and sorted by ``order``: the files follow one another in that order."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)
    return path
