"""Artefact tables: feature lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def feature_list(spark: SparkSession, features: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(features)), "pos int, name string")


def write_feature_list(spark: SparkSession, features: list[str], path: str) -> str:
    feature_list(spark, features).write.mode("overwrite").parquet(path)
    return path


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    return [r["name"] for r in spark.read.parquet(path).orderBy("pos").collect()]
