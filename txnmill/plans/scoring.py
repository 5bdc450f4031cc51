"""Batch scoring job: file to file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import models
from ..operators.profile import predicted_total
from ..sources.readers import read_parquet
from ..sources.writers import write_parquet


def run(spark: SparkSession, model_path: str, input_path: str, output_path: str, threshold: float = 0.5) -> DataFrame:
    """Score every row of the input, write, and return (detected, rows) of what was written."""
    trained = models.load_model(spark, model_path)
    write_parquet(models.score(trained, read_parquet(spark, input_path), threshold), output_path)
    return predicted_total(spark.read.parquet(output_path))
