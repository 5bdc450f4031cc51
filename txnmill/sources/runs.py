"""The run table: (run_id, ts, stage, metric, value), appended to by every job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_rows(metrics: DataFrame, run_id: str, ts: Column) -> DataFrame:
    """(stage, metric, value) rows as run rows."""
    return metrics.select(
        F.lit(run_id).alias("run_id"), ts.alias("ts"), "stage", "metric", F.col("value").cast("double").alias("value")
    )


def log_run(metrics: DataFrame, path: str, run_id: str, ts: Column | None = None) -> None:
    run_rows(metrics, run_id, ts if ts is not None else F.localtimestamp()).write.mode("append").parquet(path)


def log_params(spark, params: dict, path: str, run_id: str) -> None:
    """Parameters as text beside the metrics."""
    rows = [(run_id, k, str(v)) for k, v in params.items()]
    spark.createDataFrame(rows, "run_id string, param string, value string").write.mode("append").parquet(path)


def compare_stages(runs: DataFrame, base: str = "validation", other: str = "test", tolerance: float = 0.05) -> DataFrame:
    """Difference per run and metric between two stages; one grouped pass instead of a self-join."""
    pick = lambda s: F.max(F.when(F.col("stage") == s, F.col("value")))
    both = runs.groupBy("run_id", "metric").agg(pick(base).alias("base_value"), pick(other).alias("other_value"))
    gap = F.col("other_value") - F.col("base_value")
    return both.where("base_value is not null and other_value is not null").select(
        "run_id", "metric", "base_value", "other_value", gap.alias("difference"),
        F.when(F.abs(gap) < tolerance, "OK").otherwise("Warning").alias("status"),
    )


def champion(runs: DataFrame, metric: str = "pr_auc", stage: str = "validation") -> DataFrame:
    """The run with the highest value of the metric."""
    scored = runs.where((F.col("metric") == metric) & (F.col("stage") == stage))
    return scored.orderBy(F.desc("value"), "run_id").select("run_id", "value").limit(1)


def latest_version(versions: DataFrame) -> DataFrame:
    """(name, version, run_id) of the highest version of each model, compared as a number."""
    newest = F.max(F.struct(F.col("version").cast("int").alias("version"), "run_id")).alias("newest")
    return versions.groupBy("name").agg(newest).select("name", "newest.version", "newest.run_id")


def latest_artifacts(versions: DataFrame, artifacts: DataFrame) -> DataFrame:
    """The artefacts of the run behind each model's latest version."""
    return artifacts.join(latest_version(versions), "run_id")
