"""Drift job: reference against current (or a perturbed reference half), with an exit level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift, perturb
from ..operators.order import split_reference_current
from ..sources.readers import read_parquet
from ..sources.writers import write_json
from .gates import collected

EXIT_LEVELS = {"none": 0, "warning": 1, "critical": 2}
EXIT_ERROR = 3


def drift_report(reference: DataFrame, current: DataFrame, method: str = "pvalue", path: str | None = None) -> DataFrame:
    """The severity row with its exit level; the verdicts are appended to ``path`` if one is given."""
    verdicts = collected(drift.detect(reference, current, method))
    if path:
        write_json(verdicts.withColumn("at", F.current_timestamp()), path)
    row = drift.severity(verdicts)
    level = F.lit(None).cast("int")
    for name, code in EXIT_LEVELS.items():
        level = F.when(F.col("severity") == name, code).otherwise(level)
    return row.withColumn("exit_level", level)


def run(
    spark: SparkSession, reference_path: str, current_path: str | None = None, scenario: str = "none",
    method: str = "pvalue", report_path: str | None = None, id_column: str = "transaction_id",
) -> int:
    """0 none, 1 warning, 2 critical, 3 error. Without a current table the reference is halved by
    time and its newer half perturbed by the scenario."""
    try:
        reference = read_parquet(spark, reference_path)
        if current_path:
            current = read_parquet(spark, current_path)
        else:
            reference, current = split_reference_current(reference, id_column=id_column)
            current = perturb.apply_scenario(current, scenario, id_column)
        return drift_report(reference, current, method, report_path).first()["exit_level"]
    except Exception:
        import logging

        logging.getLogger(__name__).exception("drift job failed")
        return EXIT_ERROR
