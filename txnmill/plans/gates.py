"""Gates that stop a run: validation and drift. Only small result tables reach the driver."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from ..operators import drift, rules
from ..operators.order import split_reference_current

log = logging.getLogger(__name__)


def validation_gate(df: DataFrame, suite: list[rules.Rule] | None = None, order: str | None = None) -> DataFrame:
    return rules.gate(df, suite or rules.processed_suite(), order)


def collected(table: DataFrame) -> DataFrame:
    """A small result table computed once: one row per watched column."""
    return table.sparkSession.createDataFrame(table.toArrow(), table.schema)


def drift_gate(
    df: DataFrame, method: str = "pvalue", thresholds: drift.Thresholds = drift.Thresholds(),
    time_column: str = "timestamp", id_column: str = "transaction_id",
) -> DataFrame:
    """Older half against newer half. Critical drift raises, a warning is logged; the verdicts are returned."""
    reference, current = split_reference_current(df, 0.5, time_column, id_column)
    verdicts = collected(drift.detect(reference, current, method))
    level = drift.severity(verdicts, thresholds).first()
    if level["severity"] == "critical":
        raise drift.DriftCritical(f"{level['drifted_columns']} of {level['total_columns']} columns have drifted")
    if level["severity"] == "warning":
        log.warning("%s of %s columns have drifted", level["drifted_columns"], level["total_columns"])
    return verdicts
