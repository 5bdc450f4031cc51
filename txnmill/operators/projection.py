"""Projections and schema operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import scalars


def apply_types(df: DataFrame, types: dict[str, str] = schemas.STORAGE_TYPES) -> DataFrame:
    """Cast the columns that are present; the map may name absent ones."""
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def normalize_schema(df: DataFrame, start: str = "2024-01-01", unit: str = "s") -> DataFrame:
    """Give a raw feed the target, amount and timestamp columns; other tables pass unchanged."""
    if "Class" not in df.columns:
        return df
    return df.withColumns(
        {
            "is_fraud": F.col("Class"),
            "amount_inr": F.col("Amount"),
            "timestamp": scalars.timestamp_from_offset(start, "Time", unit),
        }
    )


def finalize(df: DataFrame) -> DataFrame:
    """Rename the target, drop the raw helpers, put the contract's columns first."""
    df = df.withColumnRenamed("Class", schemas.TARGET).drop("Time", "Amount", "amount_segment")
    first = [c for c in schemas.ENRICHED_COLUMNS if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def feature_columns(df: DataFrame, excluded: list[str] = schemas.NOT_FEATURES) -> list[str]:
    return [c for c in df.columns if c not in excluded]


def modeling_data(df: DataFrame, features: list[str] | None = None, target: str = schemas.TARGET) -> DataFrame:
    """Feature columns with the target last: one table, never a second one beside it."""
    return df.select(*(features or feature_columns(df)), target)


def widen_integers(df: DataFrame, like: DataFrame | None = None, keep: tuple[str, ...] = (schemas.TARGET,)) -> DataFrame:
    """Cast to double the columns that are integral in ``like`` (the train table by default)."""
    source = (like or df).schema
    wide = {f.name for f in source if isinstance(f.dataType, T.IntegralType) and f.name not in keep}
    return df.select(*[F.col(c).cast("double").alias(c) if c in wide else F.col(c) for c in df.columns])


def example_types(df: DataFrame) -> DataFrame:
    """Strings and doubles only, as a model input example needs."""
    casts = []
    for f in df.schema:
        if isinstance(f.dataType, T.IntegralType):
            casts.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.NumericType, T.TimestampNTZType)):
            casts.append(F.col(f.name))
        else:
            casts.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*casts)


def drop_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def align_columns(df: DataFrame, columns: list[str], fill=0) -> DataFrame:
    """Exactly ``columns`` in that order; absent ones become ``fill``."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def schema_diff(df: DataFrame, expected: list[str]) -> DataFrame:
    """One row per column name on either side: type, missing, extra, holds strings."""
    types = dict(df.dtypes)
    rows = [
        (name, types.get(name), name not in types, name not in expected, types.get(name) == "string")
        for name in sorted({*types, *expected})
    ]
    return df.sparkSession.createDataFrame(
        rows, "column string, type string, missing boolean, extra boolean, is_string boolean"
    )


def coerce_types(df: DataFrame, time_column: str = "timestamp", target: str = schemas.TARGET) -> DataFrame:
    """Timestamp from text where it is not one; target to a small integer where it is not integral."""
    kinds = {f.name: f.dataType for f in df.schema}
    if time_column in kinds and not isinstance(kinds[time_column], (T.TimestampNTZType, T.TimestampType)):
        df = df.withColumn(time_column, F.col(time_column).cast("timestamp_ntz"))
    if target in kinds and not isinstance(kinds[target], T.IntegralType):
        df = df.withColumn(target, F.col(target).cast("double").cast("smallint"))
    return df


def monitored(df: DataFrame, other: DataFrame | None = None) -> tuple[list[str], list[str]]:
    """Watched numeric and categorical columns that exist (on both sides, if two are given)."""
    there = set(df.columns) & set((other or df).columns)
    return (
        [c for c in schemas.DRIFT_NUMERIC if c in there],
        [c for c in schemas.DRIFT_CATEGORICAL if c in there],
    )
