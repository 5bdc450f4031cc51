"""Artificial drift: shifts, category replacement and nulls, by retry-stable draws."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import uniform
from ..functions.scalars import linear


def shift(df: DataFrame, column: str, multiplier: float = 1.0, offset: float = 0.0) -> DataFrame:
    """x -> x * multiplier + offset; an absent column is skipped."""
    return df.withColumn(column, linear(column, multiplier, offset)) if column in df.columns else df


def replace_category(df: DataFrame, column: str, value, probability: float, id_column: str = "transaction_id") -> DataFrame:
    """Each row takes ``value`` with the given probability; the column keeps its type."""
    if column not in df.columns:
        return df
    new = F.lit(value).cast(df.schema[column].dataType)
    hit = uniform(id_column, f"replace:{column}") < F.lit(probability)
    return df.withColumn(column, F.when(hit, new).otherwise(F.col(column)))


def inject_nulls(df: DataFrame, column: str, ratio: float, id_column: str = "transaction_id") -> DataFrame:
    """Each row's value is lost with the given probability."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.when(uniform(id_column, f"null:{column}") >= F.lit(ratio), F.col(column)))


def apply_scenario(df: DataFrame, scenario: str, id_column: str = "transaction_id") -> DataFrame:
    """none | mild | severe. Sizes and targets of the shifts."""
    if scenario == "none":
        return df
    if scenario == "mild":
        df = shift(df, "amount_inr", 1.05)
        return replace_category(df, "transaction_channel", "Online", 0.1, id_column)
    if scenario == "severe":
        df = shift(df, "amount_inr", 1.5, 500)
        df = inject_nulls(df, "merchant_city", 0.2, id_column)
        df = replace_category(df, "is_international", 1, 0.4, id_column)
        df = shift(df, "V1", 1.2, 0.5)
        return shift(df, "V4", 0.8, -0.5)
    raise ValueError(f"unknown scenario {scenario}")
