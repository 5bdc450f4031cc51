"""Feature engineering, shared by the batch job and the scoring stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from .encoding import TargetEncoder
from .order import exact_quantiles

SPLITS = ("train", "val", "test")
ENCODED = "merchant_category"


def add_time_features(df: DataFrame, time_column: str = "timestamp", night_hours=scalars.NIGHT_HOURS) -> DataFrame:
    if time_column not in df.columns:
        return df
    return df.withColumns(
        {
            "hour": scalars.hour_of(time_column),
            "day_of_week": scalars.day_of_week(time_column),
            "is_night": scalars.is_night(time_column, night_hours),
            "is_weekend": scalars.is_weekend(time_column),
        }
    )


def add_clock_features(df: DataFrame, seconds: str = "time", night_hours=scalars.NIGHT_HOURS) -> DataFrame:
    """The same features from an elapsed-seconds clock, as scoring requests carry one."""
    return df.withColumns({"hour": scalars.clock_hour(seconds), "day_of_week": scalars.clock_day(seconds)}).withColumns(
        {
            "is_night": scalars.flag(F.col("hour").isin(*night_hours)),
            "is_weekend": scalars.flag(F.col("day_of_week").isin(*scalars.WEEKEND_DAYS)),
        }
    )


def add_amount_features(df: DataFrame, amount: str = "amount_inr") -> DataFrame:
    return df.withColumn("log_amount", scalars.log_amount(amount))


def add_interaction_features(df: DataFrame, threshold=None) -> DataFrame:
    """``threshold`` is the log amount above which a night transaction counts as high (a number or
    a column); without one the feature is skipped, as it is when its inputs are absent."""
    there = set(df.columns)
    if {"is_international", "transaction_channel"} <= there:
        df = df.withColumn("intl_online", scalars.intl_online())
    if threshold is not None and {"is_night", "log_amount"} <= there:
        limit = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
        df = df.withColumn("night_high_amount", scalars.night_high_amount("is_night", "log_amount", limit))
    return df


def high_amount_thresholds(df: DataFrame, q: float = 0.9, per_split: bool = False, **search) -> dict[str, float | None]:
    """The q-quantile of ``log_amount``: of each split, or that of train for all splits."""
    if not per_split:
        fitted = exact_quantiles(df.where("split = 'train'").select("log_amount"), {"log_amount": [q]}, **search)
        return dict.fromkeys(SPLITS, fitted["log_amount"][0])
    by_split = df.select(*[F.when(F.col("split") == s, F.col("log_amount")).alias(s) for s in SPLITS])
    found = exact_quantiles(by_split, {s: [q] for s in SPLITS}, **search)
    return {s: found[s][0] for s in SPLITS}


def threshold_column(thresholds: dict[str, float | None]):
    out = F.lit(None).cast("double")
    for split, value in thresholds.items():
        out = F.when(F.col("split") == split, F.lit(value).cast("double")).otherwise(out)
    return out


@dataclass(frozen=True)
class FeatureState:
    """What a fit leaves behind: the encoder and the log-amount threshold of the train split."""

    encoder: TargetEncoder
    high_amount: float


def engineer(df: DataFrame, state: FeatureState | None = None, threshold=None) -> DataFrame:
    """Time, amount and interaction features, then the encoding if a fitted state is given."""
    df = add_amount_features(add_time_features(df))
    limit = threshold if threshold is not None else (state.high_amount if state else None)
    df = add_interaction_features(df, limit)
    return state.encoder.transform(df) if state and ENCODED in df.columns else df


def engineer_splits(
    df: DataFrame, target: str = "is_fraud", smoothing: float = 10.0, per_split: bool = False,
    train: DataFrame | None = None, **search
) -> tuple[DataFrame, FeatureState]:
    """Features for a table with a ``split`` column; everything fitted sees the train rows only
    (``train``, if given: the same rows by a filter that the scan can use).

    The train split's amount quantile serves all splits for ``night_high_amount``, which is what a
    scoring job repeats; ``per_split`` takes each split's own.
    """
    base = add_amount_features(add_time_features(df))
    thresholds = high_amount_thresholds(base, per_split=per_split, **search)
    fitted_on = df.where("split = 'train'") if train is None else train
    encoder = TargetEncoder.fit(fitted_on, ENCODED, target, smoothing)
    state = FeatureState(encoder, thresholds["train"])
    featured = add_interaction_features(base, threshold_column(thresholds))
    return encoder.transform(featured), state


def engineer_requests(df: DataFrame, state: FeatureState) -> DataFrame:
    """The same features for scoring requests (batch or stream)."""
    df = df.withColumn("amount_inr", F.col("amount"))
    df = add_amount_features(add_clock_features(df))
    return state.encoder.transform(add_interaction_features(df, state.high_amount))
