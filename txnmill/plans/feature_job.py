"""Feature job: read, normalise, split by time, engineer, write one table partitioned by split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import projection
from ..operators.features import ENCODED, FeatureState, engineer_splits
from ..operators.encoding import TargetEncoder
from ..operators.lookups import ratios_sum_to_one
from ..operators.order import TimeSplit
from ..sources.artifacts import read_feature_list, write_feature_list
from ..sources.readers import read_parquet, read_table
from ..sources.writers import write_splits


def build(
    df: DataFrame, train_ratio: float = 0.6, val_ratio: float = 0.2, smoothing: float = 10.0,
    per_split: bool = False, id_column: str = "transaction_id",
) -> tuple[DataFrame, FeatureState, list[str]]:
    """(feature table with target and ``split``, fitted state, feature names)."""
    if not ratios_sum_to_one(train_ratio, val_ratio, 1 - train_ratio - val_ratio):
        raise ValueError("split ratios must sum to 1")
    df = projection.normalize_schema(df)
    split = TimeSplit.fit(df, train_ratio, val_ratio, id_column=id_column)
    featured, state = engineer_splits(
        split.label(df), smoothing=smoothing, per_split=per_split, train=split.rows(df, "train")
    )
    names = [c for c in projection.feature_columns(featured) if c != "split"]
    return featured.select(*names, "is_fraud", "split"), state, names


def save_state(spark: SparkSession, state: FeatureState, names: list[str], path: str) -> None:
    state.encoder.save(f"{path}/encoder")
    write_feature_list(spark, names, f"{path}/feature_columns")
    spark.createDataFrame([(state.high_amount,)], "high_amount double").write.mode("overwrite").parquet(f"{path}/thresholds")


def load_state(spark: SparkSession, path: str) -> tuple[FeatureState, list[str]]:
    encoder = TargetEncoder.load(spark, f"{path}/encoder", ENCODED)
    high = spark.read.parquet(f"{path}/thresholds").first()["high_amount"]
    return FeatureState(encoder, high), read_feature_list(spark, f"{path}/feature_columns")


def write(df: DataFrame, output_path: str, **options) -> dict[str, str]:
    """Write the split table, the encoder, the thresholds and the feature list; return their paths."""
    table, state, names = build(df, **options)
    write_splits(table, f"{output_path}/features")
    save_state(df.sparkSession, state, names, f"{output_path}/state")
    return {"features": f"{output_path}/features", "state": f"{output_path}/state"}


def run(spark: SparkSession, input_path: str, output_path: str, **options) -> dict[str, str]:
    """``write`` for a stored table: CSV by suffix, anything else as Parquet."""
    df = read_table(spark, input_path) if input_path.endswith(".csv") else read_parquet(spark, input_path)
    return write(df, output_path, **options)


def rows_per_split(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).groupBy("split").agg(F.count("*").alias("rows"))
