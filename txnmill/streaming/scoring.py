"""The scoring stream and the counters beside it. Every transformation also takes batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import scalars
from ..operators.features import FeatureState, engineer_requests
from ..operators.models import Trained, score
from ..operators.projection import align_columns
from ..operators.rules import request_contract, with_broken_rules
from .keyed import KeyedTable

# Upper bounds of the latency buckets, in seconds.
LATENCY_BOUNDS = (0.01, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0)


def read_requests(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = schemas.REQUEST, **options) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def score_requests(requests: DataFrame, model: Trained, features: list[str], state: FeatureState, keep: list[str] = []) -> DataFrame:
    """Contract, features, missing columns as 0, model, labels. Rows that break the contract keep
    their reasons and get no score, so one output holds both and nothing is lost.

    The joins inside are to a fitted encoder table (static side), so the stream keeps no state.
    """
    marked = with_broken_rules(requests, request_contract())
    featured = engineer_requests(marked, state)
    ready = align_columns(featured, [*keep, "broken", *features])
    scored = score(model, ready.drop("is_fraud"))
    accepted = F.size("broken") == 0
    probability = F.when(accepted, scalars.rounded_probability("fraud_probability"))
    return scored.select(
        *keep,
        "broken",
        F.when(accepted, F.col("is_fraud_predicted") == 1).alias("is_fraud"),
        probability.alias("fraud_probability"),
        F.when(accepted, scalars.risk_level("fraud_probability")).alias("risk_level"),
    )


def prediction_counters(scored: DataFrame) -> DataFrame:
    """Running totals by status and risk level."""
    status = F.when(F.col("is_fraud"), "fraud").otherwise("legit")
    return scored.where("is_fraud is not null").groupBy(status.alias("status"), "risk_level").agg(F.count("*").alias("n"))


def latency_histogram(df: DataFrame, latency: str = "latency", bounds: tuple[float, ...] = LATENCY_BOUNDS) -> DataFrame:
    """(bound, n): requests at or below each bound, the last row (+inf) counting all."""
    all_bounds = [*bounds, float("inf")]
    counts = df.agg(*[F.count_if(F.col(latency) <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(all_bounds)])
    rows = [F.struct(F.lit(b).alias("bound"), F.col(f"b{i}").alias("n")) for i, b in enumerate(all_bounds)]
    return counts.select(F.inline(F.array(*rows)))


def snapshots(df: DataFrame, time_column: str = "timestamp", width: str = "15 seconds", late: str = "1 minute", *keys: str) -> DataFrame:
    """Rows per tumbling window (and keys); the watermark bounds the state."""
    return (
        df.withWatermark(time_column, late)
        .groupBy(F.window(time_column, width).alias("w"), *keys)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), *keys, "n")
    )


def run_to_end(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet"):
    """Process everything that is there now, then stop. Append sinks only."""
    query = (
        stream.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _run_batches(stream: DataFrame, store, checkpoint: str, mode: str, interval: str | None):
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(store)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    query = writer.start()
    if interval is None:
        query.awaitTermination()
    return query


def run_totals(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None):
    """Keep the totals of an aggregate with a fixed number of groups current: every batch replaces all.

    With an interval (such as ``15 seconds``) the query keeps running; without, it ends when the
    input is used up.
    """
    table = KeyedTable(stream.sparkSession, path)
    return _run_batches(stream, table.replace, checkpoint, "complete", interval)


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The newest stored totals."""
    return KeyedTable(spark, path).read()


def run_updates(stream: DataFrame, path: str, checkpoint: str, *keys: str, interval: str | None = None):
    """Store the groups that each batch changed, by ``keys``. The state holds only windows that the watermark has
    not closed, so it does not grow with the length of the stream."""
    table = KeyedTable(stream.sparkSession, path, keys)
    return _run_batches(stream, table.update, checkpoint, "update", interval)


def read_updates(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """The last stored value of every key."""
    return KeyedTable(spark, path, keys).read()
