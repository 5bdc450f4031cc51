"""Training plan: enrich, gate, features, train, refit, evaluate, store. Parquet is the stage boundary."""

from __future__ import annotations

import logging
from dataclasses import asdict, dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import drift, models, projection, rules
from ..operators.enrich import EnrichmentSettings, enrich
from ..session import cut_lineage
from ..sources import runs
from ..sources.readers import SourceError, read_table
from ..sources.writers import dated_path, read_split, write_parquet
from . import feature_job, gates

log = logging.getLogger(__name__)

EXIT_OK, EXIT_GATE, EXIT_SOURCE, EXIT_ERROR = 0, 1, 2, 3


@dataclass(frozen=True)
class TrainingSettings:
    enrichment: EnrichmentSettings = field(default_factory=EnrichmentSettings)
    trees: models.TreeSettings = field(default_factory=models.TreeSettings)
    train_ratio: float = 0.6
    val_ratio: float = 0.2
    smoothing: float = 10.0
    skip_drift: bool = False


def enrich_and_store(raw: DataFrame, path: str, settings: EnrichmentSettings = EnrichmentSettings(), key: str | None = None) -> DataFrame:
    """Enrich, write, read back. Without a unique key column the whole row and its number among
    equal rows are the key, so every row has an id of its own."""
    if key is None:
        key = "__row_key"
        raw = keyed_rows(raw, key)
    write_parquet(enrich(raw, key, settings), path)
    return raw.sparkSession.read.parquet(path)


#: Parts that the copies of one row are numbered in.
PARTS = 64


def keyed_rows(raw: DataFrame, key: str) -> DataFrame:
    """``raw`` with a unique ``key``: a digest of the row and, for rows with copies, a number.

    Equal rows cannot be told apart, so they are numbered where they are: a row's number is its place in its task
    and part, and part and place together are the suffix. Only digests are grouped; the rows of a digest that repeats are
    numbered in ``PARTS`` windows, so one row that fills a third of the feed is no single group. One copy keeps the digest alone.
    """
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in raw.columns]
    # Stored, so that the parts of copies stay as dealt when a task is run again.
    hashed = cut_lineage(raw.withColumn(key, F.md5(F.concat_ws("|", *text))).withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.lit(PARTS))), "keyed")
    repeated = hashed.groupBy(key).agg(F.count("*").alias("__n"), F.min("__part").alias("__first")).where("__n > 1").select(F.col(key).alias("__key"), "__first")
    parts = hashed.select(key, "__part").distinct().join(repeated, F.col(key) == F.col("__key")).select("__key", F.col("__part").alias("__of"), "__first")
    marked = hashed.join(parts, (F.col(key) == F.col("__key")) & (F.col("__part") == F.col("__of")), "left")
    nth = F.row_number().over(Window.partitionBy("__key", "__of").orderBy("__key"))
    copies = marked.where("__key is not null").withColumn("__nth", nth)
    alone = (F.col("__nth") == 1) & (F.col("__of") == F.col("__first"))
    named = F.when(alone, F.col(key)).otherwise(F.concat_ws(":", key, "__of", "__nth"))
    columns = [F.col(f"`{c}`") for c in raw.columns]
    return marked.where("__key is null").select(*columns, key).union(copies.select(*columns, named.alias(key)))


def load_splits(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The three splits with integers widened by the train split's types."""
    train = read_split(spark, path, "train")
    return {s: projection.widen_integers(read_split(spark, path, s), train) for s in ("train", "val", "test")}


def parameters(settings: TrainingSettings, features: int) -> dict:
    """What a run was made with, as flat names."""
    flat = {k: v for k, v in asdict(settings).items() if not isinstance(v, dict)}
    return {**flat, **{f"trees.{k}": v for k, v in asdict(settings.trees).items()}, "features": features}


def train_and_store(spark: SparkSession, features_path: str, model_path: str, runs_path: str, run_id: str, settings: TrainingSettings = TrainingSettings()) -> DataFrame:
    """Fit on train, evaluate on validation, refit on both, evaluate that model on test, store it."""
    splits = load_splits(spark, features_path)
    names = [c for c in splits["train"].columns if c != "is_fraud"]
    first = models.boosted_trees(splits["train"], names, settings.trees)
    runs.log_run(models.evaluate_model(first, splits["val"], "validation"), runs_path, run_id)
    final = models.retrain_on_train_val(splits["train"], splits["val"], names, settings.trees)
    runs.log_run(models.evaluate_model(final, splits["test"], "test"), runs_path, run_id)
    runs.log_params(spark, parameters(settings, len(names)), f"{runs_path}_params", run_id)
    models.save_model(spark, final, model_path)
    return spark.read.parquet(runs_path).where(F.col("run_id") == run_id)


def run(spark: SparkSession, input_path: str, root: str, run_id: str, day: date, settings: TrainingSettings = TrainingSettings(), key: str | None = None) -> int:
    """0 done, 1 a gate stopped the run, 2 no input, 3 any other error."""
    out = dated_path(root, day)
    try:
        raw = read_table(spark, input_path)
        rules.gate(raw, rules.raw_suite())
        table = enrich_and_store(raw, f"{out}/transactions", settings.enrichment, key)
        gates.validation_gate(table, order="transaction_id")
        if not settings.skip_drift:
            gates.drift_gate(table)
        paths = feature_job.write(
            table, f"{out}/model_input", train_ratio=settings.train_ratio, val_ratio=settings.val_ratio,
            smoothing=settings.smoothing,
        )
        train_and_store(spark, paths["features"], f"{out}/model", f"{root}/runs", run_id, settings)
        return EXIT_OK
    except (rules.ValidationFailed, drift.DriftCritical) as e:
        log.error("stopped: %s", e)
        return EXIT_GATE
    except SourceError as e:
        log.error("no input: %s", e)
        return EXIT_SOURCE
    except Exception:
        log.exception("training run failed")
        return EXIT_ERROR
