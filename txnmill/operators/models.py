"""Training, scoring and comparison of classifiers with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import over_threshold
from ..session import cut_lineage, dealt
from ..sources.artifacts import read_feature_list, write_feature_list
from .ensemble import margin, probability, stored_nodes
from .metrics import evaluate
from .oversample import oversample_vectors
from .preprocess import Dictionary, Preprocessor, create_preprocessor
from .profile import class_weight

TARGET = "is_fraud"


@dataclass(frozen=True)
class TreeSettings:
    """Default hyperparameters."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    seed: int = 42


@dataclass(frozen=True)
class Trained:
    """A fitted preparation and classifier, and the table columns they take."""

    prepared: Preprocessor
    classifier: object
    features: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.classifier.transform(self.prepared.transform(df))


def _fit(df: DataFrame, features: list[str], classifier, weight, target: str, prepared: Preprocessor | None = None) -> Trained:
    """Fit on the prepared rows, which are stored in even parts: boosting runs a job for every level of every tree, and each
    would carry the whole preparation in its tasks and wait for the largest part."""
    prepared = prepared or create_preprocessor(df, features)
    rows = prepared.transform(df.select(*features, F.col(target).cast("double").alias("__label"), weight.alias("__weight")))
    return Trained(prepared, classifier.fit(dealt(rows.select("features", "__label", "__weight"), df.count(), "vectors")), features)


def _trees(settings: TreeSettings) -> GBTClassifier:
    return GBTClassifier(
        maxIter=settings.n_estimators,
        maxDepth=settings.max_depth,
        stepSize=settings.learning_rate,
        subsamplingRate=settings.subsample,
        featureSubsetStrategy=str(settings.colsample),
        seed=settings.seed,
        labelCol="__label",
        weightCol="__weight",
        featuresCol="features",
    )


def boosted_trees(
    df: DataFrame, features: list[str], settings: TreeSettings = TreeSettings(), target: str = TARGET,
    prepared: Preprocessor | None = None,
) -> Trained:
    """Gradient-boosted trees; positives weigh negatives / positives. ``prepared``, if given, was fitted on ``df``."""
    ratio = class_weight(df, target).first()[0]
    weight = F.when(F.col(target) == 1, F.lit(ratio)).otherwise(F.lit(1.0))
    return _fit(df, features, _trees(settings), weight, target, prepared)


def boosted_trees_oversampled(
    df: DataFrame, features: list[str], settings: TreeSettings = TreeSettings(), ratio: float = 0.1,
    target: str = TARGET, id_column: str = "transaction_id", prepared: Preprocessor | None = None,
) -> Trained:
    """Unweighted trees on a training set whose minority is oversampled after preparation, so that
    neighbours are near in scaled features. Scored rows go through preparation and trees only."""
    prepared = prepared or create_preprocessor(df, features)
    vectors = prepared.transform(df).select(F.col(id_column).cast("long").alias("id"), vector_to_array("features").alias("vec"), F.col(target).alias("target"))
    made = cut_lineage(oversample_vectors(vectors, prepared.width, ratio), "oversampled")
    rows = made.select(array_to_vector("vec").alias("features"), F.col("target").cast("double").alias("__label"), F.lit(1.0).alias("__weight"))
    return Trained(prepared, _trees(settings).fit(dealt(rows, made.count(), "vectors")), features)


def random_forest(df: DataFrame, features: list[str], settings: TreeSettings = TreeSettings(), target: str = TARGET) -> Trained:
    ratio = class_weight(df, target).first()[0]
    weight = F.when(F.col(target) == 1, F.lit(ratio)).otherwise(F.lit(1.0))
    forest = RandomForestClassifier(
        numTrees=settings.n_estimators, maxDepth=settings.max_depth, subsamplingRate=settings.subsample,
        featureSubsetStrategy=str(settings.colsample), seed=settings.seed, labelCol="__label", weightCol="__weight",
    )
    return _fit(df, features, forest, weight, target)


def balanced_logistic(
    df: DataFrame, features: list[str], target: str = TARGET, max_iter: int = 1000, prepared: Preprocessor | None = None,
) -> Trained:
    """Logistic regression; class c weighs n / (2 n_c)."""
    n = df.agg(F.count_if(F.col(target) == 1).alias("p"), F.count_if(F.col(target) == 0).alias("q")).first()
    rows = n["p"] + n["q"]
    weight = F.when(F.col(target) == 1, F.lit(rows / (2 * n["p"]))).otherwise(F.lit(rows / (2 * n["q"])))
    logistic = LogisticRegression(maxIter=max_iter, labelCol="__label", weightCol="__weight")
    return _fit(df, features, logistic, weight, target, prepared)


def retrain_on_train_val(train: DataFrame, val: DataFrame, features: list[str], settings: TreeSettings = TreeSettings(), target: str = TARGET) -> Trained:
    """A new fit, preparation and class weight included, on both splits together."""
    return boosted_trees(train.unionByName(val), features, settings, target)


def score(model: Trained, df: DataFrame, threshold: float = 0.5, target: str = TARGET, keep_target: bool = False) -> DataFrame:
    """``df`` without the target, plus ``fraud_probability`` and ``is_fraud_predicted``."""
    rows = df if keep_target else df.drop(target)
    scored = model.transform(rows)
    return scored.select(
        *rows.columns, vector_to_array("probability")[1].alias("fraud_probability")
    ).withColumn("is_fraud_predicted", over_threshold("fraud_probability", threshold))


def evaluate_model(trained: Trained, df: DataFrame, stage: str, target: str = TARGET) -> DataFrame:
    """(stage, metric, value) of a model on a labelled table."""
    scored = score(trained, df, target=target, keep_target=True)
    return evaluate(scored, stage, target, "fraud_probability")


def feature_importance(spark: SparkSession, trained: Trained, n: int | None = 15) -> DataFrame | None:
    """(feature, importance), largest first; none if the model has no importances."""
    if not hasattr(trained.classifier, "featureImportances"):
        return None
    # Features that no tree splits on have no entry and importance 0.
    found = trained.classifier.featureImportances
    held = {int(i): float(found[int(i)]) for i in found.indices} if hasattr(found, "indices") else dict(enumerate(map(float, found.toArray())))
    values = spark.createDataFrame(list(held.items()), "index int, importance double")
    table = trained.prepared.names().join(values, "index", "left").select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))
    ordered = table.orderBy(F.desc("importance"), "feature")
    return ordered if n is None else ordered.limit(n)


def save_model(spark: SparkSession, trained: Trained, path: str) -> None:
    """The stages with the dictionary, the feature lists and, of trees, the node table beside them."""
    PipelineModel([*trained.prepared.stages, trained.classifier]).write().overwrite().save(f"{path}/model")
    trained.prepared.dictionary.table.write.mode("overwrite").parquet(f"{path}/dictionary")
    write_feature_list(spark, trained.features, f"{path}/features")
    write_feature_list(spark, list(trained.prepared.dictionary.sizes), f"{path}/text")
    write_feature_list(spark, trained.prepared.numbers, f"{path}/numbers")
    if hasattr(trained.classifier, "treeWeights"):
        stored_nodes(spark, f"{path}/model", len(trained.prepared.stages)).write.mode("overwrite").parquet(f"{path}/nodes")


def load_model(spark: SparkSession, path: str) -> Trained:
    """A stored model. The dictionary stays a table on disk."""
    *stages, classifier = PipelineModel.load(f"{path}/model").stages
    table = spark.read.parquet(f"{path}/dictionary")
    dictionary = Dictionary.of(table, read_feature_list(spark, f"{path}/text"))
    return Trained(Preprocessor(dictionary, stages, read_feature_list(spark, f"{path}/numbers")), classifier, read_feature_list(spark, f"{path}/features"))


def score_both_ways(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """``df`` with the probability of the stored model and, beside it, that of its node table (``node_probability``)."""
    trained = load_model(spark, path)
    walked = probability(margin(spark.read.parquet(f"{path}/nodes"), F.col("__x")))
    scored = trained.transform(df).withColumns({"__x": vector_to_array("features"), "fraud_probability": vector_to_array("probability")[1]})
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], "fraud_probability", walked.alias("node_probability"))


def compare_candidates(
    train: DataFrame, val: DataFrame, features: list[str], settings: TreeSettings = TreeSettings(),
    ratio: float = 0.1, target: str = TARGET, id_column: str = "transaction_id",
) -> dict[str, tuple[Trained, DataFrame]]:
    """Three candidates by name, each with its validation metrics: balanced logistic regression,
    trees on oversampled data, trees with class weights. All are fitted on the same rows and share their preparation."""
    prepared = create_preprocessor(train, features)
    fits = {
        "logistic_balanced": lambda: balanced_logistic(train, features, target, prepared=prepared),
        "trees_oversampled": lambda: boosted_trees_oversampled(train, features, settings, ratio, target, id_column, prepared),
        "trees_weighted": lambda: boosted_trees(train, features, settings, target, prepared),
    }
    out = {}
    for name, fit in fits.items():
        trained = fit()
        out[name] = (trained, evaluate_model(trained, val, "validation", target).withColumn("run_id", F.lit(name)))
    return out
