"""Training, scoring and comparison, at the default settings and over all feature columns.

Fitted values have no SQL form. What SQL can hold: the ids that are scored and that a model's node table, walked as a
relation, gives the scores of the library; and the scores of a node table that is given.
"""

from pyspark.errors import AnalysisException

from txnmill.operators import ensemble, models, order, oversample, projection
from txnmill.operators import features as feats
from txnmill.session import cut_lineage, new_path, shared_folder
from txnmill.sources import runs

from .registry import F, dealt_txn, query, r, rounded, sql, txn

ID = "transaction_id"
SPLITS = {
    "numbered": "SELECT *, row_number() OVER (ORDER BY timestamp, transaction_id) AS rn, count(*) OVER () AS n FROM txn",
    "test": "SELECT * FROM numbered WHERE rn > CAST(floor(n * 0.8::DOUBLE) AS BIGINT)",
}


def _table(session, sf):
    """The feature table, written as the training job does."""
    featured, _ = feats.engineer_splits(order.with_time_split(dealt_txn(session, sf)))
    return cut_lineage(featured, "features")


def names_of(table):
    return [c for c in projection.feature_columns(table) if c not in ("split", "is_fraud")]


def stored_model(session, sf):
    """Path of the model that the training job of this session stored for ``sf``; the first caller trains it."""
    path = f"{shared_folder(session).rstrip('/')}/trained-{session.sparkContext.applicationId}-{abs(hash(sf)):x}"
    try:
        # Written last, so a model without it is no model.
        session.read.parquet(f"{path}/nodes")
    except AnalysisException:
        table = _table(session, sf)
        models.save_model(session, models.boosted_trees(table.where("split = 'train'"), names_of(table)), path)
    return path


def _fitted(session, sf):
    return models.load_model(session, stored_model(session, sf))


def _split(spark, sf, name):
    return _table(spark, sf).where(F.col("split") == name)


@query("ml6_boosted_trees")
def ml6(spark, sf):
    return models.evaluate_model(_fitted(spark, sf), _split(spark, sf, "val"), "validation")


@query("ml7_balanced_logistic")
def ml7(spark, sf):
    table = _table(spark, sf)
    trained = models.balanced_logistic(table.where("split = 'train'"), names_of(table))
    return models.evaluate_model(trained, table.where("split = 'val'"), "validation")


# The synthetic values have no SQL form, but the number of rows per class does.
@query("ml8_oversampling", sql("SELECT is_fraud, CASE WHEN is_fraud = 1 THEN greatest(n, (SELECT n FROM c WHERE is_fraud = 0) * 3 // 10) ELSE n END AS n FROM c",
    c="SELECT is_fraud, count(*) AS n FROM txn GROUP BY 1"))
def ml8(spark, sf):
    base = txn(spark, sf).select(ID, "amount_inr", "card_age", "V1", "V7", "is_fraud")
    made = oversample.oversample(base, ["amount_inr", "card_age", "V1", "V7"], ratio=0.3)
    return made.groupBy("is_fraud").agg(F.count("*").alias("n"))


@query("ml9_batch_scoring")
def ml9(spark, sf):
    return models.score(_fitted(spark, sf), _split(spark, sf, "test")).select(ID, "fraud_probability", "is_fraud_predicted")


@query("ml10_retrain_on_both")
def ml10(spark, sf):
    table = _table(spark, sf)
    both = models.retrain_on_train_val(table.where("split = 'train'"), table.where("split = 'val'"), names_of(table))
    return models.evaluate_model(both, table.where("split = 'test'"), "test")


@query("ml11_final_evaluation")
def ml11(spark, sf):
    return models.evaluate_model(_fitted(spark, sf), _split(spark, sf, "test"), "test")


@query("ml12_compare_candidates")
def ml12(spark, sf):
    table = _table(spark, sf)
    found = models.compare_candidates(table.where("split = 'train'"), table.where("split = 'val'"), names_of(table))
    out = None
    for _, table in found.values():
        out = table if out is None else out.unionByName(table)
    return out


@query("ml13_feature_importance")
def ml13(spark, sf):
    return models.feature_importance(spark, _fitted(spark, sf), None)


@query("t8_top_importances")
def t8(spark, sf):
    return models.feature_importance(spark, _fitted(spark, sf), 15)


@query("io10_model_save_load")
def io10(spark, sf):
    path = new_path(spark, "model")
    models.save_model(spark, _fitted(spark, sf), path)
    return models.score(models.load_model(spark, path), _split(spark, sf, "test")).select(ID, "fraud_probability", "is_fraud_predicted")


@query("io12_score_file_to_file")
def io12(spark, sf):
    from txnmill.plans import scoring
    from txnmill.sources.writers import write_parquet

    rows = new_path(spark, "rows")
    write_parquet(_split(spark, sf, "test"), rows)
    return scoring.run(spark, stored_model(spark, sf), rows, new_path(spark, "scored"))


def agrees():
    return F.abs(F.col("fraud_probability") - F.col("node_probability")) < 1e-12


@query("ml9_scores_equal_node_table", sql("SELECT transaction_id, TRUE AS agrees FROM test", "txn", **SPLITS))
def ml9_nodes(spark, sf):
    return models.score_both_ways(spark, stored_model(spark, sf), _split(spark, sf, "test")).select(ID, agrees().alias("agrees"))


@query("io10_copy_equals_node_table", sql("SELECT transaction_id, TRUE AS agrees FROM test", "txn", **SPLITS))
def io10_nodes(spark, sf):
    """A model that was loaded and stored again, against the node table of the copy and the scores of the first."""
    copy = new_path(spark, "model")
    trained = _fitted(spark, sf)
    models.save_model(spark, trained, copy)
    rows = _split(spark, sf, "test")
    first = models.score(trained, rows).select(ID, F.col("fraud_probability").alias("first"))
    both = models.score_both_ways(spark, copy, rows).select(ID, "fraud_probability", "node_probability").join(first, ID)
    return both.select(ID, (agrees() & (F.col("fraud_probability") == F.col("first"))).alias("agrees"))


@query("io12_file_equals_node_table", sql("SELECT transaction_id, TRUE AS agrees FROM test", "txn", **SPLITS))
def io12_nodes(spark, sf):
    """The file that the scoring job wrote, against the node table."""
    from txnmill.plans import scoring
    from txnmill.sources.writers import write_parquet

    rows, out = new_path(spark, "rows"), new_path(spark, "scored")
    write_parquet(_split(spark, sf, "test"), rows)
    scoring.run(spark, stored_model(spark, sf), rows, out)
    written = spark.read.parquet(out).select(ID, F.col("fraud_probability").alias("written"), "is_fraud_predicted")
    walked = models.score_both_ways(spark, stored_model(spark, sf), spark.read.parquet(rows)).select(ID, "node_probability")
    same = (F.abs(F.col("written") - F.col("node_probability")) < 1e-12) & (F.col("is_fraud_predicted") == (F.col("written") >= 0.5).cast("int"))
    return written.join(walked, ID).select(ID, same.alias("agrees"))


# A given ensemble: (tree, weight, node, feature, threshold, low, high, value) over GIVEN_FEATURES.
GIVEN_FEATURES = ["V1", "amount_inr", "card_age", "V14"]
GIVEN_NODES = [
    (0, 1.0, 0, 1, 100.0, 1, 2, None), (0, 1.0, 1, 0, 0.5, 3, 4, None), (0, 1.0, 2, 3, 0.25, 5, 6, None),
    (0, 1.0, 3, None, None, None, None, -0.75), (0, 1.0, 4, None, None, None, None, -0.25), (0, 1.0, 5, None, None, None, None, 0.5), (0, 1.0, 6, 2, 30.0, 7, 8, None),
    (0, 1.0, 7, None, None, None, None, 0.125), (0, 1.0, 8, None, None, None, None, 0.875),
    (1, 0.5, 0, 2, 12.0, 1, 2, None), (1, 0.5, 1, None, None, None, None, 0.25), (1, 0.5, 2, 0, 0.75, 3, 4, None),
    (1, 0.5, 3, None, None, None, None, -0.5), (1, 0.5, 4, None, None, None, None, 0.625),
    (2, 0.25, 0, None, None, None, None, 0.5),
]


def _given() -> str:
    cell = lambda v: "NULL" if v is None else f"{v}::DOUBLE" if isinstance(v, float) else str(v)
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in GIVEN_NODES) + ") AS t(tree, weight, node, feature, threshold, low, high, val)"


@query("ml9_given_node_table",
    "WITH RECURSIVE " + sql(
        f"SELECT transaction_id, {r('1 / (1 + exp(-2 * sum(weight * val)))', 9)} AS fraud_probability FROM walk JOIN nodes USING (tree, node) WHERE low IS NULL GROUP BY 1",
        nodes=_given(), rows=f"SELECT transaction_id, [{', '.join(GIVEN_FEATURES)}] AS x FROM txn",
        walk="SELECT transaction_id, x, tree, 0 AS node FROM rows, (SELECT DISTINCT tree FROM nodes) UNION ALL "
             "SELECT w.transaction_id, w.x, w.tree, CASE WHEN w.x[n.feature + 1] <= n.threshold THEN n.low ELSE n.high END FROM walk w JOIN nodes n USING (tree, node) WHERE n.low IS NOT NULL",
    ).removeprefix("WITH "))
def ml9_given(spark, sf):
    nodes = spark.createDataFrame(GIVEN_NODES, ensemble.NODES)
    x = F.array(*[F.col(c).cast("double") for c in GIVEN_FEATURES])
    return rounded(txn(spark, sf).select(ID, ensemble.probability(ensemble.margin(nodes, x)).alias("fraud_probability")), 9)
