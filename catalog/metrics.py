"""Classification metrics on scored tables."""

from txnmill.operators import metrics as M
from txnmill.functions.scalars import over_threshold

from .registry import F, query, r, rounded, scored, sql

G = dict(
    g="SELECT prob, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg FROM scored GROUP BY 1",
    c="SELECT *, sum(pos) OVER (ORDER BY prob DESC) AS tp, sum(neg) OVER (ORDER BY prob DESC) AS fp, sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g",
    k="SELECT count(*) FILTER (WHERE label = 1 AND prob >= 0.5)::DOUBLE AS tp, count(*) FILTER (WHERE label = 0 AND prob >= 0.5)::DOUBLE AS fp, count(*) FILTER (WHERE label = 1 AND prob < 0.5)::DOUBLE AS fn FROM scored",
)
AUC = "sum(pos * (N - fp + neg / 2)) / max(P * N)"
AP = "sum(pos / P * tp / (tp + fp))"


@query("ev1_precision_recall_f1", sql(f"SELECT {r('tp / (tp + fp)')} AS \"precision\", {r('tp / (tp + fn)')} AS recall, {r('2 * tp / (2 * tp + fp + fn)')} AS f1_score FROM k", "scored", **G))
def ev1(spark, sf):
    return rounded(M.threshold_metrics(scored(spark, sf).withColumn("pred", over_threshold("prob"))))


@query("ev2_roc_auc", sql(f"SELECT {r(AUC)} AS roc_auc FROM c", "scored", **G))
def ev2(spark, sf):
    return rounded(M.classification_metrics(scored(spark, sf)).select("roc_auc"))


@query("ev3_average_precision", sql(f"SELECT {r(AP)} AS pr_auc FROM c", "scored", **G))
def ev3(spark, sf):
    return rounded(M.classification_metrics(scored(spark, sf)).select("pr_auc"))


@query("ev4_precision_recall_curve", sql(f"SELECT {r('prob')} AS threshold, {r('tp / (tp + fp)')} AS \"precision\", {r('tp / P')} AS recall FROM c UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)", "scored", **G))
def ev4(spark, sf):
    return rounded(M.precision_recall_curve(scored(spark, sf)))


@query("ev5_confusion_matrix", sql(
    "SELECT CAST(l AS INT) AS label, CAST(p AS INT) AS predicted, (SELECT count(*) FROM scored WHERE label = l AND (prob >= 0.5)::INT = p) AS n FROM range(2) a(l), range(2) b(p)", "scored"))
def ev5(spark, sf):
    return M.confusion_matrix(scored(spark, sf).withColumn("pred", over_threshold("prob")))


@query("ev6_all_metrics", sql(
    f"SELECT 'test' AS stage, 'precision' AS metric, {r('tp / (tp + fp)')} AS value FROM k UNION ALL SELECT 'test', 'recall', {r('tp / (tp + fn)')} FROM k "
    f"UNION ALL SELECT 'test', 'f1_score', {r('2 * tp / (2 * tp + fp + fn)')} FROM k UNION ALL SELECT 'test', 'roc_auc', {r(AUC)} FROM c UNION ALL SELECT 'test', 'pr_auc', {r(AP)} FROM c", "scored", **G))
def ev6(spark, sf):
    return rounded(M.evaluate(scored(spark, sf)))


_SALES = "SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_extendedprice AS prob FROM lineitem"


@query("ev6_all_metrics_sales", f"WITH scored AS ({_SALES}), g AS ({G['g']}), c AS ({G['c']}) SELECT {r(AUC)} AS roc_auc, {r(AP)} AS pr_auc FROM c")
def ev6_sales(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"), F.col("l_extendedprice").alias("prob")
    )
    return rounded(M.classification_metrics(rows).select("roc_auc", "pr_auc"))


@query("ev6_metrics_of_labels", "WITH scored AS (SELECT quality AS label, CAST((doc_id * 37) % 101 AS DOUBLE) / 101 AS prob FROM labels), "
       f"g AS ({G['g']}), c AS ({G['c']}) SELECT {r(AUC)} AS roc_auc, {r(AP)} AS pr_auc FROM c")
def ev6_labels(spark, sf):
    rows = spark.read.parquet(f"{sf}/labels.parquet").selectExpr("quality AS label", "CAST((doc_id * 37) % 101 AS DOUBLE) / 101D AS prob")
    return rounded(M.classification_metrics(rows).select("roc_auc", "pr_auc"))
