import numpy as np
import pandas as pd
import pytest

from txnmill.operators import metrics


def brute(y, p):
    """ROC-AUC over all pairs and the step sum of precision over distinct scores."""
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap, seen = 0.0, 0
    for t in sorted(set(p), reverse=True):
        hit = y[p >= t].sum()
        ap += (hit - seen) / y.sum() * hit / (p >= t).sum()
        seen = hit
    return auc, ap


@pytest.mark.parametrize("buckets", [None, 3, 50])
def test_ranking_metrics_equal_brute_force(spark, buckets):
    rng = np.random.default_rng(3)
    y = (rng.random(300) < 0.2).astype(int)
    p = np.round(np.clip(y * 0.3 + rng.normal(0.4, 0.3, 300), 0, 1), 2)
    p[:100] = 0.31  # one score holds a third of the rows
    df = spark.createDataFrame(pd.DataFrame({"label": y, "prob": p}))
    row = metrics.classification_metrics(df, buckets=buckets).first()
    auc, ap = brute(y, p)
    assert row["roc_auc"] == pytest.approx(auc, abs=1e-12)
    assert row["pr_auc"] == pytest.approx(ap, abs=1e-12)
    pred = p >= 0.5
    assert row["precision"] == pytest.approx((y & pred).sum() / pred.sum())
    assert row["recall"] == pytest.approx((y & pred).sum() / y.sum())


def test_all_negative_gives_zero_and_no_auc(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.3), (0, 0.39)], "label int, prob double")
    row = metrics.classification_metrics(df).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["pr_auc"]) == (0, 0, 0, 0)
    assert row["roc_auc"] is None


def test_single_point_curve(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5)], "label int, prob double")
    assert [tuple(r) for r in metrics.precision_recall_curve(df).collect()] == [(0.5, 0.5, 1.0), (None, 1.0, 0.0)]
    assert metrics.classification_metrics(df).first()["roc_auc"] == 0.5


def test_confusion_matrix_has_four_rows(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, pred int")
    assert {tuple(r) for r in metrics.confusion_matrix(df).collect()} == {(0, 0, 2), (0, 1, 0), (1, 0, 1), (1, 1, 0)}
    row = metrics.threshold_metrics(df).first()
    assert tuple(row) == (0.0, 0.0, 0.0)


def test_long_form_has_five_metrics(spark):
    df = spark.createDataFrame([(0, 0.2), (1, 0.9)], "label int, prob double")
    out = {r["metric"]: r["value"] for r in metrics.evaluate(df, "validation").collect()}
    assert set(out) == set(metrics.METRICS) and all(0 <= v <= 1 for v in out.values())


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_score_is_an_error(spark, bad):
    df = spark.createDataFrame([(0, 0.2), (1, bad)], "label int, prob double")
    with pytest.raises(Exception, match="a score is missing"):
        metrics.classification_metrics(df).collect()
