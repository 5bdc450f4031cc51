import random

import pytest
from brute import SCHEMA, documents, prose, statistics
from pyspark.sql import functions as F

from txnmill.llm import quality


def test_statistics_equal_brute_force(spark):
    rows = documents(3)
    out = {r["doc_id"]: r for r in quality.with_stats(spark.createDataFrame(rows, SCHEMA)).collect()}
    for doc_id, text, *_ in rows:
        assert tuple(out[doc_id][c] for c in quality.BASE_STATS) == statistics(text), text and text[:60]


def test_plan_has_no_python(spark):
    df = spark.createDataFrame(documents(3)[:5], SCHEMA)
    plan = quality.with_stats(df.where("doc_id >= 0"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowCache", "")


def labelled(spark, n=1500):
    """Bad texts have many symbols, or few distinct words; a twentieth of the good ones have some symbols."""
    rng, rows, labels = random.Random(2), [], []
    for i in range(n):
        kind = rng.random()
        w = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(30, 90))]
        if kind < 0.12:
            w = [x + "##" for x in w]
        elif kind < 0.24:
            w = [f"w{rng.randrange(6)}" for _ in w]
        elif rng.random() < 0.05:
            w[0] += "#"
        rows.append((i, " ".join(w), "en", "a", 0))
        if i % 3:
            labels.append((i, int(kind >= 0.24), 0))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_rules_hold_on_unlabelled_rows(spark):
    docs, labels, _ = labelled(spark)
    judged = quality.judge(docs, labels).where("doc_id % 3 = 0 and not base_failed")
    truth = (F.col("n_symbols") >= F.col("n_words")) | (F.col("n_distinct_words") <= 6)
    counts = judged.agg(F.count_if(truth & ~F.col("kept")).alias("caught"), F.count_if(truth).alias("bad"), F.count_if(~truth & ~F.col("kept")).alias("wrong")).first()
    assert counts["bad"] > 50 and counts["caught"] >= 0.95 * counts["bad"] and counts["wrong"] == 0


def test_list_is_ordered_and_readable(spark):
    rules = quality.DecisionList(((quality.Condition("words", False, 5.0),), (quality.Condition("symbol_rate", True, 0.5), quality.Condition("words", True, 10.0))))
    df = quality.with_stats(spark.createDataFrame([(1, "a# b#"), (2, "c# " * 12), (3, "d " * 12)], "doc_id int, text string"))
    out = {r["doc_id"]: (r["rule"], r["rejected"]) for r in df.select("doc_id", rules.first_rule().alias("rule"), rules.rejected().alias("rejected")).collect()}
    assert out == {1: (0, True), 2: (1, True), 3: (None, False)}
    assert str(rules) == "words < 5\nsymbol_rate >= 0.5 and words >= 10"


@pytest.mark.parametrize("labels", [[], [(1, None, None), (None, 0, 0), (99, 0, 1)], [(1, 1, 0)] * 9])
def test_without_useful_labels_only_the_base_rule_rejects(spark, labels):
    rows = [(1, prose(random.Random(1), 60), "en", "a", 0), (2, None, "en", "a", 0), (None, "short", "en", "a", 0), (1, prose(random.Random(1), 60), "en", "a", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS n_words", "1 AS _t", "2 AS kept")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs, marks)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1, 1]


def test_empty_table(spark):
    docs, marks = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(docs, marks).count() == 0 and quality.keep_good(docs, marks).count() == 0
