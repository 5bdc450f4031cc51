"""Training, scoring, oversampling, streams and whole jobs on small tables."""

from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from test_tables import raw_feed

from txnmill import schemas, session
from txnmill.operators import drift, ensemble, features, models, order, oversample, preprocess, rules
from txnmill.plans import drift_job, feature_job, gates, scoring, training
from txnmill.sources import runs, writers
from txnmill.streaming import keyed
from txnmill.streaming import scoring as stream

SMALL = models.TreeSettings(n_estimators=3, max_depth=3)
NAMES = ["amount_inr", "hour", "card_tier", "V1"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 400
    y = (rng.random(n) < 0.15).astype("int32")
    pdf = pd.DataFrame({
        "amount_inr": rng.exponential(100, n) + 200 * y, "hour": rng.integers(0, 24, n), "card_tier": rng.choice(["Gold", "Classic"], n),
        "V1": rng.normal(size=n) + y, "is_fraud": y, "transaction_id": np.arange(n),
    })
    return spark.createDataFrame(pdf).cache()


@pytest.fixture(scope="module")
def trained(table):
    return models.boosted_trees(table, NAMES, SMALL)


def test_scoring_keeps_rows_and_drops_the_target(table, trained):
    out = models.score(trained, table)
    assert out.columns == ["amount_inr", "hour", "card_tier", "V1", "transaction_id", "fraud_probability", "is_fraud_predicted"]
    assert out.count() == 400
    low, high = out.agg(F.min("fraud_probability"), F.max("fraud_probability")).first()
    assert 0 <= low < high <= 1
    assert models.score(trained, table, 0.0).where("is_fraud_predicted = 0").count() == 0
    assert models.score(trained, table, 1.0).where("is_fraud_predicted = 1").count() == 0


def test_model_learns_and_ranks(table, trained, spark):
    metrics = {r["metric"]: r["value"] for r in models.evaluate_model(trained, table, "train").collect()}
    assert metrics["roc_auc"] > 0.8 and metrics["pr_auc"] > 0.5
    importance = models.feature_importance(spark, trained, 2).collect()
    assert len(importance) == 2 and importance[0]["importance"] >= importance[1]["importance"]
    assert {r["index"]: r["name"] for r in trained.prepared.names().collect()} == dict(enumerate(["card_tier_Gold", "amount_inr", "hour", "V1"]))


def test_unseen_and_missing_values_are_scored(spark, trained):
    rows = spark.createDataFrame([(None, 3, "Platinum", 0.1), (5.0, None, None, None)], "amount_inr double, hour int, card_tier string, V1 double")
    assert models.score(trained, rows).where("fraud_probability BETWEEN 0 AND 1").count() == 2


def test_save_load_gives_the_same_scores(spark, table, trained, tmp_path):
    models.save_model(spark, trained, str(tmp_path / "m"))
    again = models.load_model(spark, str(tmp_path / "m"))
    assert again.features == trained.features and sorted(again.prepared.names().collect()) == sorted(trained.prepared.names().collect())
    assert models.score(again, table).exceptAll(models.score(trained, table)).count() == 0
    table.write.parquet(str(tmp_path / "rows"))
    row = scoring.run(spark, str(tmp_path / "m"), str(tmp_path / "rows"), str(tmp_path / "out")).first()
    assert row["rows"] == 400 and 0 < row["detected"] < 400


def test_node_table_scores_as_the_model(spark, table, trained, tmp_path):
    """The relation gives the library's probabilities, for numbers and for indicators on either side of a split."""
    rng = np.random.default_rng(2)
    n = 600
    kinds = rng.choice(["a", "b", "c", "d"], n)
    y = ((kinds == "b") ^ (rng.random(n) < 0.1)).astype("int32")
    pdf = pd.DataFrame({"kind": kinds, "x": rng.normal(size=n) - y, "is_fraud": y})
    rows = spark.createDataFrame(pdf)
    for fitted, df in ((trained, table), (models.boosted_trees(rows, ["kind", "x"], models.TreeSettings(n_estimators=6, max_depth=4)), rows)):
        path = str(tmp_path / f"m{len(df.columns)}")
        models.save_model(spark, fitted, path)
        nodes = spark.read.parquet(f"{path}/nodes")
        assert nodes.where("low is null").count() == nodes.where("low is not null").count() + nodes.select("tree").distinct().count()
        compared = models.score_both_ways(spark, path, df)
        assert compared.where("abs(fraud_probability - node_probability) > 1e-12").count() == 0
        assert compared.count() == df.count()
    plan = compared._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_a_tree_of_one_leaf_and_no_tree(spark):
    empty = spark.createDataFrame([], ensemble.NODES)
    one = spark.createDataFrame([(0, 2.0, 0, None, None, None, None, 1.5)], ensemble.NODES)
    row = spark.range(1).select(ensemble.margin(empty, F.array(F.lit(1.0))), ensemble.margin(one, F.array(F.lit(1.0)))).first()
    assert tuple(row) == (0.0, 3.0)


def test_the_walk_makes_the_vector_once(spark):
    """What makes the vector stands outside the steps of the walk, which would run it anew in each."""
    nodes = spark.createDataFrame([(0, 1.0, 0, 0, 0.5, 1, 2, None), (0, 1.0, 1, None, None, None, None, 1.0), (0, 1.0, 2, None, None, None, None, 2.0)], ensemble.NODES)
    rows = spark.range(3).select("id", array_to_vector(F.array(F.col("id").cast("double"))).alias("v")).select("id", vector_to_array("v").alias("x"))
    walked = rows.select("id", ensemble.margin(nodes, F.col("x")).alias("m"))
    assert {r["id"]: r["m"] for r in walked.collect()} == {0: 1.0, 1: 2.0, 2: 2.0}
    plan = walked._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" in plan and "UDF" not in plan[plan.index("CASE WHEN"):plan.index(" THEN ")]


def test_any_number_of_categories(spark):
    """A dictionary of 100,000 values: sparse vectors, all zeros for unseen values, nulls and the first value."""
    rows = spark.range(120_000).selectExpr("concat('v', lpad(CAST(id % 100000 AS STRING), 6, '0')) AS name", '''IF(id % 2 = 0, "o'k `x`", 'other') AS `odd name`''', "CAST(id AS double) AS x")
    prepared = preprocess.create_preprocessor(rows, ["name", "odd name", "x"])
    assert prepared.dictionary.sizes == {"name": 99_999, "odd name": 1} and prepared.width == 100_001
    tried = spark.createDataFrame([("v000000", "other", 0.0), ("v000001", "o'k `x`", 0.0), ("v099999", None, None), ("unseen", "unseen", 1.0), (None, "other", 2.0)], "name string, `odd name` string, x double")
    found = {r["name"]: r["features"] for r in prepared.transform(tried).collect()}
    assert all(v.size == 100_001 and type(v).__name__ == "SparseVector" for v in found.values())
    ones = {k: [i for i in v.indices.tolist() if i < 100_000] for k, v in found.items()}
    assert ones == {"v000000": [99_999], "v000001": [0], "v099999": [99_998], "unseen": [], None: [99_999]}
    assert {r["index"]: r["name"] for r in prepared.names().where("index in (0, 99999, 100000)").collect()} == {0: "name_v000001", 99_999: "odd name_other", 100_000: "x"}
    listed = preprocess.sparse_indicators(tried.select("name", "odd name"), prepared.dictionary).collect()
    assert sorted(r["indices"] for r in listed) == [[], [0], [99_998], [99_999], [99_999]]


def test_no_importances_without_trees(spark, table):
    logistic = models.balanced_logistic(table, NAMES, max_iter=5)
    assert models.feature_importance(spark, logistic) is None
    assert models.random_forest(table, NAMES, SMALL).classifier.getNumTrees == 3


# --- oversampling -----------------------------------------------------------------

def points(spark, n=120, dims=3):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, dims))
    x[: n // 3] = x[0]  # a third are copies
    rows = [(i, [float(v) for v in x[i]]) for i in range(n)]
    return x, spark.createDataFrame(rows, "id long, vec array<double>")


def test_near_rows_are_near(spark):
    x, df = points(spark, 300)
    got = oversample.near_rows(df, 3, 5).collect()
    assert len(got) == 300
    ratios = []
    for r in got:
        near = np.array(r["near"])
        assert len(near) == 5
        best = np.sort(np.delete(((x - x[r["id"]]) ** 2).sum(1), r["id"]))[:5].sum()
        ratios.append((((near - x[r["id"]]) ** 2).sum() + 1e-9) / (best + 1e-9))
    assert np.median(ratios) < 1.5


def test_blocks_see_both_sides(spark, monkeypatch):
    monkeypatch.setattr(oversample, "BLOCK", 50)
    df = spark.createDataFrame([(i, [float(i)]) for i in range(400)], "id long, vec array<double>")
    for r in oversample.near_rows(df, 1, 2).collect():
        others = sorted(abs(v[0] - r["id"]) for v in r["near"])
        assert others == ([1, 2] if r["id"] in (0, 399) else [1, 1])


@pytest.mark.parametrize("ratio", [0.3, 0.9, 0.01])
def test_oversampling_reaches_the_ratio(spark, table, ratio):
    feats = ["amount_inr", "V1"]
    out = oversample.oversample(table, feats, ratio=ratio)
    before = {r["is_fraud"]: r["count"] for r in table.groupBy("is_fraud").count().collect()}
    after = {r["is_fraud"]: r["count"] for r in out.groupBy("is_fraud").count().collect()}
    assert after == {0: before[0], 1: max(before[1], int(ratio * before[0]))}
    span = table.where("is_fraud = 1").agg(*[f(c).alias(f"{n}{c}") for c in feats for n, f in (("lo", F.min), ("hi", F.max))]).first()
    made = out.where("is_fraud = 1")
    assert made.where(f"amount_inr < {span['loamount_inr'] - 1e-9} OR amount_inr > {span['hiamount_inr'] + 1e-9} OR V1 < {span['loV1'] - 1e-9} OR V1 > {span['hiV1'] + 1e-9}").count() == 0


def test_candidates_are_compared_and_the_best_is_found(spark, table):
    train, val = table.where("transaction_id % 4 < 3"), table.where("transaction_id % 4 = 3")
    found = models.compare_candidates(train, val, NAMES, models.TreeSettings(n_estimators=2, max_depth=2), ratio=0.5)
    assert set(found) == {"logistic_balanced", "trees_oversampled", "trees_weighted"}
    rows = [r for _, m in found.values() for r in m.collect()]
    assert len(rows) == 15 and all(0 <= r["value"] <= 1 for r in rows)
    best = runs.champion(spark.createDataFrame(rows)).first()
    assert best["value"] == max(r["value"] for r in rows if r["metric"] == "pr_auc")
    oversampled = found["trees_oversampled"][0]
    assert models.score(oversampled, val).count() == val.count()


def test_candidates_share_their_preparation(table, monkeypatch):
    """The preparation is fitted once for the three candidates."""
    made, fit = [], models.create_preprocessor
    monkeypatch.setattr(models, "create_preprocessor", lambda *a, **b: made.append(1) or fit(*a, **b))
    train, val = table.where("transaction_id % 4 < 3"), table.where("transaction_id % 4 = 3")
    assert len(models.compare_candidates(train, val, NAMES, models.TreeSettings(n_estimators=1, max_depth=1), ratio=0.5)) == 3
    assert len(made) == 1


# --- rows dealt out ---------------------------------------------------------------------

def sizes(df):
    return sorted(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())


def one_file(spark, path, n):
    rows = spark.range(n).selectExpr("id", "CAST(id % 7 AS double) AS x", "CAST(id % 5 = 0 AS int) AS is_fraud")
    rows.coalesce(1).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_rows_are_dealt_by_their_number(spark, tmp_path):
    few, many = one_file(spark, tmp_path / "few", 30_000), one_file(spark, tmp_path / "many", 100_000)
    assert session.dealt(few, 30_000) is few
    out = session.dealt(many, 100_000)
    assert len(sizes(many)) == 1 and len(sizes(out)) == 5 and sizes(out)[-1] < 21_000
    assert out.schema == many.schema and out.exceptAll(many).count() == 0 and out.count() == 100_000
    cores = spark.sparkContext.defaultParallelism
    assert [session.parts_of(spark, n) for n in (0, 39_999, 40_000, 30_000_000)] == [1, 1, 2, cores * -(-120 // cores)]


def test_a_fit_reads_even_parts(spark, tmp_path):
    """Rows of one row group are not one task of the fit, and the preparation is no part of its tasks."""
    seen = []

    class Classifier:
        def fit(self, rows):
            seen.append(rows)

    rows = one_file(spark, tmp_path / "rows", 100_000)
    models._fit(rows, ["x"], Classifier(), F.lit(1.0), "is_fraud")
    assert len(sizes(seen[0])) == 5 and seen[0].agg(F.sum("__label")).first()[0] == 20_000
    assert "UDF" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


# --- streams ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def request_state(spark):
    raw = raw_feed(spark, 300)
    from txnmill.operators.enrich import enrich

    table = enrich(raw, "row_key")
    featured, state = features.engineer_splits(order.with_time_split(table), per_split=False)
    names = ["amount_inr", "card_tier", "card_age", "hour", "log_amount", "intl_online", "night_high_amount", "merchant_category_encoded", "V1", "V4"]
    return table, models.boosted_trees(featured.where("split = 'train'"), names, SMALL), names, state


def test_stream_equals_batch(spark, request_state, tmp_path):
    table, trained, names, state = request_state
    requests = table.selectExpr(
        "transaction_id", "amount_inr AS amount", "CAST(hour(timestamp) * 3600 AS double) AS time", "card_tier", "CAST(credit_limit AS double) AS credit_limit",
        "card_age", "IF(card_age = 7, 'ATM', transaction_channel) AS transaction_channel", "is_international", "is_recurring",
        "IF(card_age = 9, 'Unheard', merchant_category) AS merchant_category", *schemas.COMPONENTS)
    requests.repartition(3).write.parquet(str(tmp_path / "in"))
    source = stream.read_requests(spark, str(tmp_path / "in"), schema=requests.schema, maxFilesPerTrigger=1)
    score = lambda df: stream.score_requests(df, trained, names, state, keep=["transaction_id"])
    stream.run_to_end(score(source), str(tmp_path / "out"), str(tmp_path / "mark"))
    got, want = spark.read.parquet(str(tmp_path / "out")), score(requests)
    assert got.count() == 300 and got.exceptAll(want).count() == 0
    rejected = got.where("size(broken) > 0")
    assert rejected.count() == table.where("card_age = 7").count()
    assert rejected.where("fraud_probability IS NOT NULL").count() == 0
    counted = stream.prediction_counters(want)
    live = stream.prediction_counters(score(stream.read_requests(spark, str(tmp_path / "in"), schema=requests.schema, maxFilesPerTrigger=1)))
    stream.run_totals(live, str(tmp_path / "totals"), str(tmp_path / "mark2"))
    assert sorted(stream.read_totals(spark, str(tmp_path / "totals")).collect()) == sorted(counted.collect())


def test_snapshots_over_many_batches_equal_batch(spark, tmp_path):
    rows = spark.range(200).selectExpr("timestamp_seconds(1700000000 + id * 7) AS timestamp", "id % 3 AS k")
    for i in range(4):
        rows.where(f"timestamp >= timestamp_seconds({1700000000 + i * 350}) AND timestamp < timestamp_seconds({1700000000 + (i + 1) * 350})").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = stream.read_requests(spark, str(tmp_path / "in"), schema=rows.schema, maxFilesPerTrigger=1, latestFirst="false")
    stream.run_updates(stream.snapshots(source, "timestamp", "15 seconds", "1 hour", "k"), str(tmp_path / "out"), str(tmp_path / "mark"), "window_start", "k")
    got = stream.read_updates(spark, str(tmp_path / "out"), "window_start", "k")
    want = rows.groupBy(F.window("timestamp", "15 seconds").alias("w"), "k").count().select("w.start", "k", "count")
    assert sorted(got.collect()) == sorted(want.collect())


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir())


def test_a_keyed_table_stays_small(spark, tmp_path):
    """However many batches: at most a base, its predecessor and the changes since; every read is the last value."""
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ("k",), every=5)
    want, sizes = {}, []
    for epoch in range(23):
        rows = [(k, epoch * 100 + k) for k in range(epoch % 4, 8, 3)]
        want.update(rows)
        table.update(spark.createDataFrame(rows, "k int, v int").coalesce(1), epoch)
        sizes.append(len(folders(tmp_path / "t")))
        if epoch % 6 == 0:
            assert dict(map(tuple, table.read().collect())) == want
    assert dict(map(tuple, table.read().collect())) == want and max(sizes) <= 2 * 5 + 2


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    """A batch that failed after its write runs again: before and after a compaction, and with a torn one left behind."""
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ("k",), every=3)
    batch = lambda *rows: spark.createDataFrame(list(rows), "k int, v int").coalesce(1)
    for epoch in range(4):
        table.update(batch((1, epoch), (2 + epoch, epoch)), epoch)
    before = sorted(table.read().collect())
    table.update(batch((1, 3), (5, 3)), 3)
    table.update(batch((1, 2), (4, 2)), 2)
    assert sorted(table.read().collect()) == before
    # A folder without the mark of a finished write is no part of the table.
    (tmp_path / "t" / "base=9").mkdir()
    (tmp_path / "t" / "part=9").mkdir()
    assert sorted(table.read().collect()) == before
    totals = keyed.KeyedTable(spark, str(tmp_path / "all"))
    for epoch in (0, 1, 2, 3, 3, 4):
        totals.replace(batch((1, epoch)), epoch)
    assert [tuple(r) for r in totals.read().collect()] == [(1, 4)] and len(folders(tmp_path / "all")) <= 2


def test_latency_buckets_are_cumulative(spark):
    df = spark.createDataFrame([(v,) for v in (0.005, 0.01, 0.15, 3.0)], "latency double")
    assert [r["n"] for r in stream.latency_histogram(df).orderBy("bound").collect()] == [2, 2, 2, 3, 3, 3, 3, 4]


# --- jobs ---------------------------------------------------------------------------

def test_training_run_end_to_end(spark, tmp_path):
    raw = raw_feed(spark, 400)
    source = str(tmp_path / "raw.csv")
    writers.write_csv(raw.select(*schemas.RAW_COLUMNS), source)
    settings = training.TrainingSettings(trees=SMALL, skip_drift=True)
    day = date(2024, 1, 31)
    assert training.run(spark, source, str(tmp_path / "root"), "run1", day, settings) == training.EXIT_OK
    logged = {r["param"]: r["value"] for r in spark.read.parquet(str(tmp_path / "root/runs_params")).collect()}
    assert logged["train_ratio"] == "0.6" and logged["trees.n_estimators"] == str(settings.trees.n_estimators)
    out = tmp_path / "root/2024/01/31"
    sizes = {r["split"]: r["rows"] for r in feature_job.rows_per_split(spark, f"{out}/model_input/features").collect()}
    assert sizes == {"train": 240, "val": 80, "test": 80}
    logged = spark.read.parquet(f"{tmp_path}/root/runs")
    assert logged.count() == 10 and runs.compare_stages(logged).count() == 5
    assert runs.champion(logged).first()["run_id"] == "run1"
    state, names = feature_job.load_state(spark, f"{out}/model_input/state")
    trained = models.load_model(spark, f"{out}/model")
    assert trained.features == names and "card_tier" in names and "user_id" not in names


def test_equal_rows_have_ids_of_their_own(spark):
    rows = [(1.0, "a"), (1.0, "a"), (1.0, "a"), (2.0, None), (2.0, None), (None, "a")]
    keys = [r["k"] for r in training.keyed_rows(spark.createDataFrame(rows, "x double, y string"), "k").collect()]
    assert len(set(keys)) == len(rows) and sum(":" not in k for k in keys) == 3


def test_training_run_stops(spark, tmp_path):
    day = date(2024, 1, 31)
    assert training.run(spark, str(tmp_path / "none.csv"), str(tmp_path), "r", day) == training.EXIT_SOURCE
    bad = raw_feed(spark, 20).withColumn("Amount", F.lit(-1.0)).select(*schemas.RAW_COLUMNS)
    writers.write_csv(bad, str(tmp_path / "bad.csv"))
    assert training.run(spark, str(tmp_path / "bad.csv"), str(tmp_path), "r", day) == training.EXIT_GATE


def test_drift_gate_and_job(spark, tmp_path):
    rows = spark.range(300).selectExpr(
        "id AS transaction_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS timestamp",
        "CAST(id AS double) AS amount_inr", "IF(id < 150, 'POS', 'Online') AS transaction_channel")
    with pytest.raises(drift.DriftCritical):
        gates.drift_gate(rows)
    stable = rows.withColumns({"amount_inr": F.col("amount_inr") % 10, "transaction_channel": F.lit("POS")})
    assert drift.severity(gates.drift_gate(stable)).first()["severity"] == "none"
    rows.write.parquet(str(tmp_path / "a.parquet"))
    stable.write.parquet(str(tmp_path / "b.parquet"))
    assert drift_job.run(spark, str(tmp_path / "a.parquet")) == 2
    assert drift_job.run(spark, str(tmp_path / "b.parquet"), report_path=str(tmp_path / "report")) == 0
    assert spark.read.json(str(tmp_path / "report")).count() == 2
    assert drift_job.run(spark, str(tmp_path / "b.parquet"), scenario="severe") >= 1
    assert drift_job.run(spark, str(tmp_path / "none.parquet")) == 3


def test_validation_gate(spark):
    with pytest.raises(rules.ValidationFailed):
        gates.validation_gate(spark.range(3))
