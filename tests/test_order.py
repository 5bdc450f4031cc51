import math
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txnmill.operators import order

TIGHT = dict(slots=4, finish_rows=3, brackets=False)
QUICK = dict(finish_rows=3)


def skewed(n=2000, seed=0):
    """A third of the rows share one value; the rest are spread over many magnitudes."""
    rng = np.random.default_rng(seed)
    values = np.round(np.exp(rng.normal(3, 3, n)), 3) * rng.choice([-1, 1], n)
    values[: n // 3] = 7.25
    return rng.permutation(values)


@pytest.mark.parametrize("search", [{}, TIGHT, QUICK])
def test_quantiles_equal_numpy_under_ties(spark, search):
    values = skewed()
    df = spark.createDataFrame(pd.DataFrame({"x": values, "k": np.arange(len(values))})).repartition(5)
    ps = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    ours = order.exact_quantiles(df, {"x": ps, "k": [0.5]}, **search)
    assert np.allclose(ours["x"], np.quantile(values, ps), rtol=1e-12)
    assert ours["k"] == [(len(values) - 1) / 2]


def test_quantiles_skip_missing_and_handle_empty(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert order.exact_quantiles(df, {"x": [0.5]}) == {"x": [2.0]}
    assert order.exact_quantiles(df.where("x < 0"), {"x": [0.5]}) == {"x": [None]}


def test_rank_values_count_rows_below_and_equal(spark):
    df = spark.createDataFrame([(v,) for v in [5, 1, 5, 5, 9]], "x long")
    hit = order.order_statistics(df, {"x": [2]}, **TIGHT)["x"][2]
    assert (hit.value, hit.below, hit.equal) == (5, 1, 3)


def test_wide_integers_do_not_overflow(spark):
    values = [-(2 ** 62), -5, 0, 3, 2 ** 62, 2 ** 62 + 1, 2 ** 63 - 1]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    found = order.order_statistics(df, {"x": list(range(len(values)))}, slots=4, finish_rows=1)["x"]
    assert [found[i].value for i in range(len(values))] == values


def transactions(spark, n=900, text=False):
    """A third of the rows share one timestamp."""
    rng = np.random.default_rng(1)
    seconds = rng.integers(0, 50, n)
    seconds[: n // 3] = 25
    ids = rng.permutation(n)
    pdf = pd.DataFrame({"transaction_id": [f"t{i}" for i in ids] if text else ids, "s": seconds})
    return spark.createDataFrame(pdf).selectExpr(
        "transaction_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS timestamp"
    )


@pytest.mark.parametrize("text", [False, True])
@pytest.mark.parametrize("search", [{}, TIGHT, QUICK])
def test_time_split_is_exact_under_ties(spark, text, search):
    df = transactions(spark, text=text)
    out = order.with_time_split(df, 0.4, 0.35, **search).toPandas()
    assert out["split"].value_counts().to_dict() == {"train": 360, "val": 315, "test": 225}
    ends = out.groupby("split")["timestamp"].agg(["min", "max"])
    assert ends.loc["train", "max"] <= ends.loc["val", "min"]
    assert ends.loc["val", "max"] <= ends.loc["test", "min"]
    if not text:
        ordered = out.sort_values(["timestamp", "transaction_id"])["split"].tolist()
        assert ordered == ["train"] * 360 + ["val"] * 315 + ["test"] * 225


@pytest.mark.parametrize("text", [False, True])
def test_rows_of_a_split_equal_its_label(spark, text):
    df = transactions(spark, 300, text).withColumn("timestamp", F.expr("IF(hash(transaction_id) % 9 = 0, NULL, timestamp)"))
    fitted = order.TimeSplit.fit(df)
    labelled = fitted.label(df)
    for split in ("train", "val", "test"):
        rows = fitted.rows(df, split)
        assert rows.exceptAll(labelled.where(F.col("split") == split).drop("split")).count() == 0
        assert rows.count() == labelled.where(F.col("split") == split).count()


def test_micros_are_free_of_the_session_zone(spark):
    from txnmill.functions.scalars import micros_of, timestamp_literal

    texts = ["1969-12-31 23:59:59.999999", "2024-03-31 02:30:00.000001", "2024-10-27 02:30:00"]
    want = []
    for zone in ("UTC", "Europe/Berlin"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "CAST(t AS timestamp_ntz) AS ts")
            want.append([r[0] for r in df.select(micros_of("ts")).collect()])
            for t, m in zip(texts, want[-1]):
                assert df.where(F.col("ts") == timestamp_literal(m)).first()["t"] == t
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert want[0] == want[1] and want[0][0] == -1


def test_split_loses_no_rows_without_timestamps(spark):
    df = transactions(spark, 30).withColumn("timestamp", F.when(F.col("transaction_id") % 7 != 0, F.col("timestamp")))
    first, rest = order.split_reference_current(df, 0.5)
    assert first.count() == 15 and rest.count() == 15
    assert rest.where("timestamp is null").count() == df.where("timestamp is null").count()


def test_random_split_is_exact_and_stable(spark):
    df = spark.range(501).withColumnRenamed("id", "transaction_id")
    a, b = order.random_split(df, 0.3, **TIGHT)
    c, _ = order.random_split(df.repartition(7), 0.3)
    assert (a.count(), b.count()) == (150, 351)
    assert a.intersect(b).count() == 0
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in c.collect())


def test_random_split_edges(spark):
    df = spark.range(10).withColumnRenamed("id", "transaction_id")
    a, b = order.random_split(df, 1.0)
    assert (a.count(), b.count()) == (10, 0)
    a, b = order.random_split(df, 0.0)
    assert (a.count(), b.count()) == (0, 10)


@pytest.mark.parametrize("buckets", [2, 7, 64])
@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_do_not_depend_on_buckets(spark, buckets, descending):
    values = pd.Series(np.unique(skewed()))
    pdf = pd.DataFrame({"g": np.arange(len(values)) % 3, "x": values, "n": np.arange(len(values)) % 5})
    df = order.with_buckets(spark.createDataFrame(pdf), ["x"], buckets)
    out = order.running_sums(df, "x", ["n"], "x__b", ["g"], descending).toPandas()
    expected = pdf.sort_values("x", ascending=not descending).copy()
    expected["cum"] = expected.groupby("g")["n"].cumsum()
    joined = out.merge(expected, on=["g", "x"])
    assert len(joined) == len(pdf) and (joined["cum_n"] == joined["cum"]).all()


def test_split_reads_few_columns_and_shuffles_no_rows(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumnsRenamed({"event_id": "transaction_id", "ts": "timestamp"})
    train = order.TimeSplit.fit(base).rows(base, "train").select("value")
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in plan


@pytest.mark.parametrize("values", [
    [math.inf, 1.0, 2.0, -math.inf, 3.0, math.inf, 2.0],
    [-1.7e308, 1.7e308, 0.0, 1e308, -1e308] * 3,
    [math.inf] * 5,
    [5e-324, 0.0, 1e-323, 5e-324],
    [-math.inf, math.nan, 4.0],
])
def test_ranks_with_infinite_and_extreme_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ranked = sorted(v for v in values if not math.isnan(v))
    for search in (TIGHT, {}):
        found = order.order_statistics(df, {"x": list(range(len(ranked)))}, **search)["x"]
        assert [found[i].value for i in range(len(ranked))] == ranked
        assert all(found[i].below == sum(v < w for v in ranked) and found[i].equal == ranked.count(w) for i, w in enumerate(ranked))


def test_quantiles_with_infinite_values(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(math.inf,)], "x double")
    assert order.exact_quantiles(df, {"x": [0.0, 0.5, 1.0]}, **TIGHT)["x"] == [0.0, 50.0, math.inf]


@pytest.mark.parametrize("seed", range(4))
def test_brackets_find_every_rank(spark, seed):
    """Any ranks of many columns in one scan: ties, skew, infinities, missing values, integers and near neighbours."""
    rng = np.random.default_rng(seed)
    n = 3000
    pdf = pd.DataFrame({
        "skew": skewed(n, seed), "ties": rng.choice([1.0, 2.0, 2.0, 2.0, 5.0], n), "endless": rng.choice([-math.inf, math.inf, 0.5, -3.0], n),
        "missing": np.where(rng.random(n) < 0.4, np.nan, rng.normal(size=n)), "one": 7.0, "close": 1.0 + rng.integers(0, 50, n) * 2.0**-52,
    })
    df = spark.createDataFrame(pdf).withColumn("whole", F.expr("CAST(floor(skew) AS BIGINT) % 1000000")).repartition(4)
    back = df.toPandas()
    ranks, want = {}, {}
    for c in [*pdf.columns, "whole"]:
        sorted_ = np.sort(back[c][~back[c].isna()].to_numpy())
        ranks[c] = sorted({0, len(sorted_) - 1, *rng.integers(0, len(sorted_), 6).tolist()})
        want[c] = {r: (sorted_[r], int((sorted_ < sorted_[r]).sum()), int((sorted_ == sorted_[r]).sum())) for r in ranks[c]}
    found = order.order_statistics(df, ranks, finish_rows=3)
    got = {c: {r: (v.value, v.below, v.equal) for r, v in of.items()} for c, of in found.items()}
    assert got == want


def test_wide_brackets_are_narrowed(spark, monkeypatch):
    monkeypatch.setattr(order, "INSIDE", 0)
    values = skewed(4000, 9)
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    found = order.order_statistics(df, {"x": [0, 700, 2000, 2001, 3999]}, finish_rows=3, slots=8)["x"]
    assert [found[r].value for r in (0, 700, 2000, 2001, 3999)] == np.sort(values)[[0, 700, 2000, 2001, 3999]].tolist()


def test_quantiles_take_two_scans(spark, tmp_path):
    """However many ranks and columns: one job for sketches, one for the brackets."""
    spark.range(60_000).selectExpr("id AS a", "CAST(id * 7 % 1000 AS double) AS b", "rand(3) AS c").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quantiles", "")
    order.exact_quantiles(df, {c: [0.01, 0.25, 0.5, 0.75, 0.99] for c in "abc"})
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("quantiles") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("other", "")
    # Scans are the stages with as many tasks as the table has partitions, and more than one.
    files = df.rdd.getNumPartitions()
    assert sum(s is not None and s.numTasks == files and s.numCompletedTasks == files for s in stages) <= 2 * max(1, files // 8) + 1
