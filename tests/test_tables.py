"""Draws, enrichment, duplicates, rules, drift, run table."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txnmill import schemas
from txnmill.functions import draws, scalars
from txnmill.operators import distances, drift, duplicates, enrich, lookups, perturb, profile, rules, stats
from txnmill.session import cut_lineage
from txnmill.sources import readers, runs


# --- draws --------------------------------------------------------------------

def test_draws_do_not_depend_on_partitions(spark):
    one = spark.range(0, 500, 1, 1).select("id", draws.uniform("id", "s").alias("u"))
    many = spark.range(0, 500, 1, 8).repartition(13).select("id", draws.uniform("id", "s").alias("u"))
    assert sorted(one.collect()) == sorted(many.collect())
    us = [r["u"] for r in one.collect()]
    assert 0 <= min(us) and max(us) < 1 and abs(np.mean(us) - 0.5) < 0.05


def test_zeta_and_power_law(spark):
    assert draws.zeta(1.5) == pytest.approx(2.612375348685488, rel=1e-12)
    assert draws.zeta(1.3) == pytest.approx(3.931949211809544, rel=1e-12)
    edges = draws.power_law_edges(1.5, 50)
    us = [0.0, 0.3, 0.5, edges[3] - 1e-12, edges[3], edges[-1], 0.99999]
    df = draws.with_power_law(spark.createDataFrame([(u,) for u in us], "u double"), "k", F.col("u"), 1.5, 50)
    assert [r["k"] for r in df.collect()] == [1 + sum(e <= u for e in edges) for u in us]


def test_weights_are_followed(spark):
    df = spark.range(20000).select(draws.weighted(draws.uniform("id", "w"), {"a": 0.7, "b": 0.0, "c": 0.3}).alias("v"))
    share = {r["value"]: r["share"] for r in profile.share(df, "v").collect()}
    assert set(share) == {"a", "c"} and share["a"] == pytest.approx(0.7, abs=0.02)


def raw_feed(spark, n=300):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({c: rng.normal(size=n) for c in schemas.COMPONENTS})
    pdf.insert(0, "Time", np.sort(rng.integers(0, 172800, n)).astype(float))
    pdf["Amount"] = np.round(rng.exponential(80, n), 2)
    pdf.loc[0, "Amount"] = 0.0
    pdf["Class"] = (rng.random(n) < 0.1).astype("int32")
    pdf["row_key"] = np.arange(n)
    return spark.createDataFrame(pdf)


def test_enrichment_contract(spark):
    raw = raw_feed(spark)
    out = enrich.enrich(raw, "row_key")
    assert out.columns == schemas.ENRICHED_COLUMNS
    pdf = out.toPandas()
    assert len(pdf) == 300 and pdf["transaction_id"].is_unique
    assert rules.validate(out, rules.processed_suite()) == (True, [])
    assert (pdf["amount_inr"] > 0).all()
    assert (pdf.loc[pdf.card_network == "Amex", "card_issuer"] == "American Express").all()
    assert (pdf.loc[pdf.card_network == "RuPay", "is_international"] == 0).all()
    assert (pdf.loc[pdf.transaction_channel == "Online", "entry_mode"] == "CVC").all()
    assert ((pdf.amount_inr <= pdf.credit_limit) | (pdf.credit_limit == (pdf.amount_inr * 1.2).astype(int))).all()
    again = enrich.enrich(raw.repartition(6), "row_key").toPandas()
    key = ["transaction_id"]
    pd.testing.assert_frame_equal(pdf.sort_values(key, ignore_index=True), again.sort_values(key, ignore_index=True))


def test_half_even_equals_numpy_on_ties(spark):
    values = [0.125, 0.375, 2.675, 1.005, 8.125, 0.5 / 88, 1234.565]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(scalars.half_even("x", 2).alias("y"))
    assert [r["y"] for r in df.collect()] == list(np.round(np.array(values), 2))


def test_scenarios_change_what_they_name(spark):
    base = spark.range(1000).selectExpr(
        "id AS transaction_id", "CAST(id AS double) AS amount_inr", "'POS' AS transaction_channel", "'Pune' AS merchant_city",
        "0 AS is_international", "1.0D AS V1", "1.0D AS V4")
    severe = perturb.apply_scenario(base, "severe")
    assert severe.dtypes == base.dtypes and severe.count() == 1000
    row = severe.agg(F.avg("is_international").alias("i"), F.avg(F.col("merchant_city").isNull().cast("int")).alias("n"), F.min("V1").alias("v1"), F.max("V4").alias("v4")).first()
    assert row["i"] == pytest.approx(0.4, abs=0.06) and row["n"] == pytest.approx(0.2, abs=0.05)
    assert row["v1"] == pytest.approx(1.7) and row["v4"] == pytest.approx(0.3)
    assert perturb.apply_scenario(base, "none") is base
    assert perturb.shift(base, "absent") is base
    with pytest.raises(ValueError):
        perturb.apply_scenario(base, "other")


# --- duplicates ------------------------------------------------------------------

def test_exact_duplicates_count_nulls_as_equal(spark):
    rows = [(1, "a"), (1, "a"), (2, None), (2, None), (2, None), (None, None), (3, "b"), (4, "c"), (4, "c")]
    df = spark.createDataFrame(rows, "x int, y string")
    assert duplicates.exact_duplicates(df).first()[0] == 7
    assert duplicates.exact_duplicates(df.distinct()).first()[0] == 0


def brute_near(pdf, gap):
    pdf = pdf.sort_values(["user_id", "ms", "transaction_id"])
    prev = pdf.shift()
    close = (pdf.user_id == prev.user_id) & (pdf.amount_inr == prev.amount_inr) & (pdf.ms - prev.ms < gap * 1000)
    return int(close.sum())


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_near_duplicates_with_a_hot_user(spark, parts):
    rng = np.random.default_rng(2)
    n = 1500
    pdf = pd.DataFrame({
        "transaction_id": rng.permutation(n),
        "user_id": np.where(rng.random(n) < 0.4, 0, rng.integers(1, 30, n)),
        "ms": rng.integers(0, 3_000_000, n),
        "amount_inr": rng.choice([1.0, 2.0, 3.0], n),
    })
    pdf.loc[:20, "ms"] = (pdf.loc[:20, "ms"] // 10_000) * 10_000  # on the edges of the slices
    df = spark.createDataFrame(pdf).selectExpr(
        "transaction_id", "user_id", "amount_inr", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(ms / 1000 AS decimal(18,6))) AS timestamp")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = duplicates.near_duplicates(df, gap_seconds=10).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute_near(pdf, 10) > 0


# --- rules -------------------------------------------------------------------------

def test_rules_ignore_nulls_except_not_null(spark):
    df = spark.createDataFrame([(1, 5.0, 0), (2, None, 1), (3, -2.0, 7), (4, -1.0, None)], "id int, x double, f int")
    suite = [rules.Rule("columns_present", columns=("id", "x", "zz")), rules.Rule("not_null", "x"), rules.Rule("between", "x", low=0.0),
             rules.Rule("in_set", "f", values=(0, 1)), rules.Rule("between", "x", high=4.0), rules.Rule("not_null", "gone")]
    got = {r["position"]: (r["ok"], r["unexpected_count"], r["samples"]) for r in rules.run_suite(df, suite, "id").collect()}
    assert got == {0: (False, 1, None), 1: (False, 1, ["null"]), 2: (False, 2, ["-2.0", "-1.0"]), 3: (False, 1, ["7"]), 4: (False, 1, ["5.0"]), 5: (False, None, None)}
    ok, errors = rules.validate(df, suite, "id")
    assert not ok and len(errors) == 6 and errors[2] == "rule 2, between[x]: 2 rows, such as -2.0, -1.0"
    with pytest.raises(rules.ValidationFailed):
        rules.gate(df, suite)


def test_suite_sizes_and_single_scan(spark):
    assert len(rules.raw_suite()) == 7 and len(rules.processed_suite()) == 11
    assert sum(r.kind == "not_null" for r in rules.raw_suite(True)) == 31
    raw = raw_feed(spark, 20)
    assert rules.validate(raw, rules.raw_suite(True)) == (True, [])
    stored = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    suite = [rules.Rule("not_null", c) for c in stored.columns]
    assert rules.check(stored, suite)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_request_contract(spark):
    good = dict(amount=17.25, time=0.0, card_tier="Signature", credit_limit=41_500.0, card_age=0, transaction_channel="POS",
                is_international=1, is_recurring=1, merchant_category=None, **{c: -i / 8 for i, c in enumerate(schemas.COMPONENTS)})
    bad = [dict(good, card_tier="Copper"), dict(good, amount=-0.01), dict(good, V1=None), dict(good, is_international=2, amount=0.0)]
    df = spark.createDataFrame([good, *bad], schemas.REQUEST)
    ok, quarantine = rules.split_by_contract(df, rules.request_contract())
    assert ok.count() == 1
    assert sorted(tuple(r["broken"]) for r in quarantine.collect()) == sorted([("card_tier",), ("amount",), ("V1",), ("amount", "is_international")])


# --- statistics and drift ----------------------------------------------------------------

def two_by_two(spark, a, b, c, d):
    cells = [("x", 0, a), ("x", 1, b), ("y", 0, c), ("y", 1, d)]
    return spark.createDataFrame([(r, f) for r, f, n in cells for _ in range(n)], "r string, f int")


@pytest.mark.parametrize("cells", [(10, 20, 30, 40), (8, 0, 5, 9), (0, 6, 7, 0), (1, 1, 1, 1)])
def test_chi_square_2x2_with_correction(spark, cells):
    table = np.array(cells, dtype=float).reshape(2, 2)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    gap = np.abs(table - expected)
    want = ((gap - np.minimum(0.5, gap)) ** 2 / expected).sum()
    row = stats.chi_square(two_by_two(spark, *cells), "r", "f").first()
    assert row["chi2"] == pytest.approx(want, abs=1e-9) and row["dof"] == 1


def test_chi_square_3x3_with_empty_cells(spark):
    table = np.array([[5, 0, 3], [2, 8, 0], [1, 1, 9]], dtype=float)
    rows = [(f"r{i}", f"c{j}") for i in range(3) for j in range(3) for _ in range(int(table[i, j]))]
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    row = stats.chi_square(spark.createDataFrame(rows, "r string, c string"), "r", "c").first()
    assert row["chi2"] == pytest.approx(((table - expected) ** 2 / expected).sum()) and row["dof"] == 4


def test_welch_on_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 0), (1.0, 1), (1.0, 1)], "x double, is_fraud int")
    assert stats.welch_test(df, ["x"]).first()["t"] is None


def brute_distances(a, b):
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    gap = np.abs(fa - fb)
    return gap.max(), (gap[:-1] * np.diff(grid)).sum() / a.std()


@pytest.mark.parametrize("buckets", [2, 9, 200])
def test_numeric_distances_equal_brute_force(spark, buckets):
    rng = np.random.default_rng(8)
    a, b = np.round(rng.normal(0, 1, 400), 2), np.round(rng.normal(0.3, 2, 300), 2)
    a[:130] = 0.5  # a third of the rows on one value
    ref = spark.createDataFrame(pd.DataFrame({"x": a, "y": 1.0}))
    cur = spark.createDataFrame(pd.DataFrame({"x": b, "y": 1.0}))
    got = {r["column"]: r for r in drift.numeric_distances(ref, cur, ["x", "y"], buckets).collect()}
    ks, area = brute_distances(a, b)
    assert got["x"]["ks"] == pytest.approx(ks) and got["x"]["wasserstein"] == pytest.approx(area)
    assert (got["x"]["n_ref"], got["x"]["n_cur"]) == (400, 300)
    assert got["y"]["ks"] == 0 and got["y"]["wasserstein"] is None


@pytest.mark.parametrize("seed", range(6))
def test_distances_over_odd_columns(spark, seed):
    """Ties, gaps, two zeros, nulls, one-sided columns and nearly equal samples, with few and many buckets."""
    rng = np.random.default_rng(seed)
    n, m = int(rng.integers(2, 900)), int(rng.integers(2, 900))
    make = {
        "same": lambda k, _: rng.normal(size=k),
        "shifted": lambda k, s: rng.normal(size=k) + 3 * s,
        "wider": lambda k, s: np.round(rng.normal(size=k) * (1 + s), 1),
        "few": lambda k, s: rng.choice([0.0, -0.0, 1.0, 7.0], k, p=[0.2, 0.2, 0.5 - 0.2 * s, 0.1 + 0.2 * s]),
        "huge": lambda k, s: 1e12 + rng.exponential(1 + s, k),
    }
    frames = [{c: f(k, s) for c, f in make.items()} for s, k in ((0, n), (1, m))]
    sides = [spark.createDataFrame(pd.DataFrame(f)).selectExpr("*", "IF(rand(1) < 2, CAST(NULL AS double), 0D) AS none", f"IF({s} = 0, 1.5D, double('NaN')) AS one_sided") for s, f in enumerate(frames)]
    names = [*make, "none", "one_sided"]
    got = {r["column"]: r for r in drift.numeric_distances(*sides, names, buckets=int(rng.choice([2, 30, 500]))).collect()}
    for c in make:
        ks, area = brute_distances(frames[0][c], frames[1][c])
        assert got[c]["ks"] == pytest.approx(ks, abs=1e-12)
        assert got[c]["wasserstein"] == pytest.approx(area, rel=1e-6, abs=1e-9)
    assert set(got) == set(names)
    assert (got["none"]["n_ref"], got["none"]["ks"]) == (0, None) and (got["one_sided"]["n_ref"], got["one_sided"]["n_cur"], got["one_sided"]["wasserstein"]) == (n, 0, None)


def test_few_buckets_are_opened(spark):
    """Of two samples that differ, the second scan takes few rows, and none is exploded per column."""
    both = spark.range(40_000).selectExpr("id % 2 AS __cur", *[f"randn({k}) * {1 + k} + (id % 2) * {k + 1} * 0.5 AS x{k}" for k in range(12)])
    both = cut_lineage(both, "both")
    names = [f"x{k}" for k in range(12)]
    edges = distances.edges_of(both, names, 256)
    held = distances.histogram(both, names, edges).toPandas().sort_values(["c", "b"])
    opened = {}
    for i, g in held.groupby("c"):
        part = distances.Column(*(g[k].to_numpy() for k in ("b", "ref", "cur", "sum_ref", "sum_cur", "squares", "low", "high")))
        some = part.ks_open() | part.area_open()
        opened[i] = np.zeros(len(edges.inner[i]) + 1, bool)
        opened[i][part.b[some]] = True
    assert distances.points_of(both, names, edges, opened).count() < 0.15 * 12 * 40_000
    plan = distances.histogram(both, names, edges)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan


def test_a_column_without_values_has_a_row(spark):
    base = monitored_table(spark).withColumns({"V4": F.lit(None).cast("double"), "merchant_city": F.lit(None).cast("string")})
    for method in ("pvalue", "distance"):
        found = {r["column"]: (r["score"], r["drifted"]) for r in drift.detect(base, base, method).collect()}
        assert len(found) == 6 and found["V4"] == (None, False) and found["merchant_city"] == (None, False)


def test_new_category_is_certain_drift(spark):
    ref = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    cur = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    counts = drift.category_counts(ref, cur, ["c"])
    row = drift.chi_square_fit(counts).first()
    assert math.isinf(row["chi2"]) and row["p_value"] == 0.0
    assert 0 < drift.jensen_shannon(counts).first()["js"] < 1


def monitored_table(spark, n=400):
    return spark.range(n).selectExpr(
        "id AS transaction_id", "CAST(id % 50 AS double) AS amount_inr", "CAST(id % 31 AS double) / 31 AS V1", "CAST(id % 17 AS double) AS V4",
        "IF(id % 2 = 0, 'Online', 'POS') AS transaction_channel", "IF(id % 3 = 0, 'Pune', 'Delhi') AS merchant_city", "CAST(id % 2 AS int) AS is_international",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS timestamp")


@pytest.mark.parametrize("method", ["pvalue", "distance"])
def test_identical_halves_have_no_drift_and_severe_is_found(spark, method):
    base = monitored_table(spark)
    same = drift.severity(drift.detect(base, base, method)).first()
    assert (same["total_columns"], same["drifted_columns"], same["severity"]) == (6, 0, "none")
    verdicts = {r["column"]: r["drifted"] for r in drift.detect(base, perturb.apply_scenario(base, "severe"), method).collect()}
    assert verdicts["amount_inr"] and verdicts["V1"] and verdicts["is_international"]
    assert not verdicts["transaction_channel"]


def test_severity_levels(spark):
    df = lambda hits, n: spark.createDataFrame([(i < hits,) for i in range(n)], "drifted boolean")
    level = lambda *a: drift.severity(df(*a)).first()["severity"]
    assert [level(5, 10), level(2, 10), level(1, 10)] == ["critical", "warning", "none"]
    assert drift.severity(df(0, 1).where("drifted")).first()["drift_ratio"] == 0.0


def test_missing_score_is_no_drift(spark):
    scores = spark.createDataFrame([("a", "ks", None), ("amount_inr", "ks", 0.01)], "column string, test string, score double")
    got = [(r["drifted"], r["key_feature"]) for r in drift.with_verdict(scores).collect()]
    assert got == [(False, False), (True, True)]
    assert [r["drifted"] for r in drift.with_verdict(scores, "distance").collect()] == [False, False]


# --- other tables -------------------------------------------------------------------

def test_versions_compare_as_numbers(spark):
    df = spark.createDataFrame([("m", "9", "r9"), ("m", "10", "r10"), ("k", "2", "r2")], "name string, version string, run_id string")
    assert {tuple(r) for r in runs.latest_version(df).collect()} == {("m", 10, "r10"), ("k", 2, "r2")}


def test_stored_size_decides_the_join(spark):
    side = lookups.stored_side(spark.range(50))
    assert side.count() == 50 and "hint" not in side._jdf.queryExecution().logical().toString().lower()
    joined = lambda: spark.range(1000).join(side, "id")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in joined()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in joined()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_cross_table_loses_no_value(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "z"), ("b", "x"), ("b", None), (None, "x")], "r string, c string")
    assert {tuple(r) for r in profile.cross_table(df, "r", "c").collect()} == {("a", 1, 1), ("b", 1, 0)}
    with pytest.raises(ValueError):
        profile.cross_table(df, "r", "c", ["x"])


def test_readers(spark, tmp_path):
    with pytest.raises(readers.SourceError):
        readers.read_table(spark, "data.xml")
    with pytest.raises(readers.SourceError):
        readers.read_table(spark, str(tmp_path / "absent.parquet"))
    with pytest.raises(readers.SourceError):
        readers.read_table(spark, "x.csv", allowed=("parquet",))


def test_histogram_of_constant_and_empty(spark):
    assert [tuple(r) for r in profile.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), F.col("x")).collect()] == [(0, 2)]
    assert profile.histogram(spark.createDataFrame([], "x double"), F.col("x")).count() == 0


def test_a_user_with_half_of_the_rows_is_many_ranges(spark):
    """No task holds much more than its share, whoever owns the rows."""
    rows = spark.range(40_000).selectExpr("IF(id % 2 = 0, 0, id) AS k", "id % 977 AS t", "id AS i")
    sizes = [r["count"] for r in rows.repartitionByRange(20, "k", "t", "i").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 18 and max(sizes) <= 2 * 40_000 / 20


def test_concentration_with_ties_nulls_and_few_keys(spark):
    for keys, want in (([1] * 5 + [2] * 5 + [3] * 2 + [None] * 4, (5, 5.0, 75.0)), ([1, 1, 2, 3, 4, 5, 6, 7], (2, 1.0, 75.0)), ([9], (1, 1.0, 100.0)), ([None], (None, None, 0.0))):
        row = profile.concentration(spark.createDataFrame([(k,) for k in keys], "k int"), "k").first()
        assert tuple(row) == want


def test_distinct_sketches_merge(spark):
    rows = spark.range(30_000).selectExpr("id % 10 AS day", "id % 7000 AS a", "CAST(id % 3 AS string) AS b")
    sketches = profile.distinct_sketches(rows, "day", ["a", "b"])
    merged = profile.merged_distinct(sketches, spark.createDataFrame([(0,), (8,)], "`from` long"), "day", ["a", "b"])
    got = {(r["from"], r["column"]): r["estimate"] for r in merged.collect()}
    exact = {(0, "a"): 7000, (8, "a"): rows.where("day >= 8").select("a").distinct().count(), (0, "b"): 3, (8, "b"): 3}
    assert all(abs(got[k] - n) <= max(0.5, n * profile.SKETCH_ERROR) for k, n in exact.items())


def test_addresses_of_a_mounted_scheme(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in" / "rows.parquet"))
    readers.mount(spark, "mill", "depot", f"file://{tmp_path}/in")
    assert readers.read_parquet(spark, "mill://depot/rows.parquet").count() == 5
    assert readers.read_table(spark, "mill://depot/rows.parquet").repartition(3).count() == 5
    with pytest.raises(readers.SourceError):
        readers.read_parquet(spark, "mill://depot/none.parquet")
    with pytest.raises(readers.SourceError):
        readers.read_parquet(spark, "unheard://depot/rows.parquet")


def test_totals_come_from_the_groups(spark, tmp_path):
    """One scan per report: the total is taken from the groups, whose exchange serves both."""
    spark.range(2000).selectExpr("CAST(id % 7 AS string) AS a", "CAST(id % 3 AS string) AS b", "CAST(id % 24 AS int) AS h", "CAST(id % 11 = 0 AS int) AS is_fraud", "IF(id < 900, 'train', 'test') AS split", "timestamp_seconds(id) AS timestamp").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    reports = [
        profile.top_rates(df, "a", 3, 0), profile.share(df, "a"), profile.hotspots(df, [("a", "b"), ("b", "a")], 2, 0), profile.mean_of_group_rates(df, "h", 2, 5, min_rows=0),
        profile.rate_multiples(df, "a"), profile.split_summary(df),
    ]
    for report in reports:
        report.collect()
        final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("FileScan parquet") - final.count("ReusedExchange") <= 1, final
