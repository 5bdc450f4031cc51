"""Lookups and run-table joins."""

from txnmill.functions.draws import uniform
from txnmill.operators import encoding, enrich, lookups, order
from txnmill.sources import runs

from .registry import F, duck_uniform, duck_weighted, query, r, rounded, sales, sales_by_type, sql, txn

ID = "transaction_id"

_STATE = " ".join(f"WHEN '{c}' THEN '{s}'" for c, s in lookups.STATE_OF_CITY.items())


@query("j1_city_state", sql(f"SELECT transaction_id, merchant_city, CASE merchant_city {_STATE} END AS merchant_state FROM txn"))
def j1(spark, sf):
    return lookups.with_state(txn(spark, sf).select(ID, "merchant_city")).select(ID, "merchant_city", "merchant_state")


# Fitted on the train rows without one category, which the others then meet as unknown.
_ENCODED = (
    f"SELECT transaction_id, {r('coalesce(encoding, g)')} AS merchant_category_encoded FROM txn LEFT JOIN enc ON merchant_category = category, o"
)


@query("j2_encoding_lookup", sql(
    _ENCODED,
    fit="SELECT * FROM txn WHERE transaction_id % 5 < 3 AND merchant_category <> 'signup'",
    o="SELECT avg(is_fraud) AS g FROM fit",
    enc="SELECT merchant_category AS category, (sum(is_fraud) + 10 * (SELECT g FROM o)) / (count(*) + 10) AS encoding FROM fit GROUP BY 1"))
def j2(spark, sf):
    base = txn(spark, sf).select(ID, "merchant_category", "is_fraud")
    fit = base.where((F.col(ID) % 5 < 3) & (F.col("merchant_category") != "signup"))
    encoder = encoding.TargetEncoder.fit(fit, "merchant_category")
    return rounded(encoder.transform(base).select(ID, "merchant_category_encoded"))


@query("j2_encoding_lookup_sales", sql(
    f"SELECT merchant_category, count(*) AS n, {r('sum(encoding)', 4)} AS total FROM sales_by_type JOIN enc ON merchant_category = category GROUP BY 1",
    "sales sales_by_type",
    enc="SELECT merchant_category AS category, (sum(is_fraud) + 10 * (SELECT avg(is_fraud) FROM sales_by_type)) / (count(*) + 10) AS encoding FROM sales_by_type GROUP BY 1"))
def j2_sales(spark, sf):
    base = sales_by_type(spark, sf).select("merchant_category", "is_fraud")
    coded = encoding.TargetEncoder.fit(base, "merchant_category").transform(base)
    out = coded.groupBy("merchant_category").agg(F.count("*").alias("n"), F.sum("merchant_category_encoded").alias("total"))
    return rounded(out, 4)


SEGMENT = "CASE WHEN amount_inr <= q.lo THEN 'low' WHEN amount_inr <= q.hi THEN 'mid' ELSE 'high' END"
CUTS = "SELECT quantile_cont(amount_inr, 0.25) AS lo, quantile_cont(amount_inr, 0.9) AS hi FROM txn"


def _by_segment(u, distributions):
    cases = " ".join(f"WHEN '{s}' THEN {duck_weighted(u, w)}" for s, w in distributions.items())
    return f"CASE amount_segment {cases} ELSE 'Unknown' END"


@query("j3_segment_distribution", sql(
    f"SELECT transaction_id, {_by_segment(duck_uniform('transaction_id', 'network'), enrich.NETWORKS)} AS card_network FROM s",
    q=CUTS, s=f"SELECT transaction_id, {SEGMENT} AS amount_segment FROM txn, q"))
def j3(spark, sf):
    segmented, _, _ = enrich.add_segments(txn(spark, sf).select(ID, "amount_inr"))
    drawn = lookups.draw_by_join(segmented, "card_network", uniform(ID, "network"), "amount_segment", enrich.NETWORKS)
    return drawn.select(ID, "card_network")


# Run rows derived from the transactions: one run per card network, two stages, two metrics.
_RUNS = (
    "SELECT card_network AS run_id, CASE WHEN transaction_id % 2 = 0 THEN 'validation' ELSE 'test' END AS stage, m AS metric, "
    "CASE m WHEN 'pr_auc' THEN avg(is_fraud) ELSE avg(is_international) END AS value FROM txn, (SELECT 'pr_auc' AS m UNION ALL SELECT 'recall' AS m) GROUP BY card_network, CASE WHEN transaction_id % 2 = 0 THEN 'validation' ELSE 'test' END, m"
)


def run_table(spark, sf):
    base = txn(spark, sf).withColumn("stage", F.when(F.col(ID) % 2 == 0, "validation").otherwise("test"))
    wide = base.groupBy(F.col("card_network").alias("run_id"), "stage").agg(
        F.avg("is_fraud").alias("pr_auc"), F.avg("is_international").alias("recall")
    )
    return wide.unpivot(["run_id", "stage"], ["pr_auc", "recall"], "metric", "value")


@query("j4_compare_stages", sql(
    f"SELECT v.run_id, v.metric, {r('v.value')} AS base_value, {r('t.value')} AS other_value, {r('t.value - v.value')} AS difference, "
    "CASE WHEN abs(t.value - v.value) < 0.005 THEN 'OK' ELSE 'Warning' END AS status FROM runs v JOIN runs t ON v.run_id = t.run_id AND v.metric = t.metric "
    "WHERE v.stage = 'validation' AND t.stage = 'test'", runs=_RUNS))
def j4(spark, sf):
    return rounded(runs.compare_stages(run_table(spark, sf), tolerance=0.005))


@query("t9_champion", sql(f"SELECT run_id, {r('value')} AS value FROM runs WHERE metric = 'pr_auc' AND stage = 'validation' ORDER BY runs.value DESC, run_id LIMIT 1", runs=_RUNS))
def t9(spark, sf):
    return rounded(runs.champion(run_table(spark, sf)))


# Versions as text: one model per merchant category, one version per card age.
_VERSIONS = "SELECT merchant_category AS name, CAST(card_age AS STRING) AS version, concat('run_', CAST(max(transaction_id) AS STRING)) AS run_id FROM txn GROUP BY 1, 2"


def version_table(spark, sf):
    return txn(spark, sf).groupBy(F.col("merchant_category").alias("name"), F.col("card_age").cast("string").alias("version")).agg(
        F.concat(F.lit("run_"), F.max(ID).cast("string")).alias("run_id")
    )


_LATEST = "SELECT name, CAST(version AS INT) AS version, run_id FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY CAST(version AS INT) DESC, run_id DESC) AS rn FROM v) WHERE rn = 1"


@query("t10_latest_version", sql(_LATEST, v=_VERSIONS))
def t10(spark, sf):
    return runs.latest_version(version_table(spark, sf))


@query("j5_latest_artifacts", sql("SELECT run_id, a.artifact, l.name, l.version FROM l JOIN a USING (run_id)", v=_VERSIONS, l=_LATEST,
    a="SELECT concat('run_', CAST(transaction_id AS STRING)) AS run_id, entry_mode AS artifact FROM txn"))
def j5(spark, sf):
    artifacts = txn(spark, sf).select(F.concat(F.lit("run_"), F.col(ID).cast("string")).alias("run_id"), F.col("entry_mode").alias("artifact"))
    return runs.latest_artifacts(version_table(spark, sf), artifacts)


@query("j6_scalar_baseline", sql(f"SELECT merchant_city, {r('avg(is_fraud) / (SELECT avg(is_fraud) FROM txn)')} AS multiple FROM txn GROUP BY 1"))
def j6(spark, sf):
    from txnmill.operators import profile

    return rounded(profile.rate_multiples(txn(spark, sf), "merchant_city").select("merchant_city", "multiple"))
