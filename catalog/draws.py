"""Seeded draws, enrichment and perturbation."""

from txnmill.functions import draws, scalars
from txnmill.operators import enrich, order, perturb

from .registry import COMPONENTS, F, duck_uniform, duck_weighted, query, r, raw, rounded, sql, txn
from .joins import CUTS, SEGMENT, _STATE, _by_segment

ID = "transaction_id"
SEED = 42


@query("r1_draw_by_segment", sql(
    f"SELECT transaction_id, {_by_segment(duck_uniform('transaction_id', 'category'), enrich.CATEGORIES)} AS merchant_category FROM s",
    q=CUTS, s=f"SELECT transaction_id, {SEGMENT} AS amount_segment FROM txn, q"))
def r1(spark, sf):
    segmented, _, _ = enrich.add_segments(txn(spark, sf).select(ID, "amount_inr"))
    drawn = draws.weighted_by(F.col("amount_segment"), draws.uniform(ID, "category"), enrich.CATEGORIES, "Unknown")
    return segmented.select(ID, drawn.alias("merchant_category"))


@query("r2_conditional_draw", sql(
    f"SELECT transaction_id, CASE WHEN is_fraud = 1 THEN {duck_weighted(duck_uniform('transaction_id', 'entry'), enrich.POS_FRAUD)} ELSE entry_mode END AS entry_mode FROM txn"))
def r2(spark, sf):
    drawn = draws.weighted(draws.uniform(ID, "entry"), enrich.POS_FRAUD)
    return txn(spark, sf).select(ID, F.when(F.col("is_fraud") == 1, drawn).otherwise(F.col("entry_mode")).alias("entry_mode"))


def _zipf(n, zeta):
    return f"SELECT k, sum(power(k, -{{a}}) / {zeta}) OVER (ORDER BY k) AS edge FROM (SELECT CAST(range AS DOUBLE) AS k FROM range(1, {n}))"


# zeta(1.5) and zeta(1.3), from published tables.
USER_EDGES = _zipf(10_000, "2.612375348685488::DOUBLE").format(a="1.5::DOUBLE")
MERCHANT_EDGES = _zipf(5_000, "3.9319492118095437::DOUBLE").format(a="1.3::DOUBLE")


@query("r3_power_law_ids", sql(
    "SELECT d.transaction_id, concat('user_', lpad(CAST(CAST(coalesce(u.k, 0) + 1 AS BIGINT) AS STRING), 5, '0')) AS user_id, "
    "concat('merchant_', lpad(CAST(CAST(coalesce(m.k, 0) + 1 AS BIGINT) AS STRING), 5, '0')) AS merchant_id "
    "FROM d ASOF LEFT JOIN users u ON d.uu >= u.edge ASOF LEFT JOIN merchants m ON d.um >= m.edge",
    users=USER_EDGES, merchants=MERCHANT_EDGES,
    d=f"SELECT transaction_id, {duck_uniform('transaction_id', f'user:{SEED}')} AS uu, {duck_uniform('transaction_id', f'merchant:{SEED}')} AS um FROM txn"))
def r3(spark, sf):
    base = txn(spark, sf).select(F.col(ID).alias("row_key"))
    return enrich.add_ids(base, "row_key").select(F.col("row_key").alias(ID), "user_id", "merchant_id")


@query("r4_weighted_draw", sql(
    f"SELECT transaction_id, {duck_weighted(duck_uniform('transaction_id', 'issuer'), enrich.ISSUERS)} AS card_issuer, "
    f"{duck_weighted(duck_uniform('transaction_id', 'city'), enrich.city_weights())} AS merchant_city FROM txn"))
def r4(spark, sf):
    return txn(spark, sf).select(
        ID,
        draws.weighted(draws.uniform(ID, "issuer"), enrich.ISSUERS).alias("card_issuer"),
        draws.weighted(draws.uniform(ID, "city"), enrich.city_weights()).alias("merchant_city"),
    )


@query("r5_uniform_integer", sql(
    f"SELECT transaction_id, CAST(floor(1 + {duck_uniform('transaction_id', 'age')} * 60) AS INT) AS card_age, "
    f"CAST(floor(CAST(floor(25000 + {duck_uniform('transaction_id', 'limit')} * 75000) AS INT) / 1000) * 1000 AS INT) AS credit_limit FROM txn"))
def r5(spark, sf):
    limit = draws.uniform_int(draws.uniform(ID, "limit"), 25_000, 100_000)
    return txn(spark, sf).select(
        ID, draws.uniform_int(draws.uniform(ID, "age"), 1, 61).alias("card_age"), scalars.floor_to(limit, 1000).cast("int").alias("credit_limit")
    )


# The enrichment step by step in SQL, on the raw feed.
def _u(salt):
    return duck_uniform("row_key", f"{salt}:{SEED}")


_LIMIT = " ".join(
    f"WHEN '{t}' THEN CAST(floor(CAST(floor({lo} + {_u('limit')} * {hi - lo}) AS INT) / 1000) * 1000 AS INT)" for t, (lo, hi) in enrich.LIMITS.items()
)
_MIXED = " ".join(f"WHEN '{c}' THEN {duck_weighted(_u('channel'), {'Online': p, 'POS': 1 - p})}" for c, p in enrich.ONLINE_SHARE.items())
_ONLINE = ", ".join(f"'{c}'" for c in enrich.ONLINE_CATEGORIES)
_TIERS = " ".join(f"WHEN '{s}' THEN {duck_weighted(_u('tier'), w)}" for s, w in enrich.TIERS.items())
STEPS = dict(
    e1="SELECT *, TIMESTAMP '2023-09-02 00:00:00' + to_seconds(CAST(trunc(Time) AS BIGINT)) AS timestamp, "
       "CASE WHEN Amount = 0 THEN 1.0::DOUBLE ELSE round_even(Amount * 88.0::DOUBLE, 2) END AS amount_inr FROM raw",
    q="SELECT quantile_cont(amount_inr, 0.25) AS lo, quantile_cont(amount_inr, 0.9) AS hi FROM e1",
    e2=f"SELECT e1.*, {SEGMENT} AS amount_segment FROM e1, q",
    e3=f"SELECT *, {_by_segment(_u('network'), enrich.NETWORKS)} AS card_network, {_by_segment(_u('category'), enrich.CATEGORIES)} AS merchant_category, "
       f"{duck_weighted(_u('city'), enrich.city_weights())} AS merchant_city, CAST(floor(1 + {_u('age')} * 60) AS INT) AS card_age FROM e2",
    e4=f"SELECT *, CASE WHEN card_network = 'Amex' THEN {duck_weighted(_u('tier'), enrich.TIERS_AMEX)} ELSE CASE amount_segment {_TIERS} END END AS card_tier, "
       f"CASE WHEN card_network = 'Amex' THEN 'American Express' ELSE {duck_weighted(_u('issuer'), enrich.ISSUERS)} END AS card_issuer, "
       f"CASE merchant_city {_STATE} END AS merchant_state, "
       f"CASE WHEN merchant_category IN ({_ONLINE}) THEN 'Online' ELSE CASE merchant_category {_MIXED} ELSE 'POS' END END AS transaction_channel FROM e3",
    e5=f"SELECT *, CASE card_tier {_LIMIT} ELSE 50000 END AS base_limit, "
       f"CASE WHEN transaction_channel = 'Online' THEN 'CVC' WHEN Class = 1 THEN {duck_weighted(_u('entry'), enrich.POS_FRAUD)} "
       f"WHEN amount_inr > 5000 THEN {duck_weighted(_u('entry'), enrich.POS_LARGE)} ELSE {duck_weighted(_u('entry'), enrich.POS_SMALL)} END AS entry_mode, "
       f"CASE WHEN merchant_category = 'Utility' THEN 1 WHEN merchant_category = 'Digital Services' THEN {duck_weighted(_u('recurring'), enrich.RECURRING_DIGITAL)} ELSE 0 END AS is_recurring, "
       f"CASE WHEN card_network = 'RuPay' THEN 0 WHEN Class = 1 THEN {duck_weighted(_u('international'), enrich.INTERNATIONAL[1])} ELSE {duck_weighted(_u('international'), enrich.INTERNATIONAL[0])} END AS is_international FROM e4",
    e6="SELECT *, CASE WHEN amount_inr > base_limit THEN CAST(trunc(amount_inr * 1.2::DOUBLE) AS INT) ELSE base_limit END AS credit_limit FROM e5",
)


def _steps(spark, sf):
    df, _, _ = enrich.add_segments(enrich.add_temporal(raw(spark, sf)))
    return df


@query("r6_card_attributes", sql("SELECT row_key, card_network, card_tier, card_issuer, card_age, credit_limit FROM e6", "raw", **STEPS))
def r6(spark, sf):
    return enrich.add_card(_steps(spark, sf), "row_key").select("row_key", "card_network", "card_tier", "card_issuer", "card_age", "credit_limit")


@query("r7_merchant_attributes", sql("SELECT row_key, merchant_category, merchant_city, merchant_state FROM e6", "raw", **STEPS))
def r7(spark, sf):
    return enrich.add_merchant(_steps(spark, sf), "row_key").select("row_key", "merchant_category", "merchant_city", "merchant_state")


@query("r8_transaction_attributes", sql("SELECT row_key, transaction_channel, entry_mode, is_recurring, is_international FROM e6", "raw", **STEPS))
def r8(spark, sf):
    df = enrich.add_merchant(enrich.add_card(_steps(spark, sf), "row_key"), "row_key")
    return enrich.add_transaction(df, "row_key").select("row_key", "transaction_channel", "entry_mode", "is_recurring", "is_international")


@query("r9_enrichment", sql(
    "SELECT concat('txn_', substr(md5(concat(CAST(e6.row_key AS STRING), 'id:42')), 1, 12)) AS transaction_id, "
    "concat('user_', lpad(CAST(CAST(coalesce(u.k, 0) + 1 AS BIGINT) AS STRING), 5, '0')) AS user_id, "
    "concat('merchant_', lpad(CAST(CAST(coalesce(m.k, 0) + 1 AS BIGINT) AS STRING), 5, '0')) AS merchant_id, "
    "timestamp, card_network, card_issuer, card_tier, credit_limit, card_age, amount_inr, merchant_category, merchant_city, merchant_state, "
    f"transaction_channel, entry_mode, is_international, is_recurring, {', '.join(r(c) + ' AS ' + c for c in COMPONENTS)}, Class AS is_fraud "
    "FROM e6 JOIN d USING (row_key) ASOF LEFT JOIN users u ON d.uu >= u.edge ASOF LEFT JOIN merchants m ON d.um >= m.edge",
    "raw", **STEPS, users=USER_EDGES, merchants=MERCHANT_EDGES, d=f"SELECT row_key, {_u('user')} AS uu, {_u('merchant')} AS um FROM raw"))
def r9(spark, sf):
    return rounded(enrich.enrich(raw(spark, sf), "row_key"))


@query("r10_replace_category", sql(
    f"SELECT transaction_id, CASE WHEN {duck_uniform('transaction_id', 'replace:transaction_channel')} < 0.1 THEN 'Online' ELSE transaction_channel END AS transaction_channel FROM txn"))
def r10(spark, sf):
    return perturb.replace_category(txn(spark, sf).select(ID, "transaction_channel"), "transaction_channel", "Online", 0.1)


@query("r11_inject_nulls", sql(
    f"SELECT transaction_id, CASE WHEN {duck_uniform('transaction_id', 'null:merchant_city')} >= 0.2 THEN merchant_city END AS merchant_city FROM txn"))
def r11(spark, sf):
    return perturb.inject_nulls(txn(spark, sf).select(ID, "merchant_city"), "merchant_city", 0.2)


SEVERE = (
    f"SELECT * REPLACE (amount_inr * 1.5::DOUBLE + 500 AS amount_inr, CASE WHEN {duck_uniform('transaction_id', 'null:merchant_city')} >= 0.2 THEN merchant_city END AS merchant_city, "
    f"CASE WHEN {duck_uniform('transaction_id', 'replace:is_international')} < 0.4 THEN 1 ELSE is_international END AS is_international, "
    "V1 * 1.2::DOUBLE + 0.5::DOUBLE AS V1, V4 * 0.8::DOUBLE - 0.5::DOUBLE AS V4) FROM txn"
)
MILD = (
    f"SELECT * REPLACE (amount_inr * 1.05::DOUBLE AS amount_inr, CASE WHEN {duck_uniform('transaction_id', 'replace:transaction_channel')} < 0.1 THEN 'Online' ELSE transaction_channel END AS transaction_channel) FROM txn"
)
_SCENARIO = "transaction_id, " + ", ".join(f"{r(c)} AS {c}" for c in ("amount_inr", "V1", "V4")) + ", merchant_city, is_international, transaction_channel"


@query("r12_scenario_severe", sql(f"SELECT {_SCENARIO} FROM s", s=SEVERE))
def r12(spark, sf):
    base = txn(spark, sf).select(ID, "amount_inr", "V1", "V4", "merchant_city", "is_international", "transaction_channel")
    return rounded(perturb.apply_scenario(base, "severe"))


@query("r12_scenario_mild", sql(
    f"SELECT {_SCENARIO} FROM s",
    s=f"SELECT * REPLACE (amount_inr * 1.05::DOUBLE AS amount_inr, CASE WHEN {duck_uniform('transaction_id', 'replace:transaction_channel')} < 0.1 THEN 'Online' ELSE transaction_channel END AS transaction_channel) FROM txn"))
def r12_mild(spark, sf):
    base = txn(spark, sf).select(ID, "amount_inr", "V1", "V4", "merchant_city", "is_international", "transaction_channel")
    return rounded(perturb.apply_scenario(base, "mild"))


@query("r12_scenario_none", sql(f"SELECT {_SCENARIO} FROM txn"))
def r12_none(spark, sf):
    base = txn(spark, sf).select(ID, "amount_inr", "V1", "V4", "merchant_city", "is_international", "transaction_channel")
    return rounded(perturb.apply_scenario(base, "none"))


@query("r13_random_split", sql(
    "SELECT side, count(*) AS n, CAST(sum(transaction_id) AS BIGINT) AS ids FROM (SELECT transaction_id, CASE WHEN rn <= n // 2 THEN 'reference' ELSE 'current' END AS side FROM h) GROUP BY 1",
    h="SELECT transaction_id, row_number() OVER (ORDER BY substr(md5(concat(CAST(transaction_id AS STRING), 'shuffle')), 1, 13), transaction_id) AS rn, count(*) OVER () AS n FROM txn"))
def r13(spark, sf):
    first, rest = order.random_split(txn(spark, sf).select(ID))
    both = first.withColumn("side", F.lit("reference")).unionByName(rest.withColumn("side", F.lit("current")))
    return both.groupBy("side").agg(F.count("*").alias("n"), F.sum(ID).alias("ids"))
