"""Scalar functions and predicates."""

from txnmill.functions import scalars as S
from txnmill.operators import profile

from .registry import F, query, r, raw, rounded, scored, sql, txn

ID = "transaction_id"


def _scalar(name, column, expression, sql_expression, table=txn, sql_table="txn", key=ID, places=6):
    """One computed column beside the row key."""

    @query(name, sql(f"SELECT {key}, {sql_expression} AS {column} FROM {sql_table}", sql_table))
    def run(spark, sf, table=table, expression=expression):
        out = expression() if callable(expression) else expression
        return rounded(table(spark, sf).select(key, out.alias(column)), places)

    return run


_scalar("sc1_hour", "hour", lambda: S.hour_of("timestamp"), "CAST(hour(timestamp) AS INT)")
_scalar("sc2_day_of_week", "day_of_week", lambda: S.day_of_week("timestamp"), "CAST(isodow(timestamp) - 1 AS INT)")
_scalar("sc3_is_night", "is_night", lambda: S.is_night("timestamp"), "CASE WHEN hour(timestamp) <= 5 THEN 1 ELSE 0 END")
_scalar("sc3_is_night_wide", "is_night", lambda: S.is_night("timestamp", [*range(7), 22, 23]),
        "CASE WHEN hour(timestamp) <= 6 OR hour(timestamp) >= 22 THEN 1 ELSE 0 END")
_scalar("sc4_is_weekend", "is_weekend", lambda: S.is_weekend("timestamp"), "CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END")
_scalar("sc5_log_amount", "log_amount", lambda: S.log_amount("amount_inr"), r("ln(1 + amount_inr)"))
_scalar("sc6_intl_online", "intl_online", lambda: S.intl_online(),
        "CASE WHEN is_international = 1 AND transaction_channel = 'Online' THEN 1 ELSE 0 END")
_scalar("sc8_timestamp_from_offset", "timestamp", lambda: S.timestamp_from_offset("2023-09-02", "Time"),
        "TIMESTAMP '2023-09-02 00:00:00' + to_seconds(CAST(trunc(Time) AS BIGINT))", raw, "raw", "row_key")
_scalar("sc9_currency", "amount_inr", lambda: S.convert_currency("Amount", 88.0),
        "CASE WHEN Amount = 0 THEN 1.0::DOUBLE ELSE round_even(Amount * 88.0::DOUBLE, 2) END", raw, "raw", "row_key")
_scalar("sc12_padded_id", "user", lambda: S.padded_id("user", "user_id"), "concat('user_', lpad(CAST(user_id AS STRING), 5, '0'))")
_scalar("sc13_opaque_id", "txn", lambda: S.opaque_id("txn", ID), f"concat('txn_', substr(md5(CAST({ID} AS STRING)), 1, 12))")
_scalar("sc14_clip", "clipped", lambda: S.clip("user_id", 10, 100), "least(greatest(user_id, 10), 100)")
_scalar("sc15_floor_thousands", "floored", lambda: S.floor_to(F.col("amount_inr") * 100, 1000).cast("long"),
        "CAST(floor(amount_inr * 100 / 1000) * 1000 AS BIGINT)")
_scalar("sc15_truncated_product", "product", lambda: S.truncated_product("amount_inr", 1.2), "CAST(trunc(amount_inr * 1.2::DOUBLE) AS INT)")
_scalar("sc16_risk_level", "risk_level", lambda: S.risk_level("prob"),
        "CASE WHEN prob < 0.3::DOUBLE THEN 'low' WHEN prob < 0.7::DOUBLE THEN 'medium' ELSE 'high' END", scored, "scored", "row_key")
_scalar("sc17_threshold_label", "predicted", lambda: S.over_threshold("prob"),
        "CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END", scored, "scored", "row_key")
_scalar("sc18_rounded_probability", "probability", lambda: S.rounded_probability("prob"),
        "round_even(prob, 4)", scored, "scored", "row_key")
_scalar("sc19_clock_hour", "hour", lambda: S.clock_hour("Time"), "CAST(CAST(floor(Time / 3600) AS BIGINT) % 24 AS INT)", raw, "raw", "row_key")
_scalar("sc19_clock_day", "day", lambda: S.clock_day("Time"), "CAST(CAST(floor(Time / 86400) AS BIGINT) % 7 AS INT)", raw, "raw", "row_key")
_scalar("sc20_significance", "verdict", lambda: S.significance("prob"),
        "CASE WHEN prob < 0.05::DOUBLE THEN 'significant' ELSE 'not significant' END", scored, "scored", "row_key")
_scalar("sc20_strength", "strength", lambda: S.strength("prob"),
        "CASE WHEN prob > 0.3::DOUBLE THEN 'strong' WHEN prob > 0.1::DOUBLE THEN 'moderate' ELSE 'weak' END", scored, "scored", "row_key")
_scalar("sc22_linear_map", "shifted", lambda: S.linear("amount_inr", 1.5, 500), r("amount_inr * 1.5::DOUBLE + 500"))


@query("sc7_night_high_amount", sql(
    "SELECT transaction_id, split, CASE WHEN hour(timestamp) <= 5 AND la > q THEN 1 ELSE 0 END AS night_high_amount "
    "FROM f JOIN q USING (split)",
    n="SELECT transaction_id, timestamp, ln(1 + amount_inr) AS la, row_number() OVER (ORDER BY timestamp, transaction_id) AS rn, count(*) OVER () AS n FROM txn",
    f="SELECT *, CASE WHEN rn <= CAST(floor(n * 0.6::DOUBLE) AS BIGINT) THEN 'train' WHEN rn <= CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM n",
    q="SELECT split, quantile_cont(la, 0.9) AS q FROM f GROUP BY split",
))
def sc7(spark, sf):
    from txnmill.operators import features, order

    base = txn(spark, sf).select(ID, "timestamp", "amount_inr")
    split = features.add_amount_features(features.add_time_features(order.with_time_split(base)))
    limits = features.threshold_column(features.high_amount_thresholds(split, per_split=True))
    return features.add_interaction_features(split, limits).select(ID, "split", "night_high_amount")


@query("sc7_train_threshold", sql(
    "SELECT transaction_id, split, CASE WHEN hour(timestamp) <= 5 AND la > (SELECT quantile_cont(la, 0.9) FROM f WHERE split = 'train') THEN 1 ELSE 0 END AS night_high_amount FROM f",
    n="SELECT transaction_id, timestamp, ln(1 + amount_inr) AS la, row_number() OVER (ORDER BY timestamp, transaction_id) AS rn, count(*) OVER () AS n FROM txn",
    f="SELECT *, CASE WHEN rn <= CAST(floor(n * 0.6::DOUBLE) AS BIGINT) THEN 'train' WHEN rn <= CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM n",
))
def sc7_train(spark, sf):
    from txnmill.operators import features, order

    base = txn(spark, sf).select(ID, "timestamp", "amount_inr")
    split = features.add_amount_features(features.add_time_features(order.with_time_split(base)))
    limits = features.threshold_column(features.high_amount_thresholds(split))
    return features.add_interaction_features(split, limits).select(ID, "split", "night_high_amount")


@query("sc10_amount_segment", sql(
    "SELECT transaction_id, CASE WHEN amount_inr <= lo THEN 'low' WHEN amount_inr <= hi THEN 'mid' ELSE 'high' END AS amount_segment FROM txn, q",
    q="SELECT quantile_cont(amount_inr, 0.25) AS lo, quantile_cont(amount_inr, 0.9) AS hi FROM txn",
))
def sc10(spark, sf):
    from txnmill.operators.enrich import add_segments

    return add_segments(txn(spark, sf).select(ID, "amount_inr"))[0].select(ID, "amount_segment")


@query("sc11_amount_tier", sql(
    "SELECT CAST(CASE WHEN amount_inr <= a THEN 1 WHEN amount_inr <= b THEN 2 WHEN amount_inr <= c THEN 3 ELSE 4 END AS INT) AS tier, count(*) AS n "
    "FROM txn, q WHERE amount_inr > 0 GROUP BY 1",
    q="SELECT quantile_cont(amount_inr, 0.9) AS a, quantile_cont(amount_inr, 0.99) AS b, quantile_cont(amount_inr, 0.999) AS c FROM txn",
))
def sc11(spark, sf):
    from txnmill.operators.order import exact_quantiles

    base = txn(spark, sf).select("amount_inr")
    edges = exact_quantiles(base, {"amount_inr": [0.9, 0.99, 0.999, 1.0]})["amount_inr"]
    tier = S.amount_tier("amount_inr", [0.0, *edges]).alias("tier")
    return base.select(tier).where("tier is not null").groupBy("tier").agg(F.count("*").alias("n"))


@query("sc21_null_fill", sql(
    "SELECT row_key, coalesce(merchant_category, 'Unknown') AS category, "
    + r("coalesce(V1, (SELECT avg(V1) FROM req))") + " AS V1 FROM req", "req"))
def sc21(spark, sf):
    from .registry import requests

    base = requests(spark, sf).select("row_key", "merchant_category", "V1")
    mean = base.agg(F.avg("V1").alias("m")).scalar()
    return rounded(base.select("row_key", F.coalesce("merchant_category", F.lit("Unknown")).alias("category"), F.coalesce("V1", mean).alias("V1")))


# --- filters -----------------------------------------------------------------

@query("fl1_class_slice", sql("SELECT is_fraud, count(*) AS n, " + r("sum(V1)") + " AS total FROM (SELECT t.is_fraud, q.V1 FROM txn t JOIN req q ON q.row_key = t.transaction_id) WHERE is_fraud = 1 AND V1 IS NOT NULL GROUP BY 1", "txn req"))
def fl1(spark, sf):
    from .registry import REQUEST, events, over_events

    base = over_events(events(spark, sf), {"is_fraud": "CASE WHEN {k} >= 95 THEN 1 ELSE 0 END", "V1": REQUEST["V1"]})
    kept = base.where((F.col("is_fraud") == 1) & F.col("V1").isNotNull())
    return rounded(kept.groupBy("is_fraud").agg(F.count("*").alias("n"), F.sum("V1").alias("total")))


@query("fl2_first_day", sql("SELECT transaction_id, timestamp FROM txn WHERE timestamp < TIMESTAMP '2024-01-02 00:00:00'"))
def fl2(spark, sf):
    end = F.expr("timestamp_ntz'2024-01-01 00:00:00' + interval 24 hours")
    return txn(spark, sf).select(ID, "timestamp").where(F.col("timestamp") < end)


@query("fl3_minimum_support", sql(f"SELECT merchant_id, count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, {r('avg(is_fraud) * 100')} AS fraud_rate FROM txn GROUP BY 1 HAVING count(*) >= 250"))
def fl3(spark, sf):
    return rounded(profile.rate_by(txn(spark, sf), "merchant_id", min_rows=250))


@query("fl4_membership", sql("SELECT transaction_id, entry_mode FROM txn WHERE entry_mode IN ('Chip', 'Tap')"))
def fl4(spark, sf):
    return txn(spark, sf).select(ID, "entry_mode").where(F.col("entry_mode").isin("Chip", "Tap"))


@query("fl5_range", sql("SELECT transaction_id, CAST(hour(timestamp) AS INT) AS hour FROM txn WHERE hour(timestamp) BETWEEN 2 AND 5"))
def fl5(spark, sf):
    return txn(spark, sf).select(ID, S.hour_of("timestamp").alias("hour")).where(F.col("hour").between(2, 5))


@query("fl6_conditional_overwrite", sql(
    "SELECT transaction_id, CASE WHEN card_network = 'Amex' THEN 'American Express' ELSE card_issuer END AS card_issuer, "
    "CASE WHEN card_network = 'RuPay' THEN 0 ELSE is_international END AS is_international, "
    "CASE WHEN amount_inr * 500 > credit_limit THEN CAST(trunc(amount_inr * 500 * 1.2::DOUBLE) AS INT) ELSE credit_limit END AS credit_limit FROM txn"))
def fl6(spark, sf):
    over = F.col("amount_inr") * 500
    return txn(spark, sf).select(
        ID,
        F.when(F.col("card_network") == "Amex", "American Express").otherwise(F.col("card_issuer")).alias("card_issuer"),
        F.when(F.col("card_network") == "RuPay", 0).otherwise(F.col("is_international")).alias("is_international"),
        F.when(over > F.col("credit_limit"), S.truncated_product(over, 1.2)).otherwise(F.col("credit_limit")).alias("credit_limit"),
    )
