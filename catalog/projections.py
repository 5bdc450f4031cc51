"""Projections, schema operators and set operators."""

from txnmill import schemas
from txnmill.operators import projection as P
from txnmill.operators import preprocess

from .registry import COMPONENTS, F, TXN, query, r, raw, requests, rounded, sql, txn

ID = "transaction_id"
COMPONENT_LIST = ", ".join(COMPONENTS)


@query("p1_storage_types", sql(
    "SELECT transaction_id, CAST(user_id AS STRING) AS user_id, CAST(is_fraud AS TINYINT) AS is_fraud, CAST(card_age AS SMALLINT) AS card_age, "
    "CAST(amount_inr AS FLOAT) AS amount_inr FROM txn"))
def p1(spark, sf):
    return P.apply_types(txn(spark, sf).select(ID, "user_id", "is_fraud", "card_age", "amount_inr"))


_CASTS = {"string": "VARCHAR", "tinyint": "TINYINT", "smallint": "SMALLINT", "float": "FLOAT"}


@query("p1_storage_types_all_columns", sql("SELECT " + ", ".join(f"CAST({c} AS {_CASTS[schemas.STORAGE_TYPES[c]]}) AS {c}" if c in schemas.STORAGE_TYPES else c for c in TXN) + " FROM txn"))
def p1_all(spark, sf):
    return P.apply_types(txn(spark, sf))


@query("p2_normalize_schema", sql(
    "SELECT row_key, Class AS is_fraud, Amount AS amount_inr, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(trunc(Time) AS BIGINT)) AS timestamp FROM raw", "raw"))
def p2(spark, sf):
    return P.normalize_schema(raw(spark, sf)).select("row_key", "is_fraud", "amount_inr", "timestamp")


@query("p3_finalize", sql(f"SELECT row_key, Class AS is_fraud, {', '.join(r(c) + ' AS ' + c for c in ('V1', 'V7', 'V28'))}, 'x' AS card_tier FROM raw", "raw"))
def p3(spark, sf):
    base = raw(spark, sf).select("row_key", "Time", "Amount", "Class", "V1", "V7", "V28", F.lit("x").alias("card_tier"), F.lit("low").alias("amount_segment"))
    return rounded(P.finalize(base))


@query("p3_finalize_all_columns", sql(f"SELECT row_key, Class AS is_fraud, {', '.join(r(c) + ' AS ' + c for c in COMPONENTS)}, 'x' AS card_tier FROM raw", "raw"))
def p3_all(spark, sf):
    return rounded(P.finalize(raw(spark, sf).withColumns({"card_tier": F.lit("x"), "amount_segment": F.lit("low")})))


FEATURES = [c for c in TXN if c not in schemas.NOT_FEATURES]
SMALL = [c for c in FEATURES if c not in COMPONENTS]


def filled(df):
    """``name, filled``: rows with a value, for each column, from one aggregate over the table."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "name", "filled")


@query("p4_feature_list", sql(" UNION ALL ".join(f'SELECT CAST({i} AS INT) AS pos, \'{c}\' AS name, count("{c}") AS filled FROM txn' for i, c in enumerate(FEATURES))))
def p4(spark, sf):
    from txnmill.sources.artifacts import feature_list

    table = txn(spark, sf)
    names = P.feature_columns(table)
    return feature_list(spark, names).join(filled(table.select(*names)), "name")


@query("p5_modeling_data", sql(f"SELECT {', '.join(SMALL)}, is_fraud FROM txn"))
def p5(spark, sf):
    return P.modeling_data(txn(spark, sf).drop(*COMPONENTS))


@query("p5_modeling_data_all_columns", sql("SELECT " + ", ".join(f"{r(c)} AS {c}" if c in COMPONENTS or c == "amount_inr" else c for c in FEATURES) + ", is_fraud FROM txn"))
def p5_all(spark, sf):
    return rounded(P.modeling_data(txn(spark, sf)))


@query("p6_widen_integers", sql(
    "SELECT amount_inr, CAST(credit_limit AS DOUBLE) AS credit_limit, CAST(card_age AS DOUBLE) AS card_age, card_tier, CAST(is_international AS DOUBLE) AS is_international, is_fraud FROM txn"))
def p6(spark, sf):
    return P.widen_integers(txn(spark, sf).select("amount_inr", "credit_limit", "card_age", "card_tier", "is_international", "is_fraud"))


@query("p7_example_types", sql("SELECT CAST(transaction_id AS DOUBLE) AS transaction_id, card_tier, CAST(card_age AS DOUBLE) AS card_age, amount_inr FROM txn"))
def p7(spark, sf):
    return P.example_types(txn(spark, sf).select(ID, "card_tier", "card_age", "amount_inr"))


@query("p8_drop_present", sql("SELECT transaction_id, entry_mode, is_fraud FROM txn"))
def p8(spark, sf):
    base = txn(spark, sf).select(ID, "entry_mode", "is_fraud", "merchant_category", "merchant_city", "card_issuer")
    return P.drop_present(base, ["merchant_category", "merchant_city", "merchant_state", "card_issuer", "first_name", "date_hour"])


@query("p9_align_columns", sql("SELECT CAST(0 AS INT) AS mode_Fax, card_age, is_fraud, transaction_id FROM txn"))
def p9(spark, sf):
    return P.align_columns(txn(spark, sf), ["mode_Fax", "card_age", "is_fraud", ID])


@query("p10_schema_diff", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {t} AS type, {m} AS missing, {x} AS extra, {s} AS is_string, {n} AS filled FROM txn"
    for c, t, m, x, s, n in [
        ("amount_inr", "'double'", "FALSE", "FALSE", "FALSE", "count(amount_inr)"), ("card_tier", "'string'", "FALSE", "FALSE", "TRUE", "count(card_tier)"),
        ("is_fraud", "'int'", "FALSE", "TRUE", "FALSE", "count(is_fraud)"), ("log_amount", "CAST(NULL AS STRING)", "TRUE", "FALSE", "FALSE", "count(NULL)"),
    ])))
def p10(spark, sf):
    table = txn(spark, sf).select("amount_inr", "card_tier", "is_fraud")
    diff = P.schema_diff(table, ["amount_inr", "card_tier", "log_amount"])
    return diff.join(filled(table).withColumnRenamed("name", "column"), "column", "left").withColumn("filled", F.coalesce("filled", F.lit(0)))


@query("u2_column_difference", sql("SELECT 'log_amount' AS \"column\", 'missing' AS side, count(NULL) AS filled FROM txn UNION ALL SELECT 'is_fraud', 'extra', count(is_fraud) FROM txn"))
def u2(spark, sf):
    diff = p10(spark, sf).where("missing or extra")
    return diff.select("column", F.when(F.col("missing"), "missing").otherwise("extra").alias("side"), "filled")


@query("p11_type_coercion", sql("SELECT transaction_id, timestamp, CAST(is_fraud AS SMALLINT) AS is_fraud FROM txn"))
def p11(spark, sf):
    text = txn(spark, sf).select(ID, F.col("timestamp").cast("string").alias("timestamp"), F.col("is_fraud").cast("double").alias("is_fraud"))
    return P.coerce_types(text)


MONITORED = [*schemas.DRIFT_NUMERIC, *schemas.DRIFT_CATEGORICAL]


@query("p12_monitored_columns", sql("SELECT " + ", ".join(r(c) + f" AS {c}" if c in COMPONENTS else c for c in MONITORED) + " FROM txn"))
def p12(spark, sf):
    base = txn(spark, sf)
    numeric, categorical = P.monitored(base)
    return rounded(base.select(*numeric, *categorical))


@query("u1_train_plus_validation", sql("SELECT card_tier, count(*) AS n FROM (SELECT card_tier FROM txn WHERE transaction_id % 2 = 0 UNION ALL SELECT card_tier FROM txn WHERE transaction_id % 3 = 0) GROUP BY 1"))
def u1(spark, sf):
    base = txn(spark, sf).select(ID, "card_tier")
    both = base.where(F.col(ID) % 2 == 0).unionByName(base.where(F.col(ID) % 3 == 0))
    return both.groupBy("card_tier").agg(F.count("*").alias("n"))


@query("ml2_one_hot_drop_first", sql(
    "SELECT transaction_id, CASE WHEN card_tier = 'Gold' THEN 1 ELSE 0 END AS \"card_tier_Gold\", CASE WHEN card_tier = 'Platinum' THEN 1 ELSE 0 END AS \"card_tier_Platinum\", "
    "CASE WHEN card_tier = 'Signature' THEN 1 ELSE 0 END AS \"card_tier_Signature\", CASE WHEN transaction_channel = 'POS' THEN 1 ELSE 0 END AS \"transaction_channel_POS\" FROM txn"))
def ml2(spark, sf):
    base = txn(spark, sf).select(ID, "card_tier", "transaction_channel")
    return preprocess.indicators(base, preprocess.categories(base, ["card_tier", "transaction_channel"]), drop_first=True)


_MODES, _NETS = ["CVC", "Chip", "Swipe", "Tap"], ["Amex", "Mastercard", "RuPay", "Visa"]


@query("ml3_dummies", sql(
    "SELECT transaction_id, " + ", ".join(
        [f"CASE WHEN entry_mode = '{m}' THEN 1 ELSE 0 END AS \"mode_{m}\"" for m in _MODES]
        + [f"CASE WHEN card_network = '{m}' THEN 1 ELSE 0 END AS \"net_{m}\"" for m in _NETS]) + " FROM txn"))
def ml3(spark, sf):
    base = txn(spark, sf).select(ID, "entry_mode", "card_network")
    values = preprocess.categories(base, ["entry_mode", "card_network"])
    return preprocess.indicators(base, values, {"entry_mode": "mode", "card_network": "net"})


SCALED = ["amount_inr", "credit_limit", "V7"]


@query("ml4_robust_scaling", sql(
    "SELECT transaction_id, " + ", ".join(r(f"({c} - {c}_m) / CASE WHEN {c}_s = 0 THEN 1 ELSE {c}_s END") + f" AS {c}" for c in SCALED) + " FROM txn, q",
    q="SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}_m, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_s" for c in SCALED) + " FROM txn"))
def ml4(spark, sf):
    base = txn(spark, sf).select(ID, *SCALED)
    return rounded(preprocess.robust_scale(base, preprocess.robust_parameters(base, SCALED)))


@query("ml5_preprocessor", sql(
    f"SELECT transaction_id, CASE WHEN card_tier = 'Gold' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS tier_gold, "
    f"{r('coalesce((amount_inr - m) / s, 0)')} AS amount_scaled, CAST(4 AS INT) AS width FROM txn, q",
    q="SELECT quantile_cont(amount_inr, 0.5) AS m, quantile_cont(amount_inr, 0.75) - quantile_cont(amount_inr, 0.25) AS s FROM txn"))
def ml5(spark, sf):
    from pyspark.ml.functions import vector_to_array

    base = txn(spark, sf).select(ID, "card_tier", "amount_inr")
    prepared = preprocess.create_preprocessor(base, ["card_tier", "amount_inr"])
    out = prepared.transform(base).withColumn("v", vector_to_array("features"))
    names = {r["name"]: r["index"] for r in prepared.names().collect()}
    at = lambda name: F.col("v")[names[name]]
    return rounded(out.select(ID, at("card_tier_Gold").alias("tier_gold"), at("amount_inr").alias("amount_scaled"), F.size("v").alias("width")))


TEXT = ["card_network", "card_issuer", "card_tier", "merchant_category", "merchant_city", "merchant_state", "transaction_channel", "entry_mode"]
NUMBERS = ["credit_limit", "card_age", "amount_inr", "is_international", "is_recurring", *[f"V{i}" for i in range(1, 29)]]


def _dictionary(first: int) -> dict[str, str]:
    """CTEs: every value of the text columns with its index in the model's vector; ``first`` values have none."""
    values = " UNION ".join(f"SELECT {k} AS nth, '{c}' AS col, {c} AS value FROM txn WHERE {c} IS NOT NULL" for k, c in enumerate(TEXT))
    return {
        "vals": values,
        "ranked": f"SELECT *, row_number() OVER (PARTITION BY nth ORDER BY value) - {first} AS place FROM vals",
        "dict": "SELECT col, value, CAST(row_number() OVER (ORDER BY nth, place) - 1 AS INT) AS idx FROM ranked WHERE place > 0",
        "cells": " UNION ALL ".join(f"SELECT transaction_id, '{c}' AS col, {c} AS value FROM txn" for c in TEXT),
    }


_INDICES = "SELECT t.transaction_id, coalesce(string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx), '') AS indices FROM txn t LEFT JOIN (cells JOIN dict USING (col, value)) c ON t.transaction_id = c.transaction_id GROUP BY 1"


def _indices(spark, sf, drop_first):
    base = txn(spark, sf).select(ID, *TEXT)
    out = preprocess.sparse_indicators(base, preprocess.Dictionary.fit(base, TEXT, drop_first))
    return out.select(ID, F.array_join(F.transform("indices", lambda i: i.cast("string")), ",").alias("indices"))


@query("ml2_one_hot_all_columns", sql(_INDICES, **_dictionary(1)))
def ml2_all(spark, sf):
    return _indices(spark, sf, True)


@query("ml3_dummies_all_columns", sql(_INDICES, **_dictionary(0)))
def ml3_all(spark, sf):
    return _indices(spark, sf, False)


@query("ml4_robust_scaling_all_columns", sql(
    "SELECT transaction_id, " + ", ".join(r(f"({c} - {c}_m) / CASE WHEN {c}_s = 0 THEN 1 ELSE {c}_s END") + f' AS "{c}"' for c in NUMBERS) + " FROM txn, q",
    q="SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}_m, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_s" for c in NUMBERS) + " FROM txn"))
def ml4_all(spark, sf):
    base = txn(spark, sf).select(ID, *NUMBERS)
    return rounded(preprocess.robust_scale(base, preprocess.robust_parameters(base, NUMBERS)))


@query("ml5_preprocessor_all_columns", sql(
    "SELECT transaction_id, col || '_' || value AS name, CAST(1 AS DOUBLE) AS value FROM cells JOIN dict USING (col, value) UNION ALL "
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT transaction_id, '{c}' AS name, {r(f'coalesce(({c} - {c}_m) / CASE WHEN {c}_s = 0 THEN 1 ELSE {c}_s END, 0)')} AS value FROM txn, q" for c in NUMBERS) + ") WHERE value <> 0",
    q="SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}_m, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_s" for c in NUMBERS) + " FROM txn", **_dictionary(1)))
def ml5_all(spark, sf):
    """The entries of every vector that are not 0, by name."""
    from pyspark.ml.functions import vector_to_array

    base = txn(spark, sf).select(ID, *TEXT, *NUMBERS)
    prepared = preprocess.create_preprocessor(base, TEXT + NUMBERS)
    cells = prepared.transform(base).select(ID, F.posexplode(vector_to_array("features")).alias("index", "value"))
    return rounded(cells.join(prepared.names(), "index").select(ID, "name", "value")).where("value <> 0")
