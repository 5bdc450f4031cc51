"""Splits, sorts and running sums."""

from txnmill.operators import drift, features, metrics, order, rules

from .aggregates import ENCODINGS, SPLIT
from .registry import F, query, r, rounded, sales, scored, sql, txn

ID = "transaction_id"


@query("w2_time_split", sql("SELECT transaction_id, split FROM f", **SPLIT))
def w2(spark, sf):
    return order.with_time_split(txn(spark, sf).select(ID, "timestamp")).select(ID, "split")


# Sales have many rows per day and a text id: ties go by 52 bits of its md5.
@query("w2_time_split_sales", sql(
    f"SELECT split, count(*) AS n, {r('sum(amount_inr)', 1)} AS amount FROM f GROUP BY split", "sales",
    n="SELECT *, row_number() OVER (ORDER BY timestamp, substr(md5(transaction_id), 1, 13)) AS rn, count(*) OVER () AS n FROM sales", f=SPLIT["f"]))
def w2_sales(spark, sf):
    split = order.with_time_split(sales(spark, sf).select(ID, "timestamp", "amount_inr"))
    return rounded(split.groupBy("split").agg(F.count("*").alias("n"), F.sum("amount_inr").alias("amount")), 1)


HALVES = dict(h="SELECT *, CASE WHEN row_number() OVER (ORDER BY timestamp, transaction_id) <= (count(*) OVER ()) // 2 THEN 'reference' ELSE 'current' END AS side FROM txn")


@query("w3_two_way_split", sql("SELECT transaction_id, side FROM h", **HALVES))
def w3(spark, sf):
    first, rest = order.split_reference_current(txn(spark, sf).select(ID, "timestamp"))
    return first.select(ID, F.lit("reference").alias("side")).unionByName(rest.select(ID, F.lit("current").alias("side")))


@query("w4_running_counts", sql(
    "SELECT prob AS score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(neg) OVER w AS BIGINT) AS cum_neg FROM g WINDOW w AS (ORDER BY prob DESC)", "scored",
    g="SELECT prob, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM scored GROUP BY 1").replace("SELECT prob AS score", f"SELECT {r('prob')} AS score"))
def w4(spark, sf):
    return rounded(metrics.score_curve(scored(spark, sf)).select("score", "pos", "neg", "cum_pos", "cum_neg"))


WALKED = ["amount_inr", "card_age", "V7"]


def walk_sql(columns, cte="h"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value, count(*) FILTER (WHERE side = 'reference') AS ref, count(*) FILTER (WHERE side = 'current') AS cur FROM {cte} WHERE {c} IS NOT NULL GROUP BY 2"
        for c in columns
    )


CUM = "SELECT *, CAST(sum(ref) OVER w AS BIGINT) AS cum_ref, CAST(sum(cur) OVER w AS BIGINT) AS cum_cur, sum(ref) OVER (PARTITION BY \"column\") AS n_ref, sum(cur) OVER (PARTITION BY \"column\") AS n_cur, lead(value) OVER w AS nxt FROM p WINDOW w AS (PARTITION BY \"column\" ORDER BY value)"


@query("w5_two_sample_walk", sql(f"SELECT \"column\", {r('value')} AS value, ref, cur, cum_ref, cum_cur FROM c", **HALVES, p=walk_sql(WALKED), c=CUM))
def w5(spark, sf):
    first, rest = order.split_reference_current(txn(spark, sf).select(ID, "timestamp", *WALKED))
    walk = drift.numeric_walk(first, rest, WALKED)
    return rounded(walk.select("column", "value", "ref", "cur", "cum_ref", "cum_cur"))


@query("t1_sort_by_time", sql("SELECT transaction_id, timestamp FROM txn"))
def t1(spark, sf):
    return txn(spark, sf).select(ID, "timestamp").orderBy("timestamp", ID)


@query("t2_sort_by_user_time", sql("SELECT user_id, timestamp, transaction_id FROM txn"))
def t2(spark, sf):
    return txn(spark, sf).select("user_id", "timestamp", ID).orderBy("user_id", "timestamp", ID)


@query("t5_top_per_city", sql(
    f"SELECT merchant_city, entry_mode, {r('rate')} AS rate, CAST(place AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY merchant_city ORDER BY rate DESC, entry_mode) AS place FROM g) WHERE place <= 3",
    g="SELECT merchant_city, entry_mode, avg(is_fraud) * 100 AS rate FROM txn GROUP BY 1, 2"))
def t5(spark, sf):
    from pyspark.sql import Window

    rates = txn(spark, sf).groupBy("merchant_city", "entry_mode").agg((F.avg("is_fraud") * 100).alias("rate"))
    place = F.row_number().over(Window.partitionBy("merchant_city").orderBy(F.desc("rate"), "entry_mode"))
    return rounded(rates.withColumn("place", place).where("place <= 3"))


@query("v12_no_time_leakage", sql(
    "SELECT max(timestamp) FILTER (WHERE split = 'train') <= min(timestamp) FILTER (WHERE split = 'val') AS train_val_ok, "
    "max(timestamp) FILTER (WHERE split = 'val') <= min(timestamp) FILTER (WHERE split = 'test') AS val_test_ok FROM f", **SPLIT))
def v12(spark, sf):
    return rules.no_time_leakage(order.with_time_split(txn(spark, sf).select(ID, "timestamp")))


@query("ml1_feature_job", sql(
    f"SELECT transaction_id, split, CAST(hour(timestamp) AS INT) AS hour, CAST(isodow(timestamp) - 1 AS INT) AS day_of_week, CASE WHEN hour(timestamp) <= 5 THEN 1 ELSE 0 END AS is_night, "
    f"CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend, {r('ln(1 + amount_inr)')} AS log_amount, "
    "CASE WHEN is_international = 1 AND transaction_channel = 'Online' THEN 1 ELSE 0 END AS intl_online, "
    "CASE WHEN hour(timestamp) <= 5 AND ln(1 + amount_inr) > q THEN 1 ELSE 0 END AS night_high_amount, "
    f"{r('encoding')} AS merchant_category_encoded FROM f JOIN q USING (split) JOIN enc ON merchant_category = category",
    **SPLIT, tr="SELECT * FROM f WHERE split = 'train'", q="SELECT split, quantile_cont(ln(1 + amount_inr), 0.9) AS q FROM f GROUP BY split",
    enc=ENCODINGS.format(m=10, t="tr")))
def ml1(spark, sf):
    base = txn(spark, sf).select(ID, "timestamp", "amount_inr", "is_international", "transaction_channel", "merchant_category", "is_fraud")
    featured, _ = features.engineer_splits(order.with_time_split(base), per_split=True)
    return rounded(featured.select(
        ID, "split", "hour", "day_of_week", "is_night", "is_weekend", "log_amount", "intl_online", "night_high_amount", "merchant_category_encoded"))
