"""Aggregations, statistics and top-k reports."""

from txnmill.functions import scalars as S
from txnmill.operators import duplicates, encoding, order, profile, stats
from txnmill.operators.order import hash_sample
from txnmill.session import cut_lineage

from .registry import COMPONENTS, REQUEST, F, query, r, rounded, sales, sales_by_type, scored, sql, txn

_r = r

ID = "transaction_id"
CORRELATED = [*COMPONENTS, "amount_inr", "credit_limit", "card_age"]
DESCRIBED = ["amount_inr", "credit_limit", "card_age"]

ENCODINGS = (
    "SELECT merchant_category AS category, count(*) AS n, (sum(is_fraud) + {m}::DOUBLE * (SELECT avg(is_fraud) FROM {t})) "
    "/ (count(*) + {m}::DOUBLE) AS encoding FROM {t} WHERE merchant_category IS NOT NULL GROUP BY 1"
)


@query("flagship_rate_by_encoded_category", sql(
    f"SELECT merchant_category, {r('max(encoding)')} AS encoding, count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, "
    f"{r('avg(is_fraud) * 100')} AS fraud_rate, {r('avg(ln(1 + amount_inr))')} AS mean_log_amount, "
    "CAST(sum(CASE WHEN hour(timestamp) <= 5 THEN 1 ELSE 0 END) AS BIGINT) AS night, "
    "CAST(sum(CASE WHEN is_international = 1 AND transaction_channel = 'Online' THEN 1 ELSE 0 END) AS BIGINT) AS intl_online "
    "FROM txn JOIN enc ON merchant_category = category GROUP BY 1", enc=ENCODINGS.format(m=10, t="txn")))
def flagship(spark, sf):
    from txnmill.operators import features

    base = txn(spark, sf).select(ID, "timestamp", "amount_inr", "merchant_category", "is_international", "transaction_channel", "is_fraud")
    encoder = encoding.TargetEncoder.fit(base, "merchant_category")
    featured = encoder.transform(features.engineer(base))
    out = featured.groupBy("merchant_category").agg(
        F.max("merchant_category_encoded").alias("encoding"),
        F.count("*").alias("total"),
        F.sum("is_fraud").cast("long").alias("fraud_count"),
        (F.avg("is_fraud") * 100).alias("fraud_rate"),
        F.avg("log_amount").alias("mean_log_amount"),
        F.sum("is_night").cast("long").alias("night"),
        F.sum("intl_online").cast("long").alias("intl_online"),
    )
    return rounded(out)


@query("a1_target_encoding", sql(f"SELECT category, n, {r('encoding')} AS encoding FROM enc", enc=ENCODINGS.format(m=10, t="txn")))
def a1(spark, sf):
    return rounded(encoding.encoding_table(txn(spark, sf), "merchant_category"))


@query("a1_target_encoding_sales", sql(f"SELECT category, n, {r('encoding')} AS encoding FROM enc", "sales sales_by_type", enc=ENCODINGS.format(m=10, t="sales_by_type")))
def a1_sales(spark, sf):
    return rounded(encoding.encoding_table(sales_by_type(spark, sf), "merchant_category"))


@query("a2_category_mean", sql(f"SELECT category, n, {r('encoding')} AS encoding FROM enc", enc=ENCODINGS.format(m=0, t="txn")))
def a2(spark, sf):
    return rounded(encoding.encoding_table(txn(spark, sf), "merchant_category", smoothing=0.0))


def _rate_sql(dim, table="txn", having="", key=None):
    key = key or dim
    return f"SELECT {dim} AS {key}, count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, avg(is_fraud) * 100 AS fraud_rate FROM {table} GROUP BY 1 {having}"


RATE = f"total, fraud_count, {r('fraud_rate')} AS fraud_rate"


@query("a3_rate_by_entry_mode", sql(f"SELECT entry_mode, {RATE} FROM x", x=_rate_sql("entry_mode", having="HAVING count(*) >= 1000")))
def a3(spark, sf):
    return rounded(profile.rate_by(txn(spark, sf), "entry_mode", min_rows=1000).orderBy(F.desc("fraud_rate")))


@query("a3_rate_by_channel", sql(f"SELECT transaction_channel, {RATE} FROM x", x=_rate_sql("transaction_channel", having="HAVING count(*) >= 1000")))
def a3_channel(spark, sf):
    return rounded(profile.rate_by(txn(spark, sf), "transaction_channel", min_rows=1000).orderBy(F.desc("fraud_rate")))


@query("a3_rate_by_hour", sql(f"SELECT hour, {RATE} FROM x", x=_rate_sql("CAST(hour(timestamp) AS INT)", having="HAVING count(*) > 100", key="hour")))
def a3_hour(spark, sf):
    base = txn(spark, sf).select(S.hour_of("timestamp").alias("hour"), "is_fraud")
    return rounded(profile.rate_by(base, "hour", min_rows=101).orderBy(F.desc("fraud_rate")))


@query("a3_rate_by_part_type", sql(f"SELECT merchant_category, {RATE} FROM x", "sales sales_by_type", x=_rate_sql("merchant_category", "sales_by_type")))
def a3_sales(spark, sf):
    return rounded(profile.rate_by(sales_by_type(spark, sf), "merchant_category"))


PAIRS = [("hour", "merchant_category"), ("entry_mode", "transaction_channel"), ("is_international", "card_network")]
_PAIR_SQL = " UNION ALL ".join(
    f"SELECT '{a}+{b}' AS pair, CAST({a} AS STRING) AS first, CAST({b} AS STRING) AS second, count(*) AS total, "
    f"CAST(sum(is_fraud) AS BIGINT) AS fraud_count, avg(is_fraud) * 100 AS fraud_rate FROM h GROUP BY 2, 3 HAVING count(*) >= 50"
    for a, b in PAIRS
)


@query("a4_hotspots", sql(
    f"SELECT pair, first, second, {RATE}, CAST(place AS INT) AS place, {r('fraud_rate / (SELECT avg(is_fraud) * 100 FROM txn)')} AS multiple "
    "FROM (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY fraud_rate DESC, first, second) AS place FROM g) WHERE place <= 3",
    h="SELECT *, hour(timestamp) AS hour FROM txn", g=_PAIR_SQL))
def a4(spark, sf):
    base = txn(spark, sf).withColumn("hour", S.hour_of("timestamp"))
    return rounded(profile.hotspots(base, PAIRS))


@query("a5_frequency", sql("SELECT merchant_category AS value, count(*) AS n FROM txn WHERE merchant_category IS NOT NULL GROUP BY 1"))
def a5(spark, sf):
    return profile.frequency(txn(spark, sf), "merchant_category")


@query("a6_share", sql(f"SELECT merchant_category AS value, count(*) AS n, {r('count(*) / (SELECT count(merchant_category) FROM req)')} AS share FROM req WHERE merchant_category IS NOT NULL GROUP BY 1", "req"))
def a6(spark, sf):
    from .registry import requests

    return rounded(profile.share(requests(spark, sf), "merchant_category"))


@query("a7_cross_table", sql("SELECT card_network, " + ", ".join(f"count(*) FILTER (WHERE card_tier = '{t}') AS \"c_{t}\"" for t in ("Classic", "Gold", "Platinum", "Signature", "None")) + " FROM txn GROUP BY 1"))
def a7(spark, sf):
    return profile.cross_table(txn(spark, sf), "card_network", "card_tier", ["Classic", "Gold", "Platinum", "Signature", "None"])


def _describe_sql(table, columns, where="", places=6):
    r = lambda e: _r(e, places)
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, {r(f'min({c})')} AS min, "
        f"{r(f'quantile_cont({c}, 0.25)')} AS q25, {r(f'quantile_cont({c}, 0.5)')} AS q50, {r(f'quantile_cont({c}, 0.75)')} AS q75, {r(f'max({c})')} AS max FROM {table} {where}"
        for c in columns
    )


@query("a8_describe", sql(_describe_sql("txn", DESCRIBED)))
def a8(spark, sf):
    return rounded(profile.describe(txn(spark, sf).select(*DESCRIBED), DESCRIBED))


@query("a8_describe_category", sql(_describe_sql("txn", ["amount_inr"], "WHERE merchant_category = 'purchase'")))
def a8_category(spark, sf):
    kept = txn(spark, sf).where(F.col("merchant_category") == "purchase").select("amount_inr")
    return rounded(profile.describe(kept, ["amount_inr"]))


@query("a8_describe_sales", sql(_describe_sql("sales", ["amount_inr", "discount"], places=5), "sales"))
def a8_sales(spark, sf):
    return rounded(profile.describe(sales(spark, sf).select("amount_inr", "discount"), ["amount_inr", "discount"]), 5)


LEVELS = [0.5, 0.9, 0.95, 0.99, 0.999, 0.9999]


@query("a9_percentiles", sql(" UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS p, {r(f'quantile_cont(amount_inr, {p})')} AS value FROM txn" for p in LEVELS)))
def a9(spark, sf):
    return rounded(profile.percentiles(txn(spark, sf).select("amount_inr"), "amount_inr", LEVELS))


@query("a9_percentiles_sales", sql(" UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS p, {r(f'quantile_cont(amount_inr, {p})')} AS value FROM sales" for p in LEVELS), "sales"))
def a9_sales(spark, sf):
    return rounded(profile.percentiles(sales(spark, sf).select("amount_inr"), "amount_inr", LEVELS))


@query("a10_cut_points", sql(f"SELECT {r('quantile_cont(amount_inr, 0.25)')} AS low, {r('quantile_cont(amount_inr, 0.9)')} AS high FROM txn"))
def a10(spark, sf):
    low, high = order.exact_quantiles(txn(spark, sf).select("amount_inr"), {"amount_inr": [0.25, 0.9]})["amount_inr"]
    return rounded(spark.createDataFrame([(low, high)], "low double, high double"))


@query("a11_distinct_count", sql("SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT merchant_id) AS merchant_id, count(DISTINCT transaction_id) AS transaction_id FROM txn"))
def a11(spark, sf):
    return profile.distinct_count(txn(spark, sf), "user_id", "merchant_id", "transaction_id")


@query("a11_distinct_count_approx")
def a11_approx(spark, sf):
    return profile.distinct_count_approx(txn(spark, sf), "user_id", "merchant_id")


# Standard error of a sketch of 2^12 registers is 1.04 / sqrt(2^12); four of them are the bound.
@query("a11_distinct_sketches_by_day", sql(
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", d AS \"from\", count(DISTINCT {c}) AS exact, TRUE AS within_bound FROM (SELECT *, CAST(timestamp AS DATE) AS day FROM txn) t, (SELECT DISTINCT CAST(timestamp AS DATE) AS d FROM txn) WHERE day >= d GROUP BY d" for c in ("user_id", "merchant_id", "transaction_id"))))
def a11_sketches(spark, sf):
    """Sketches of each day, merged over the days from each day on, against the exact count of the same rows."""
    columns = ["user_id", "merchant_id", "transaction_id"]
    rows = txn(spark, sf).select(F.to_date("timestamp").alias("day"), *columns)
    sketches = cut_lineage(profile.distinct_sketches(rows, "day", columns), "sketches")
    first = sketches.select(F.col("day").alias("from")).distinct()
    merged = profile.merged_distinct(sketches, first, "day", columns)
    exact = first.join(rows, F.col("day") >= F.col("from")).groupBy("from").agg(*[F.countDistinct(c).alias(c) for c in columns]).unpivot(["from"], columns, "column", "exact")
    return merged.join(exact, ["from", "column"]).select("column", "from", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(0.5), F.col("exact") * profile.SKETCH_ERROR)).alias("within_bound"))


@query("a12_distinct_values", sql("SELECT DISTINCT card_issuer FROM txn WHERE card_network = 'Amex'"))
def a12(spark, sf):
    return profile.distinct_values(txn(spark, sf), "card_issuer", F.col("card_network") == "Amex")


@query("a13_value_range", sql("SELECT min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp, min(amount_inr) AS min_amount_inr, max(amount_inr) AS max_amount_inr FROM txn"))
def a13(spark, sf):
    return profile.value_range(txn(spark, sf), "timestamp", "amount_inr")


@query("a14_group_mean", sql(f"SELECT card_tier, {r('avg(credit_limit)')} AS mean FROM txn GROUP BY 1"))
def a14(spark, sf):
    return rounded(profile.group_mean(txn(spark, sf), "card_tier", "credit_limit"))


@query("a14_international_by_class", sql(f"SELECT is_fraud, {r('avg(is_international)')} AS mean FROM txn GROUP BY 1"))
def a14_class(spark, sf):
    return rounded(profile.group_mean(txn(spark, sf), "is_fraud", "is_international"))


@query("a15_rows_by_hour", sql("SELECT CAST(hour(timestamp) AS INT) AS hour, count(*) AS n FROM txn WHERE timestamp < TIMESTAMP '2024-01-02 00:00:00' GROUP BY 1"))
def a15(spark, sf):
    return profile.rows_by_hour(txn(spark, sf), "2024-01-01")


@query("a16_concentration", sql(
    f"SELECT max(n) AS max_n, CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median_n, {r('sum(n) FILTER (WHERE rn <= 5) / (SELECT count(*) FROM txn) * 100')} AS top_percent FROM c",
    c="SELECT user_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, user_id) AS rn FROM txn GROUP BY 1"))
def a16(spark, sf):
    return rounded(profile.concentration(txn(spark, sf), "user_id"))


@query("a17_null_counts", sql(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM req" for c in ("amount", "merchant_category", "V1", "V2", "card_tier")), "req"))
def a17(spark, sf):
    from .registry import requests

    return profile.null_counts(requests(spark, sf), ["amount", "merchant_category", "V1", "V2", "card_tier"])


@query("a17_null_counts_all_columns", sql(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count(\"{c}\") AS nulls FROM req" for c in REQUEST), "req"))
def a17_all(spark, sf):
    from .registry import requests

    return profile.null_counts(requests(spark, sf), list(REQUEST))


@query("a17_critical_nulls", sql("SELECT (count(*) - count(amount)) + (count(*) - count(merchant_category)) + (count(*) - count(V1)) AS missing_critical FROM req", "req"))
def a17_critical(spark, sf):
    from .registry import requests

    return profile.critical_nulls(requests(spark, sf), ["amount", "merchant_category", "V1"])


_DUPLICATE_COLUMNS = ["user_id", "merchant_category", "amount_inr", "is_fraud", "merchant_state"]


@query("a18_exact_duplicates", sql(f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM txn GROUP BY {', '.join(_DUPLICATE_COLUMNS)} HAVING count(*) > 1)"))
def a18(spark, sf):
    return duplicates.exact_duplicates(txn(spark, sf).select(*_DUPLICATE_COLUMNS))


@query("a18_exact_duplicates_lineitem", "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM (SELECT l_partkey, l_suppkey, l_linenumber, l_returnflag FROM lineitem) GROUP BY l_partkey, l_suppkey, l_linenumber, l_returnflag HAVING count(*) > 1)")
def a18_lineitem(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return duplicates.exact_duplicates(rows)


_LINE = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()


@query("a18_exact_duplicates_whole_rows", f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM (SELECT {', '.join(_LINE)} FROM lineitem UNION ALL SELECT {', '.join(_LINE)} FROM lineitem WHERE l_linenumber = 1) GROUP BY {', '.join(_LINE)} HAVING count(*) > 1)")
def a18_whole(spark, sf):
    """All columns of the line items, of which those numbered 1 stand twice."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(*_LINE)
    return duplicates.exact_duplicates(rows.union(rows.where("l_linenumber = 1")))


@query("a19_sanity_counters", sql(
    "SELECT count(*) FILTER (WHERE amount_inr < 0) AS negative_amounts, count(*) FILTER (WHERE timestamp > TIMESTAMP '2024-01-20 00:00:00') AS future_dates, "
    "count(*) FILTER (WHERE credit_limit <= 0 OR credit_limit > 1000000000) AS impossible_limits, count(*) FILTER (WHERE card_age < 0) AS negative_age FROM txn"))
def a19(spark, sf):
    return profile.counters(txn(spark, sf), profile.sanity_conditions(F.expr("timestamp_ntz'2024-01-20 00:00:00'")))


@query("a20_class_balance", sql(f"SELECT {r('avg(is_fraud) * 100')} AS fraud_rate, {r('sum(1 - is_fraud) / sum(is_fraud)')} AS imbalance_ratio, {r('avg(1 - is_fraud) * 100')} AS baseline_accuracy FROM txn"))
def a20(spark, sf):
    return rounded(profile.class_balance(txn(spark, sf)))


@query("a21_class_weight", sql(f"SELECT {r('sum(1 - is_fraud) / sum(is_fraud)')} AS scale_pos_weight FROM txn"))
def a21(spark, sf):
    return rounded(profile.class_weight(txn(spark, sf)))


@query("a22_skewness", sql(f"SELECT {r('skewness(amount_inr)')} AS skewness FROM txn"))
def a22(spark, sf):
    return rounded(profile.skewness(txn(spark, sf), "amount_inr"))


_CORR = "SELECT \"column\", correlation FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", abs(corr({c}, is_fraud)) AS correlation FROM txn" for c in CORRELATED) + ") WHERE correlation >= 0.01"


@query("a23_target_correlations", sql(f"SELECT \"column\", {r('correlation')} AS correlation, CASE WHEN correlation > 0.3 THEN 'strong' WHEN correlation > 0.1 THEN 'moderate' ELSE 'weak' END AS strength FROM c", c=_CORR))
def a23(spark, sf):
    return rounded(stats.target_correlations(txn(spark, sf), CORRELATED))


_TOP5 = "SELECT \"column\" FROM c ORDER BY correlation DESC, \"column\" LIMIT 5"
_ALL_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS correlation FROM txn WHERE '{a}' IN (SELECT \"column\" FROM top) AND '{b}' IN (SELECT \"column\" FROM top)"
    for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1:] if {a, b} <= {"V7", "V8", "V14", "V15", "V21", "V28", "card_age"}
)


@query("a24_collinear_pairs", sql(
    f"SELECT least(a, b) AS a, greatest(a, b) AS b, {r('correlation')} AS correlation FROM p WHERE abs(correlation) > 0.5 AND correlation IS NOT NULL",
    c=_CORR, top=_TOP5, p=_ALL_PAIRS))
def a24(spark, sf):
    found = stats.collinear_pairs(txn(spark, sf), CORRELATED, above=0.5)
    return rounded(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "correlation"))


def _chi_sql(a, b):
    return dict(
        cells=f"SELECT {a} AS a, {b} AS b, count(*)::DOUBLE AS n FROM txn GROUP BY 1, 2",
        ra="SELECT a, sum(n) AS rn FROM cells GROUP BY 1",
        cb="SELECT b, sum(n) AS cn FROM cells GROUP BY 1",
        g="SELECT coalesce(n, 0) AS n, rn * cn / (SELECT sum(n) FROM cells) AS e FROM ra CROSS JOIN cb LEFT JOIN cells USING (a, b)",
        s="SELECT (SELECT count(*) FROM ra) AS r, (SELECT count(*) FROM cb) AS c",
    )


_CHI = f"SELECT {r('sum(CASE WHEN r = 2 AND c = 2 THEN power(abs(n - e) - least(0.5, abs(n - e)), 2) / e ELSE power(n - e, 2) / e END)')} AS chi2, CAST(max((r - 1) * (c - 1)) AS INT) AS dof FROM g, s"


@query("a25_chi_square", sql(_CHI, **_chi_sql("entry_mode", "is_fraud")))
def a25(spark, sf):
    return rounded(stats.chi_square(txn(spark, sf), "entry_mode", "is_fraud", with_p=False))


@query("a25_chi_square_2x2", sql(_CHI, **_chi_sql("transaction_channel", "is_fraud")))
def a25_2x2(spark, sf):
    return rounded(stats.chi_square(txn(spark, sf), "transaction_channel", "is_fraud", with_p=False))


# One less the series of the lower tail; twice the area between |t| and infinity by Simpson's rule on the rest.
_CHI_TAIL = (
    "greatest(0, 1 - (SELECT sum(exp(-x / 2 + (k / 2.0::DOUBLE + i) * ln(x / 2) - lgamma(k / 2.0::DOUBLE + i + 1))) FROM range(0, 4000) q(i)))"
)
_T_TAIL = (
    "CASE WHEN abs(t) > 60 THEN 0 ELSE greatest(0, 1 - 2 * abs(t) / 12000 * (SELECT sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp("
    "lgamma((dof + 1) / 2) - lgamma(dof / 2) - 0.5::DOUBLE * ln(dof * pi()) - (dof + 1) / 2 * ln(1 + power(t * i / 4000::DOUBLE, 2) / dof))) FROM range(0, 4001) q(i))) END"
)


def _verdict(p):
    return f"CASE WHEN {p} < 0.05 THEN 'significant' ELSE 'not significant' END AS verdict"


@query("a25_chi_square_p_values", sql(
    f"SELECT {r('x')} AS chi2, k AS dof, {r('p')} AS p_value, {_verdict('p')} FROM (SELECT *, CASE WHEN x <= 0 THEN 1 WHEN x > 1500 + 10 * k THEN 0 ELSE {_CHI_TAIL} END AS p FROM z)",
    **_chi_sql("entry_mode", "is_fraud"), z="SELECT sum(CASE WHEN r = 2 AND c = 2 THEN power(abs(n - e) - least(0.5, abs(n - e)), 2) / e ELSE power(n - e, 2) / e END) AS x, CAST(max((r - 1) * (c - 1)) AS INT) AS k FROM g, s"))
def a25_p(spark, sf):
    return rounded(stats.chi_square(txn(spark, sf), "entry_mode", "is_fraud"))


_WELCH = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", m0, m1, (m0 - m1) / sqrt(v0 / n0 + v1 / n1) AS t, power(v0 / n0 + v1 / n1, 2) / (power(v0 / n0, 2) / (n0 - 1) + power(v1 / n1, 2) / (n1 - 1)) AS dof FROM "
    f"(SELECT avg({c}) FILTER (WHERE is_fraud = 0) AS m0, avg({c}) FILTER (WHERE is_fraud = 1) AS m1, var_samp({c}) FILTER (WHERE is_fraud = 0) AS v0, "
    f"var_samp({c}) FILTER (WHERE is_fraud = 1) AS v1, count({c}) FILTER (WHERE is_fraud = 0) AS n0, count({c}) FILTER (WHERE is_fraud = 1) AS n1 FROM txn)"
    for c in DESCRIBED)
_WELCH_COLUMNS = f"\"column\", {r('m0')} AS mean_legit, {r('m1')} AS mean_fraud, {r('t')} AS t, {r('dof')} AS dof"


@query("a26_welch_test", sql(f"SELECT {_WELCH_COLUMNS} FROM w", w=_WELCH))
def a26(spark, sf):
    return rounded(stats.welch_test(txn(spark, sf), DESCRIBED, with_p=False))


@query("a26_welch_p_values", sql(f"SELECT {_WELCH_COLUMNS}, {r('p')} AS p_value, {_verdict('p')} FROM (SELECT *, {_T_TAIL} AS p FROM w)", w=_WELCH))
def a26_p(spark, sf):
    return rounded(stats.welch_test(txn(spark, sf), DESCRIBED))


@query("a27_rate_by_tier", sql(
    f"SELECT CAST(CASE WHEN amount_inr <= a THEN 1 WHEN amount_inr <= b THEN 2 WHEN amount_inr <= c THEN 3 ELSE 4 END AS INT) AS tier, {r('avg(is_fraud) * 100')} AS fraud_rate FROM txn, q WHERE amount_inr > 0 GROUP BY 1",
    q="SELECT quantile_cont(amount_inr, 0.9) AS a, quantile_cont(amount_inr, 0.99) AS b, quantile_cont(amount_inr, 0.999) AS c FROM txn"))
def a27(spark, sf):
    return rounded(profile.amount_tiers(txn(spark, sf).select("amount_inr", "is_fraud")))


@query("a28_mean_of_hourly_rates", sql(
    f"SELECT {r('avg(fraud_rate)')} AS mean_rate, {r('(SELECT avg(is_fraud) * 100 FROM txn)')} AS baseline, coalesce(avg(fraud_rate) > 2 * (SELECT avg(is_fraud) * 100 FROM txn), FALSE) AS spike "
    "FROM x WHERE hour BETWEEN 2 AND 5", x=_rate_sql("hour(timestamp)", having="HAVING count(*) > 100", key="hour")))
def a28(spark, sf):
    base = txn(spark, sf).select(S.hour_of("timestamp").alias("hour"), "is_fraud")
    return rounded(profile.mean_of_group_rates(base, "hour", 2, 5))


SPLIT = dict(
    n="SELECT *, row_number() OVER (ORDER BY timestamp, transaction_id) AS rn, count(*) OVER () AS n FROM txn",
    f="SELECT *, CASE WHEN rn <= CAST(floor(n * 0.6::DOUBLE) AS BIGINT) THEN 'train' WHEN rn <= CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM n",
)


@query("a29_split_summary", sql(
    f"SELECT split, count(*) AS n, min(timestamp) AS first_ts, max(timestamp) AS last_ts, {r('avg(is_fraud) * 100')} AS fraud_rate, {r('count(*) / max(n) * 100')} AS percent FROM f GROUP BY split", **SPLIT))
def a29(spark, sf):
    return rounded(profile.split_summary(order.with_time_split(txn(spark, sf).select(ID, "timestamp", "is_fraud"))))


@query("a30_flag_share", sql(f"SELECT CAST(sum(i) AS BIGINT) AS flagged, {r('avg(i) * 100')} AS percent FROM (SELECT CASE WHEN is_international = 1 AND transaction_channel = 'Online' THEN 1 ELSE 0 END AS i FROM txn)"))
def a30(spark, sf):
    return rounded(profile.flag_share(txn(spark, sf).select(S.intl_online().alias("flag")), "flag"))


@query("a31_predicted_total", sql("SELECT CAST(sum(CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS detected, count(*) AS rows FROM scored", "scored"))
def a31(spark, sf):
    return profile.predicted_total(scored(spark, sf).select(S.over_threshold("prob").alias("is_fraud_predicted")))


@query("a32_shape", sql("SELECT count(*) AS rows, CAST(46 AS INT) AS columns FROM txn"))
def a32(spark, sf):
    return profile.shape(txn(spark, sf))


@query("a33_histogram", sql(
    "SELECT CAST(least(floor((x - lo) / (hi - lo) * 100), 99) AS INT) AS bin, count(*) AS n FROM (SELECT ln(1 + amount_inr) AS x FROM txn), e GROUP BY 1",
    e="SELECT ln(1 + min(amount_inr)) AS lo, ln(1 + max(amount_inr)) AS hi FROM txn"))
def a33(spark, sf):
    return profile.histogram(txn(spark, sf), S.log_amount("amount_inr"))


# --- windows ------------------------------------------------------------------

_NEAR = (
    "SELECT count(*) AS near_duplicates FROM (SELECT timestamp, amount_inr, lag(timestamp) OVER w AS pt, lag(amount_inr) OVER w AS pa "
    "FROM {t} WINDOW w AS (PARTITION BY {k} ORDER BY timestamp, transaction_id)) WHERE amount_inr = pa AND epoch_us(timestamp) - epoch_us(pt) < {g}"
)


@query("w1_near_duplicates", sql(_NEAR.format(t="txn", k="user_id", g=10_000_000)))
def w1(spark, sf):
    return duplicates.near_duplicates(txn(spark, sf))


@query("w1_near_duplicates_wide_gap", sql(_NEAR.format(t="txn", k="merchant_category", g=3_600_000_000)))
def w1_wide(spark, sf):
    return duplicates.near_duplicates(txn(spark, sf), key="merchant_category", gap_seconds=3600)


# --- top-k ---------------------------------------------------------------------

@query("t3_top_rows", sql("SELECT transaction_id, amount_inr, is_fraud FROM txn ORDER BY amount_inr DESC, transaction_id LIMIT 5"))
def t3(spark, sf):
    return txn(spark, sf).select(ID, "amount_inr", "is_fraud").orderBy(F.desc("amount_inr"), ID).limit(5)


@query("t4_top_hours", sql(
    f"SELECT hour, {RATE}, {r('fraud_rate / (SELECT avg(is_fraud) * 100 FROM txn)')} AS multiple FROM x ORDER BY x.fraud_rate DESC, hour LIMIT 5",
    x=_rate_sql("CAST(hour(timestamp) AS INT)", having="HAVING count(*) > 100", key="hour")))
def t4(spark, sf):
    base = txn(spark, sf).select(S.hour_of("timestamp").alias("hour"), "is_fraud")
    return rounded(profile.top_rates(base, "hour"))


@query("t6_top_encodings", sql(f"SELECT category, {r('encoding')} AS encoding FROM enc ORDER BY enc.encoding DESC, category LIMIT 3", enc=ENCODINGS.format(m=0, t="txn")))
def t6(spark, sf):
    table = encoding.encoding_table(txn(spark, sf), "merchant_category", smoothing=0.0)
    return rounded(table.select("category", "encoding").orderBy(F.desc("encoding"), "category").limit(3))


@query("t7_top_correlations", sql(f"SELECT \"column\", {r('correlation')} AS correlation, CASE WHEN correlation > 0.3 THEN 'strong' WHEN correlation > 0.1 THEN 'moderate' ELSE 'weak' END AS strength FROM c ORDER BY c.correlation DESC, \"column\" LIMIT 10", c=_CORR))
def t7(spark, sf):
    return rounded(stats.top_correlations(txn(spark, sf), CORRELATED))


@query("t11_first_of_frequency", sql("SELECT card_age AS value, count(*) AS n FROM txn GROUP BY 1 ORDER BY value LIMIT 5"))
def t11(spark, sf):
    return profile.frequency(txn(spark, sf), "card_age").orderBy("value").limit(5)


@query("t11_top_of_frequency", sql("SELECT merchant_city AS value, count(*) AS n FROM txn GROUP BY 1 ORDER BY n DESC, value LIMIT 5"))
def t11_top(spark, sf):
    return profile.frequency(txn(spark, sf), "merchant_city").limit(5)


@query("t12_preview", sql("SELECT transaction_id, timestamp, amount_inr FROM txn ORDER BY timestamp, transaction_id LIMIT 5"))
def t12(spark, sf):
    return txn(spark, sf).select(ID, "timestamp", "amount_inr").orderBy("timestamp", ID).limit(5)


@query("r14_hash_sample", sql("SELECT transaction_id, amount_inr FROM txn ORDER BY substr(md5(concat(CAST(transaction_id AS STRING), 'sample')), 1, 13), transaction_id LIMIT 100"))
def r14(spark, sf):
    return hash_sample(txn(spark, sf).select(ID, "amount_inr"), 100)
