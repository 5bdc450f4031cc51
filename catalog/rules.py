"""Validation suites, record contract, quarantine."""

from txnmill import schemas
from txnmill.operators import enrich, lookups, rules

from .registry import COMPONENTS, F, query, r, raw, requests, rounded, sql, txn

ID = "transaction_id"


def _bad(rule):
    if rule.kind == "not_null":
        return f"{rule.column} IS NULL"
    if rule.kind == "between":
        return f"{rule.column} < {rule.low}"
    return f"{rule.column} NOT IN ({', '.join(str(v) for v in rule.values)})"


def _suite_sql(table, suite, missing=0):
    parts = []
    for i, rule in enumerate(suite):
        count = f"CAST({missing} AS BIGINT)" if rule.kind == "columns_present" else f"(SELECT count(*) FROM {table} WHERE {_bad(rule)})"
        parts.append(f"SELECT CAST({i} AS INT) AS position, '{rule.kind}' AS rule, '{rule.column}' AS \"column\", {count} AS unexpected_count")
    return "SELECT position, rule, \"column\", unexpected_count = 0 AS ok, unexpected_count FROM (" + " UNION ALL ".join(parts) + ")"


_PRESENT = [rules.raw_suite()[0], rules.Rule("not_null", "Amount"), rules.Rule("between", "Amount", low=1.0)]


@query("v1_columns_present", sql(_suite_sql("raw", _PRESENT, missing=len(COMPONENTS)), "raw"))
def v1(spark, sf):
    return rules.check(raw(spark, sf).drop(*COMPONENTS), _PRESENT)


NULLS = [rules.Rule("not_null", c) for c in ("amount", "V1", "merchant_category")]
RANGES = [rules.Rule("between", c, low=0.0) for c in ("amount", "time", "credit_limit", "card_age")]
SETS = [rules.Rule("in_set", c, values=(0, 1)) for c in ("is_international", "is_recurring")]


@query("v2_not_null", sql(_suite_sql("req", NULLS), "req"))
def v2(spark, sf):
    return rules.check(requests(spark, sf), NULLS)


@query("v3_between", sql(_suite_sql("req", RANGES), "req"))
def v3(spark, sf):
    return rules.check(requests(spark, sf), RANGES)


@query("v4_in_set", sql(_suite_sql("req", SETS), "req"))
def v4(spark, sf):
    return rules.check(requests(spark, sf), SETS)


@query("v5_raw_suite", sql(_suite_sql("raw", rules.raw_suite()), "raw"))
def v5(spark, sf):
    return rules.check(raw(spark, sf), rules.raw_suite())


@query("v6_processed_suite", sql(_suite_sql("txn", rules.processed_suite())))
def v6(spark, sf):
    return rules.check(txn(spark, sf), rules.processed_suite())


@query("v7_stored_raw_suite", sql(_suite_sql("raw", rules.raw_suite(all_components=True)), "raw"))
def v7(spark, sf):
    return rules.check(raw(spark, sf), rules.raw_suite(all_components=True))


_ALL = [*NULLS, *RANGES, *SETS]


def _sample_sql(i, rule):
    value = f"coalesce(CAST({rule.column} AS STRING), 'null')"
    return (f"SELECT CAST({i} AS INT) AS position, string_agg(v, '|' ORDER BY row_key) AS samples FROM "
            f"(SELECT row_key, {value} AS v FROM req WHERE {_bad(rule)} ORDER BY row_key LIMIT 3)")


@query("v8_run_suite", sql(
    f"SELECT c.position, c.rule, c.\"column\", c.ok, c.unexpected_count, coalesce(s.samples, '') AS samples FROM ({_suite_sql('req', _ALL)}) c "
    f"LEFT JOIN ({' UNION ALL '.join(_sample_sql(i, x) for i, x in enumerate(_ALL))}) s ON c.position = s.position", "req"))
def v8(spark, sf):
    out = rules.run_suite(requests(spark, sf), _ALL, "row_key")
    return out.withColumn("samples", F.coalesce(F.array_join("samples", "|"), F.lit("")))


@query("v9_gate", sql("SELECT count(*) AS rows FROM txn"))
def v9(spark, sf):
    return rules.gate(txn(spark, sf), rules.processed_suite(), ID).agg(F.count("*").alias("rows"))


_CONTRACT = {
    "amount": "amount > 0", "time": "time >= 0", "card_tier": "card_tier IN ('Classic', 'Gold', 'Platinum', 'Signature')",
    "credit_limit": "credit_limit > 0", "card_age": "card_age >= 0", "transaction_channel": "transaction_channel IN ('Online', 'POS')",
    "is_international": "is_international BETWEEN 0 AND 1", "is_recurring": "is_recurring BETWEEN 0 AND 1", **{c: f"{c} IS NOT NULL" for c in COMPONENTS},
}
_BROKEN = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({e}, FALSE) THEN '{n}' END" for n, e in _CONTRACT.items()) + ")"


@query("v10_record_contract", sql(f"SELECT row_key, {_BROKEN} AS broken FROM req", "req"))
def v10(spark, sf):
    marked = rules.with_broken_rules(requests(spark, sf), rules.request_contract())
    return marked.select("row_key", F.array_join("broken", ",").alias("broken"))


@query("v10_quarantine", sql("SELECT broken, count(*) AS n FROM b WHERE broken <> '' GROUP BY 1", "req", b=f"SELECT {_BROKEN} AS broken FROM req"))
def v10_quarantine(spark, sf):
    _, bad = rules.split_by_contract(requests(spark, sf), rules.request_contract())
    return bad.groupBy(F.array_join("broken", ",").alias("broken")).agg(F.count("*").alias("n"))


def _customer():
    return {"c_acctbal": F.col("c_acctbal") >= 0, "c_mktsegment": F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "c_nationkey": F.col("c_nationkey") < 20}


@query("v10_customer_quarantine", "SELECT c_custkey, concat_ws(',', CASE WHEN NOT c_acctbal >= 0 THEN 'c_acctbal' END, CASE WHEN NOT c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'c_mktsegment' END, "
       "CASE WHEN NOT c_nationkey < 20 THEN 'c_nationkey' END) AS broken FROM customer WHERE NOT (c_acctbal >= 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey < 20)")
def v10_customer(spark, sf):
    _, bad = rules.split_by_contract(spark.read.parquet(f"{sf}/customer.parquet"), _customer())
    return bad.select("c_custkey", F.array_join("broken", ",").alias("broken"))


# Shares of each card network per amount segment, as a distribution table made from the data.
@query("v11_probability_sums", sql(
    f"SELECT segment, {r('sum(p)')} AS total, abs(sum(p) - 1) <= 0.001 AS ok FROM d GROUP BY 1",
    d="SELECT card_tier AS segment, card_network, count(*) / sum(count(*)) OVER (PARTITION BY card_tier) AS p FROM txn GROUP BY 1, 2"))
def v11(spark, sf):
    counts = txn(spark, sf).groupBy(F.col("card_tier").alias("segment"), "card_network").agg(F.count("*").alias("n"))
    totals = counts.groupBy("segment").agg(F.sum("n").alias("t"))
    table = counts.join(totals, "segment").select("segment", F.lit(0.0).alias("lo"), (F.col("n") / F.col("t")).alias("hi"))
    return rounded(lookups.probability_sums(table))
