"""Query registry, and the transaction tables that the queries run on.

The given tables hold no card transactions. The tables below are projections of ``events`` (one
transaction per event). Their column expressions are SQL text that Spark and DuckDB both run, so
one definition serves the query and its oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmill.functions.scalars import half_even
from txnmill.session import dealt

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its oracle if it has one."""

    def register(f):
        if name in QUERIES:
            raise KeyError(name)
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded (half to even) and -0.0 turned to 0.0, as the oracles do it."""
    return df.select(
        *[
            (half_even(f.name, places) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


def r(expression: str, places: int = 6) -> str:
    return f"(round_even(CAST({expression} AS DOUBLE), {places}) + CAST(0 AS DOUBLE))"


def _component(i: int) -> str:
    base = f"CAST((event_id * {2 * i + 1} + user_id * {i + 3} + {{k}}) % 997 AS DOUBLE) / CAST(997 AS DOUBLE)"
    if i % 7 == 0:
        return f"{base} + CAST({{k}} AS DOUBLE) / CAST({10 * i} AS DOUBLE)"
    if i in (8, 15):
        return f"CAST({{k}} AS DOUBLE) / CAST({20 * i} AS DOUBLE) + CAST((event_id * {i}) % 13 AS DOUBLE) / CAST(1000 AS DOUBLE)"
    return base


COMPONENTS = {f"V{i}": _component(i) for i in range(1, 29)}
IS_FRAUD = "CASE WHEN {k} >= 95 THEN 1 ELSE 0 END"

TXN = {
    "transaction_id": "event_id",
    "user_id": "user_id",
    "merchant_id": "concat('merchant_', lpad(CAST(user_id % 40 AS STRING), 5, '0'))",
    "timestamp": "ts",
    "card_network": "CASE WHEN event_id % 10 < 4 THEN 'Visa' WHEN event_id % 10 < 8 THEN 'Mastercard' WHEN event_id % 10 = 8 THEN 'RuPay' ELSE 'Amex' END",
    "card_issuer": "CASE WHEN event_id % 10 = 9 THEN 'American Express' WHEN user_id % 3 = 0 THEN 'HDFC Bank' WHEN user_id % 3 = 1 THEN 'SBI Card' ELSE 'Axis Bank' END",
    "card_tier": "CASE user_id % 4 WHEN 0 THEN 'Classic' WHEN 1 THEN 'Gold' WHEN 2 THEN 'Platinum' ELSE 'Signature' END",
    "credit_limit": "CAST(25000 + 1000 * (user_id % 75) AS INT)",
    "card_age": "CAST({k} % 60 + 1 AS INT)",
    "amount_inr": "value",
    "merchant_category": "event_type",
    "merchant_city": "CASE user_id % 7 WHEN 0 THEN 'Mumbai' WHEN 1 THEN 'Delhi' WHEN 2 THEN 'Pune' WHEN 3 THEN 'Jaipur' WHEN 4 THEN 'Kochi' WHEN 5 THEN 'Agra' ELSE 'Elsewhere' END",
    "merchant_state": "CASE user_id % 7 WHEN 0 THEN 'Maharashtra' WHEN 1 THEN 'Delhi' WHEN 2 THEN 'Maharashtra' WHEN 3 THEN 'Rajasthan' WHEN 4 THEN 'Kerala' WHEN 5 THEN 'Uttar Pradesh' END",
    "transaction_channel": "CASE WHEN event_type IN ('click', 'purchase') THEN 'Online' ELSE 'POS' END",
    "entry_mode": "CASE WHEN event_type IN ('click', 'purchase') THEN 'CVC' WHEN event_id % 3 = 0 THEN 'Chip' WHEN event_id % 3 = 1 THEN 'Tap' ELSE 'Swipe' END",
    "is_international": "CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END",
    "is_recurring": "CASE WHEN {k} % 3 = 0 THEN 1 ELSE 0 END",
    **COMPONENTS,
    "is_fraud": IS_FRAUD,
}

# A raw feed: elapsed seconds over two days, some amounts of zero. ``row_key`` is unique.
RAW = {
    "row_key": "event_id",
    "Time": "CAST((event_id * 13) % 172792 AS DOUBLE) + CAST({k} AS DOUBLE) / CAST(100 AS DOUBLE)",
    **COMPONENTS,
    "Amount": "CASE WHEN event_id % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE value END",
    "Class": IS_FRAUD,
}

# Scoring requests, some of which break the contract in one or several fields.
REQUEST = {
    "row_key": "event_id",
    "amount": "value - CAST(1.5 AS DOUBLE)",
    "time": "CAST((event_id * 13) % 700000 AS DOUBLE) - CASE WHEN event_id % 83 = 0 THEN CAST(700000 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "card_tier": "CASE WHEN event_id % 97 = 0 THEN 'Basic' WHEN user_id % 4 = 0 THEN 'Classic' WHEN user_id % 4 = 1 THEN 'Gold' WHEN user_id % 4 = 2 THEN 'Platinum' ELSE 'Signature' END",
    "credit_limit": "CAST(1000 * (user_id % 75) AS DOUBLE)",
    "card_age": "CAST({k} % 60 AS INT) - CASE WHEN event_id % 41 = 0 THEN 60 ELSE 0 END",
    "transaction_channel": "CASE WHEN event_id % 53 = 0 THEN 'ATM' WHEN event_type IN ('click', 'purchase') THEN 'Online' ELSE 'POS' END",
    "is_international": "CASE WHEN event_id % 61 = 0 THEN 2 WHEN user_id % 5 = 0 THEN 1 ELSE 0 END",
    "is_recurring": "CASE WHEN {k} % 3 = 0 THEN 1 ELSE 0 END",
    "merchant_category": "CASE WHEN event_type = 'error' THEN CAST(NULL AS STRING) ELSE event_type END",
    **COMPONENTS,
    "V1": "CASE WHEN event_id % 71 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(event_id % 17 AS DOUBLE) END",
}

# A scored table with ties in the score.
SCORED = {
    "row_key": "event_id",
    "label": IS_FRAUD,
    "prob": "CAST(({k} * 37 + event_id % 13 + CASE WHEN {k} >= 95 THEN 20 ELSE 0 END) % 101 AS DOUBLE) / CAST(101 AS DOUBLE)",
}

_SPARK_K = "CAST(get_json_object(props, '$.k') AS INT)"
_DUCK_K = "CAST(json_extract_string(props, '$.k') AS INT)"


def over_events(events: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``k`` is parsed once per row, in its own projection, whatever number of columns use it."""
    parsed = events.selectExpr("*", f"{_SPARK_K} AS k")
    return parsed.selectExpr(*[f"{e.format(k='k')} AS `{c}`" for c, e in columns.items()])


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def dealt_events(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows in even parts, for queries that compute much from each row."""
    rows = events(spark, sf)
    return dealt(rows, rows.count(), "events")


def txn(spark: SparkSession, sf: str) -> DataFrame:
    return over_events(events(spark, sf), TXN)


def dealt_txn(spark: SparkSession, sf: str) -> DataFrame:
    return over_events(dealt_events(spark, sf), TXN)


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return over_events(events(spark, sf), RAW)


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return over_events(events(spark, sf), REQUEST)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return over_events(events(spark, sf), SCORED)


# Line items as transactions: more rows, many equal timestamps, a text id made of the whole row.
SALES = {
    "transaction_id": "concat_ws('|', CAST(l_orderkey AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), CAST(l_linenumber AS STRING), CAST(CAST(l_quantity AS INT) AS STRING), l_returnflag, l_linestatus)",
    "user_id": "l_suppkey",
    "partkey": "l_partkey",
    "timestamp": "l_shipdate",
    "amount_inr": "l_extendedprice",
    "discount": "l_discount",
    "is_fraud": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
}


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(*[f"{e} AS `{c}`" for c, e in SALES.items()])


def sales_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """Sales with the part type as merchant category."""
    part = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", F.col("p_type").alias("merchant_category"))
    return sales(spark, sf).join(part, F.col("partkey") == F.col("p_partkey")).drop("p_partkey")


def _select(columns: dict[str, str], table: str) -> str:
    return "SELECT " + ", ".join(f'{e.format(k='k')} AS "{c}"' for c, e in columns.items()) + f" FROM {table}"


_EVENTS = f"(SELECT *, {_DUCK_K} AS k FROM events)"
TABLES = {
    "txn": _select(TXN, _EVENTS),
    "raw": _select(RAW, _EVENTS),
    "req": _select(REQUEST, _EVENTS),
    "scored": _select(SCORED, _EVENTS),
    "sales": _select(SALES, "lineitem"),
    "sales_by_type": "SELECT s.*, p.p_type AS merchant_category FROM sales s JOIN part p ON s.partkey = p.p_partkey",
}


def sql(body: str, tables: str = "txn", **ctes: str) -> str:
    """An oracle: the named tables and further CTEs, then the body."""
    named = {name: TABLES[name] for name in tables.split()}
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in {**named, **ctes}.items()) + " " + body


def duck_uniform(key: str, salt: str) -> str:
    """The draw of (key, salt) in DuckDB."""
    digits = f"substr(md5(concat(CAST({key} AS STRING), '{salt}')), 1, 13)"
    return f"(CAST(CAST(('0x' || {digits}) AS BIGINT) AS DOUBLE) / CAST(4503599627370496 AS DOUBLE))"


def duck_weighted(u: str, weights: dict) -> str:
    """CASE over cumulative weights, last value as the rest."""
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    items, total, parts = [(v, w) for v, w in weights.items() if w > 0], 0.0, []
    for value, weight in items[:-1]:
        total += weight
        parts.append(f"WHEN {u} < CAST('{total!r}' AS DOUBLE) THEN {quote(value)}")
    last = quote(items[-1][0])
    return f"(CASE {' '.join(parts)} ELSE {last} END)" if parts else last
