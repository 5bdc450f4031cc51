"""Streaming jobs over the event table as a file source; each runs to the end of its input."""

from txnmill.operators import features as feats
from txnmill.operators import order
from txnmill.session import new_path
from txnmill.streaming import scoring

from .models import _fitted, stored_model
from .registry import REQUEST, SCORED, TXN, F, dealt_events, dealt_txn, over_events, query, r, rounded, scored, sql, txn

ID = "transaction_id"


def event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return scoring.read_requests(spark, sf, "parquet", schema, pathGlobFilter="events.parquet")


def _state(spark, sf):
    _, state = feats.engineer_splits(order.with_time_split(dealt_txn(spark, sf)), per_split=False)
    return state


def _score(rows, spark, sf):
    trained = _fitted(spark, sf)
    return scoring.score_requests(rows, trained, trained.features, _state(spark, sf), keep=["row_key"])


@query("st1_scoring_stream")
def st1(spark, sf):
    path, mark = new_path(spark, "scored"), new_path(spark, "mark")
    stream = _score(over_events(event_stream(spark, sf), REQUEST), spark, sf)
    scoring.run_to_end(stream.withColumn("broken", F.array_join("broken", ",")), path, mark)
    return spark.read.parquet(path)


@query("st1_stream_equals_node_table", sql("SELECT row_key, TRUE AS agrees FROM req", "req"))
def st1_nodes(spark, sf):
    """What the stream wrote, against the node table walked in a batch; a rejected row has reasons and no score."""
    from pyspark.ml.functions import vector_to_array

    from txnmill.operators import ensemble, projection, rules

    trained, state = _fitted(spark, sf), _state(spark, sf)
    path, mark = new_path(spark, "scored"), new_path(spark, "mark")
    stream = scoring.score_requests(over_events(event_stream(spark, sf), REQUEST), trained, trained.features, state, keep=["row_key"])
    scoring.run_to_end(stream, path, mark)
    ready = projection.align_columns(feats.engineer_requests(rules.with_broken_rules(over_events(dealt_events(spark, sf), REQUEST), rules.request_contract()), state), ["row_key", "broken", *trained.features])
    walked = ensemble.probability(ensemble.margin(spark.read.parquet(f"{stored_model(spark, sf)}/nodes"), F.col("x")))
    batch = trained.prepared.transform(ready).withColumn("x", vector_to_array("features")).select("row_key", F.size("broken").alias("reasons"), walked.alias("p"))
    written = spark.read.parquet(path)
    scored_alike = (F.col("reasons") == 0) & (F.abs(F.col("fraud_probability") - F.col("p")) < 1e-4) & (F.col("is_fraud") == (F.col("p") >= 0.5))
    rejected_alike = (F.col("reasons") > 0) & (F.size("broken") == F.col("reasons")) & F.col("fraud_probability").isNull()
    return written.join(batch, "row_key").select("row_key", (scored_alike | rejected_alike).alias("agrees"))


_STATUS = "CASE WHEN prob >= 0.5 THEN 'fraud' ELSE 'legit' END"
_RISK = "CASE WHEN prob < 0.3::DOUBLE THEN 'low' WHEN prob < 0.7::DOUBLE THEN 'medium' ELSE 'high' END"


@query("st2_prediction_counters", sql(f"SELECT {_STATUS} AS status, {_RISK} AS risk_level, count(*) AS n FROM scored GROUP BY 1, 2", "scored"))
def st2(spark, sf):
    from txnmill.functions.scalars import risk_level

    path, mark = new_path(spark, "totals"), new_path(spark, "mark")
    rows = over_events(event_stream(spark, sf), SCORED)
    labelled = rows.select((F.col("prob") >= 0.5).alias("is_fraud"), risk_level("prob").alias("risk_level"))
    scoring.run_totals(scoring.prediction_counters(labelled), path, mark)
    return scoring.read_totals(spark, path)


@query("st3_latency_histogram", sql(
    " UNION ALL ".join(f"SELECT CAST('{b}' AS DOUBLE) AS bound, count(*) FILTER (WHERE prob * 2.5::DOUBLE <= CAST('{b}' AS DOUBLE)) AS n FROM scored" for b in [*scoring.LATENCY_BOUNDS, "inf"]), "scored"))
def st3(spark, sf):
    path, mark = new_path(spark, "latency"), new_path(spark, "mark")
    rows = over_events(event_stream(spark, sf), SCORED).select((F.col("prob") * 2.5).alias("latency"))
    scoring.run_totals(scoring.latency_histogram(rows), path, mark)
    return scoring.read_totals(spark, path)


@query("st4_snapshots", sql("SELECT time_bucket(INTERVAL 15 SECOND, timestamp, TIMESTAMP '2000-01-01') AS window_start, count(*) AS n FROM txn GROUP BY 1"))
def st4(spark, sf):
    path, mark = new_path(spark, "snapshots"), new_path(spark, "mark")
    rows = over_events(event_stream(spark, sf), {"timestamp": TXN["timestamp"]})
    stamped = rows.select(F.col("timestamp").cast("timestamp").alias("timestamp"))
    scoring.run_updates(scoring.snapshots(stamped), path, mark, "window_start")
    return scoring.read_updates(spark, path, "window_start").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


@query("st5_encoding_default", sql(
    f"SELECT row_key, {r('coalesce(encoding, g)')} AS merchant_category_encoded FROM req LEFT JOIN enc ON merchant_category = category, o", "req txn",
    o="SELECT avg(is_fraud) AS g FROM txn",
    enc="SELECT merchant_category AS category, (sum(is_fraud) + 10 * (SELECT g FROM o)) / (count(*) + 10) AS encoding FROM txn GROUP BY 1"))
def st5(spark, sf):
    from txnmill.operators.encoding import TargetEncoder

    encoder = TargetEncoder.fit(txn(spark, sf).select("merchant_category", "is_fraud"), "merchant_category")
    path, mark = new_path(spark, "encoded"), new_path(spark, "mark")
    rows = over_events(event_stream(spark, sf), {c: REQUEST[c] for c in ("row_key", "merchant_category")})
    scoring.run_to_end(encoder.transform(rows).select("row_key", "merchant_category_encoded"), path, mark)
    return rounded(spark.read.parquet(path))
