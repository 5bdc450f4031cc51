"""Sources and sinks: write to the shared folder, read back."""

from datetime import date

from txnmill import schemas
from txnmill.operators import drift, features, order
from txnmill.plans import feature_job
from txnmill.session import new_path
from txnmill.sources import artifacts, readers, runs, writers

from .aggregates import ENCODINGS, SPLIT
from .drift import BINARY, HALVES, _z, halves, shifted
from .joins import _RUNS, run_table
from .registry import COMPONENTS, ORACLES, TXN, F, query, r, raw, rounded, sql, txn

ID = "transaction_id"
_RAW = ", ".join(f"{r(c)} AS \"{c}\"" for c in schemas.RAW_COLUMNS[:-1]) + ", Class AS \"Class\""


@query("io1_csv_scan", sql(f"SELECT {_RAW} FROM raw", "raw"))
def io1(spark, sf):
    path = writers.write_csv(raw(spark, sf).select(*schemas.RAW_COLUMNS), new_path(spark, "raw") + ".csv")
    return rounded(readers.read_csv(spark, path))


@query("io2_parquet_scan", "SELECT count(*) AS n, round(sum(value), 4) AS total FROM events")
def io2(spark, sf):
    return rounded(readers.read_parquet(spark, f"{sf}/events.parquet").agg(F.count("*").alias("n"), F.sum("value").alias("total")), 4)


@query("io3_format_dispatch", "SELECT 'csv' AS format, CAST(sum(c_custkey) AS BIGINT) AS keys, count(*) AS n FROM customer UNION ALL SELECT 'parquet' AS format, CAST(sum(c_custkey) AS BIGINT) AS keys, count(*) AS n FROM customer")
def io3(spark, sf):
    stored = readers.read_table(spark, f"{sf}/customer.parquet")
    path = writers.write_csv(stored, new_path(spark, "customer") + ".csv")
    text = readers.read_table(spark, path, stored.schema)
    total = lambda df, name: df.agg(F.sum("c_custkey").alias("keys"), F.count("*").alias("n")).select(F.lit(name).alias("format"), "keys", "n")
    return total(text, "csv").unionByName(total(stored, "parquet"))


@query("io4_object_address", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def io4(spark, sf):
    """The table by the address ``lake://<store>/events.parquet`` of a file system registered for that scheme."""
    store = f"store{abs(hash(sf)):x}"
    readers.mount(spark, "lake", store, sf if ":" in sf else f"file://{sf}")
    found = readers.read_parquet(spark, f"lake://{store}/events.parquet")
    return rounded(found.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")), 4)


@query("io5_parquet_sink", sql("SELECT transaction_id, timestamp, amount_inr, merchant_category, is_fraud FROM txn"))
def io5(spark, sf):
    base = txn(spark, sf).select(ID, "timestamp", "amount_inr", "merchant_category", "is_fraud")
    return readers.read_parquet(spark, writers.write_parquet(base, new_path(spark, "sink")))


@query("io6_dated_output", sql("SELECT transaction_id, amount_inr FROM txn"))
def io6(spark, sf):
    path = writers.dated_path(new_path(spark, "dated"), date(2024, 1, 31))
    return readers.read_parquet(spark, writers.write_parquet(txn(spark, sf).select(ID, "amount_inr"), path))


_WHOLE = "SELECT " + ", ".join(f"{r(c)} AS {c}" if c in COMPONENTS or c == "amount_inr" else c for c in TXN) + " FROM txn"


@query("io5_parquet_sink_all_columns", sql(_WHOLE))
def io5_all(spark, sf):
    return rounded(readers.read_parquet(spark, writers.write_parquet(txn(spark, sf), new_path(spark, "sink"))))


@query("io6_dated_output_all_columns", sql(_WHOLE))
def io6_all(spark, sf):
    path = writers.dated_path(new_path(spark, "dated"), date(2024, 1, 31))
    return rounded(readers.read_parquet(spark, writers.write_parquet(txn(spark, sf), path)))


_JOB_COLUMNS = [ID, "timestamp", "amount_inr", "is_international", "transaction_channel", "merchant_category", "is_fraud"]


@query("io7_split_sink", sql(
    f"SELECT split, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS fraud, {r('sum(amount_inr)', 2)} AS amount FROM f GROUP BY 1", **SPLIT))
def io7(spark, sf):
    paths = feature_job.write(txn(spark, sf).select(*_JOB_COLUMNS), new_path(spark, "features"))
    out = spark.read.parquet(paths["features"]).groupBy("split").agg(
        F.count("*").alias("n"), F.sum("is_fraud").cast("long").alias("fraud"), F.sum("amount_inr").alias("amount"))
    return rounded(out, 2)


@query("io8_state_artifacts", sql(
    f"SELECT 'encoder' AS artifact, category AS name, {r('encoding')} AS value FROM enc UNION ALL "
    f"SELECT 'threshold' AS artifact, 'high_amount' AS name, {r('quantile_cont(ln(1 + amount_inr), 0.9)')} AS value FROM tr UNION ALL "
    + " UNION ALL ".join(f"SELECT 'feature', '{c}', CAST({i} AS DOUBLE)" for i, c in enumerate(
        ["amount_inr", "is_international", "transaction_channel", "hour", "day_of_week", "is_night", "is_weekend", "log_amount", "intl_online", "night_high_amount", "merchant_category_encoded"])),
    **SPLIT, tr="SELECT * FROM f WHERE split = 'train'", enc=ENCODINGS.format(m=10, t="tr")))
def io8(spark, sf):
    paths = feature_job.write(txn(spark, sf).select(*_JOB_COLUMNS), new_path(spark, "state"))
    state, names = feature_job.load_state(spark, paths["state"])
    encoder = state.encoder.table.select(F.lit("encoder").alias("artifact"), F.col("category").alias("name"), F.col("encoding").alias("value"))
    threshold = spark.createDataFrame([("threshold", "high_amount", state.high_amount)], encoder.schema)
    listed = artifacts.feature_list(spark, names).select(F.lit("feature").alias("artifact"), "name", F.col("pos").cast("double").alias("value"))
    return rounded(encoder.unionByName(threshold).unionByName(listed))


@query("io9_drift_report_sink", sql("SELECT \"column\", z FROM (" + " UNION ALL ".join(_z(c) for c in BINARY) + ")", **HALVES))
def io9(spark, sf):
    first, rest = halves(spark, sf, BINARY)
    path = writers.write_json(drift.proportion_z(first, rest, BINARY, with_p=False), new_path(spark, "report"))
    return rounded(spark.read.schema("column string, z double").json(path))


@query("io9_drift_report", ORACLES["d6_verdicts_by_p_value"])
def io9_report(spark, sf):
    """The report of the drift job over all watched columns, read back: every verdict with its score."""
    from txnmill.plans.drift_job import drift_report

    path = new_path(spark, "report")
    drift_report(*shifted(spark, sf, [*schemas.DRIFT_NUMERIC, *schemas.DRIFT_CATEGORICAL]), path=path)
    return rounded(spark.read.schema("column string, test string, score double, drifted boolean, key_feature boolean").json(path))


@query("io9_severity_of_report", ORACLES["d9_drift_job"])
def io9_severity(spark, sf):
    """The severity worked out anew from the stored report is that of the job."""
    from txnmill.operators import perturb
    from txnmill.plans.drift_job import EXIT_LEVELS, drift_report

    path = new_path(spark, "report")
    reference, current = order.split_reference_current(txn(spark, sf))
    drift_report(reference, perturb.apply_scenario(current, "mild"), path=path)
    stored = spark.read.schema("column string, drifted boolean").json(path)
    levels = F.create_map(*[F.lit(x) for pair in EXIT_LEVELS.items() for x in pair])
    return rounded(drift.severity(stored).withColumn("exit_level", levels[F.col("severity")].cast("int")))


@query("io11_run_log", sql(f"SELECT run_id, TIMESTAMP '2024-02-01 00:00:00' AS ts, stage, metric, {r('value')} AS value FROM runs", runs=_RUNS))
def io11(spark, sf):
    path = new_path(spark, "runs")
    stamp = F.expr("timestamp_ntz'2024-02-01 00:00:00'")
    table = run_table(spark, sf)
    for network in ("Visa", "Mastercard", "RuPay", "Amex"):
        runs.log_run(table.where(F.col("run_id") == network).drop("run_id"), path, network, stamp)
    return rounded(spark.read.parquet(path))
