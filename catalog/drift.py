"""Distribution drift between the older and the newer half, and against perturbed data."""

from txnmill import schemas
from txnmill.operators import drift, order, perturb

from .draws import MILD, SEVERE
from .order import CUM, HALVES, walk_sql
from .registry import F, query, r, rounded, sql, txn

ID = "transaction_id"
NUMERIC, CATEGORICAL = schemas.DRIFT_NUMERIC, schemas.DRIFT_CATEGORICAL
BINARY = ["is_international", "is_recurring"]

# The newer half with the severe scenario applied, against the older half.
SHIFTED = dict(
    HALVES,
    s=SEVERE,
    hs="SELECT s.*, h.side FROM s JOIN h USING (transaction_id) WHERE h.side = 'current' UNION ALL SELECT * FROM h WHERE side = 'reference'",
)


def halves(spark, sf, columns):
    return order.split_reference_current(txn(spark, sf).select(ID, "timestamp", *columns))


def shifted(spark, sf, columns):
    reference, current = halves(spark, sf, columns)
    return reference, perturb.apply_scenario(current, "severe")


KS = f"SELECT \"column\", CAST(max(n_ref) AS BIGINT) AS n_ref, CAST(max(n_cur) AS BIGINT) AS n_cur, {r('max(abs(cum_ref / n_ref - cum_cur / n_cur))')} AS ks FROM c GROUP BY 1"


@query("d1_kolmogorov_smirnov", sql(KS, **HALVES, p=walk_sql(NUMERIC), c=CUM))
def d1(spark, sf):
    first, rest = halves(spark, sf, NUMERIC)
    return rounded(drift.kolmogorov_smirnov(first, rest, NUMERIC).select("column", "n_ref", "n_cur", "ks"))


@query("d1_kolmogorov_smirnov_severe", sql(KS, **SHIFTED, p=walk_sql(NUMERIC, "hs"), c=CUM))
def d1_severe(spark, sf):
    first, rest = shifted(spark, sf, [*NUMERIC, "is_international"])
    return rounded(drift.kolmogorov_smirnov(first, rest, NUMERIC).select("column", "n_ref", "n_cur", "ks"))


def counts_sql(columns, cte="h"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS STRING) AS value, (count(*) FILTER (WHERE side = 'reference'))::DOUBLE AS ref, (count(*) FILTER (WHERE side = 'current'))::DOUBLE AS cur FROM {cte} WHERE {c} IS NOT NULL GROUP BY 2"
        for c in columns
    )


TOTALS = "SELECT *, sum(ref) OVER (PARTITION BY \"column\") AS n_ref, sum(cur) OVER (PARTITION BY \"column\") AS n_cur FROM p"
CHI = f"SELECT \"column\", {r('sum(power(cur - ref * n_cur / n_ref, 2) / (ref * n_cur / n_ref))')} AS chi2, CAST(count(*) - 1 AS INT) AS dof FROM c GROUP BY 1"


# The Kolmogorov series; the chi-square tail as one less the series of its complement.
KS_TAIL = (
    "CASE WHEN ks * ks * n_ref * n_cur / (n_ref + n_cur) < 0.04::DOUBLE THEN 1.0::DOUBLE ELSE least(greatest(2 * (SELECT sum("
    "CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0::DOUBLE * j * j * ks * ks * n_ref * n_cur / (n_ref + n_cur))) FROM range(1, 101) t(j)), 0), 1) END"
)
CHI_TAIL = (
    "CASE WHEN dof < 1 THEN NULL WHEN chi2 <= 0 THEN 1.0::DOUBLE WHEN isinf(chi2) OR chi2 > 1500 + 10 * dof THEN 0.0::DOUBLE ELSE greatest(0, 1 - (SELECT sum(exp("
    "-chi2 / 2 + (dof / 2.0::DOUBLE + i) * ln(chi2 / 2) - lgamma(dof / 2.0::DOUBLE + i + 1))) FROM range(0, 4000) t(i))) END"
)


@query("d1_p_values", sql(f"SELECT \"column\", {r(KS_TAIL)} AS p_value FROM k", **HALVES, p=walk_sql(NUMERIC), c=CUM,
    k="SELECT \"column\", max(n_ref)::DOUBLE AS n_ref, max(n_cur)::DOUBLE AS n_cur, max(abs(cum_ref / n_ref - cum_cur / n_cur)) AS ks FROM c GROUP BY 1"))
def d1_p(spark, sf):
    first, rest = halves(spark, sf, NUMERIC)
    return rounded(drift.kolmogorov_smirnov(first, rest, NUMERIC).select("column", "p_value"))


@query("d2_chi_square_fit", sql(CHI, **HALVES, p=counts_sql(CATEGORICAL), c=TOTALS))
def d2(spark, sf):
    first, rest = halves(spark, sf, CATEGORICAL)
    return rounded(drift.chi_square_fit(drift.category_counts(first, rest, CATEGORICAL), with_p=False))


EVEN = ["merchant_category", "merchant_city"]  # earlier queries
_CHI_RAW = "SELECT \"column\", sum(power(cur - ref * n_cur / n_ref, 2) / (ref * n_cur / n_ref)) AS chi2, count(*) - 1 AS dof FROM {c} GROUP BY 1"


@query("d2_p_values", sql(f"SELECT \"column\", {r(CHI_TAIL)} AS p_value FROM x", **HALVES, p=counts_sql(CATEGORICAL), c=TOTALS, x=_CHI_RAW.format(c="c")))
def d2_p(spark, sf):
    first, rest = halves(spark, sf, CATEGORICAL)
    return rounded(drift.chi_square_fit(drift.category_counts(first, rest, CATEGORICAL)).select("column", "p_value"))


def _z(c):
    return (f"SELECT '{c}' AS \"column\", CAST(n1 AS DOUBLE) AS n_ref, CAST(n2 AS DOUBLE) AS n_cur, {r('(s1 / n1 - s2 / n2) / sqrt((s1 + s2) / (n1 + n2) * (1 - (s1 + s2) / (n1 + n2)) * (1 / n1 + 1 / n2))')} AS z FROM "
            f"(SELECT (count(*) FILTER (WHERE side = 'reference'))::DOUBLE AS n1, (count(*) FILTER (WHERE side = 'current'))::DOUBLE AS n2, "
            f"(sum({c}) FILTER (WHERE side = 'reference'))::DOUBLE AS s1, (sum({c}) FILTER (WHERE side = 'current'))::DOUBLE AS s2 FROM h)")


@query("d3_proportion_z", sql(" UNION ALL ".join(_z(c) for c in BINARY), **HALVES))
def d3(spark, sf):
    first, rest = halves(spark, sf, BINARY)
    out = drift.proportion_z(first, rest, BINARY, with_p=False)
    return rounded(out.withColumns({"n_ref": F.col("n_ref").cast("double"), "n_cur": F.col("n_cur").cast("double")}))


def _std(columns, cte="h"):
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", stddev_pop({c}) AS std FROM {cte} WHERE side = 'reference'" for c in columns)


@query("d4_wasserstein", sql(
    f"SELECT c.\"column\", {r('sum(abs(cum_ref / n_ref - cum_cur / n_cur) * coalesce(nxt - value, 0)) / max(std)')} AS wasserstein FROM c JOIN sd USING (\"column\") GROUP BY 1",
    **HALVES, p=walk_sql(NUMERIC), c=CUM, sd=_std(NUMERIC)))
def d4(spark, sf):
    first, rest = halves(spark, sf, NUMERIC)
    return rounded(drift.numeric_distances(first, rest, NUMERIC).select("column", "wasserstein"))


JS = (
    "SELECT \"column\", sqrt(greatest(sum(CASE WHEN ref > 0 THEN ref / n_ref * ln(ref / n_ref / ((ref / n_ref + cur / n_cur) / 2)) ELSE 0 END "
    "+ CASE WHEN cur > 0 THEN cur / n_cur * ln(cur / n_cur / ((ref / n_ref + cur / n_cur) / 2)) ELSE 0 END) / 2, 0)) AS js FROM c GROUP BY 1"
)


@query("d5_jensen_shannon", sql(f"SELECT \"column\", {r('js')} AS js FROM j", **HALVES, p=counts_sql(CATEGORICAL), c=TOTALS, j=JS))
def d5(spark, sf):
    first, rest = halves(spark, sf, CATEGORICAL)
    return rounded(drift.jensen_shannon(drift.category_counts(first, rest, CATEGORICAL)))


# Distance verdicts on the severe scenario: numeric by Wasserstein, categorical by Jensen-Shannon.
_N, _C = NUMERIC, CATEGORICAL
_KEYS = ", ".join(f"'{c}'" for c in ("amount_inr", "merchant_category", "transaction_channel", "is_international"))
DISTANCES = dict(
    SHIFTED, p=walk_sql(_N, "hs"), c=CUM, sd=_std(_N, "hs"),
    w="SELECT c.\"column\", sum(abs(cum_ref / n_ref - cum_cur / n_cur) * coalesce(nxt - value, 0)) / max(std) AS score FROM c JOIN sd USING (\"column\") GROUP BY 1",
    p2=counts_sql(_C, "hs"), c2=TOTALS.replace("FROM p", "FROM p2"), j=JS.replace("FROM c GROUP", "FROM c2 GROUP"),
    v="SELECT \"column\", 'wasserstein' AS test, score, score >= 0.1 AS drifted FROM w UNION ALL SELECT \"column\", 'jensen_shannon', js, js >= 0.1 FROM j",
)


def _distance_scores(spark, sf):
    first, rest = shifted(spark, sf, [*_N, *_C])
    return drift.detect(first, rest, "distance", numeric=_N, categorical=_C)


@query("d6_verdicts_by_distance", sql(f"SELECT \"column\", test, {r('score')} AS score, drifted, \"column\" IN ({_KEYS}) AS key_feature FROM v", **DISTANCES))
def d6(spark, sf):
    return rounded(_distance_scores(spark, sf))


@query("d7_severity", sql(
    f"SELECT count(*) AS total_columns, count(*) FILTER (WHERE drifted) AS drifted_columns, {r('count(*) FILTER (WHERE drifted) / count(*)')} AS drift_ratio, "
    "CASE WHEN count(*) FILTER (WHERE drifted) / count(*) >= 0.5 THEN 'critical' WHEN count(*) FILTER (WHERE drifted) / count(*) >= 0.2 THEN 'warning' ELSE 'none' END AS severity FROM v", **DISTANCES))
def d7(spark, sf):
    return rounded(drift.severity(_distance_scores(spark, sf)))


def p_value_sql(numeric, categorical, cte="h"):
    """The verdicts by p-value."""
    return dict(
        p=walk_sql(numeric, cte), c=CUM,
        k="SELECT \"column\", max(n_ref)::DOUBLE AS n_ref, max(n_cur)::DOUBLE AS n_cur, max(abs(cum_ref / n_ref - cum_cur / n_cur)) AS ks FROM c GROUP BY 1",
        p2=counts_sql(categorical, cte), c2=TOTALS.replace("FROM p", "FROM p2"), x=_CHI_RAW.format(c="c2"),
        v=f"SELECT \"column\", 'ks' AS test, {KS_TAIL} AS score FROM k UNION ALL SELECT \"column\", 'chi_square' AS test, {CHI_TAIL} AS score FROM x",
    )


_SEVERITY = (
    f"SELECT count(*) AS total_columns, count(*) FILTER (WHERE score < 0.05) AS drifted_columns, {r('count(*) FILTER (WHERE score < 0.05) / count(*)')} AS drift_ratio, "
    "CASE WHEN count(*) FILTER (WHERE score < 0.05) / count(*) >= 0.5 THEN 'critical' WHEN count(*) FILTER (WHERE score < 0.05) / count(*) >= 0.2 THEN 'warning' ELSE 'none' END AS severity"
)


@query("d6_verdicts_by_p_value", sql(
    f"SELECT \"column\", test, {r('score')} AS score, score < 0.05 AS drifted, \"column\" IN ({_KEYS}) AS key_feature FROM v",
    **SHIFTED, **p_value_sql(_N, _C, "hs")))
def d6_p(spark, sf):
    first, rest = shifted(spark, sf, [*_N, *_C])
    return rounded(drift.detect(first, rest, "pvalue", numeric=_N, categorical=_C))


@query("d8_gate", sql(_SEVERITY + " FROM v", **HALVES, **p_value_sql(NUMERIC, CATEGORICAL)))
def d8(spark, sf):
    from txnmill.plans.gates import drift_gate

    return rounded(drift.severity(drift_gate(txn(spark, sf), id_column=ID)))


_EXIT = ", CAST(CASE WHEN count(*) FILTER (WHERE score < 0.05) / count(*) >= 0.5 THEN 2 WHEN count(*) FILTER (WHERE score < 0.05) / count(*) >= 0.2 THEN 1 ELSE 0 END AS INT) AS exit_level"
MILDLY = dict(
    HALVES,
    s=MILD,
    hs="SELECT s.*, h.side FROM s JOIN h USING (transaction_id) WHERE h.side = 'current' UNION ALL SELECT * FROM h WHERE side = 'reference'",
)


@query("d9_drift_job", sql(_SEVERITY + _EXIT + " FROM v", **MILDLY, **p_value_sql(NUMERIC, CATEGORICAL, "hs")))
def d9(spark, sf):
    from txnmill.plans.drift_job import drift_report

    reference, current = order.split_reference_current(txn(spark, sf))
    return rounded(drift_report(reference, perturb.apply_scenario(current, "mild")))


@query("d6_verdicts_numeric_and_odd", sql(
    f"SELECT \"column\", test, {r('score')} AS score, score < 0.05 AS drifted, \"column\" IN ({_KEYS}) AS key_feature FROM v",
    **SHIFTED, **p_value_sql(_N, ["merchant_category"], "hs")))
def d6_odd(spark, sf):
    first, rest = shifted(spark, sf, [*_N, "merchant_category", "merchant_city", "is_international"])
    return rounded(drift.detect(first, rest, "pvalue", numeric=_N, categorical=["merchant_category"]))


@query("d8_gate_numeric_and_odd", sql(_SEVERITY + " FROM v", **HALVES, **p_value_sql(NUMERIC, EVEN)))
def d8_odd(spark, sf):
    from txnmill.plans.gates import drift_gate

    base = txn(spark, sf).select(ID, "timestamp", *NUMERIC, *EVEN)
    return rounded(drift.severity(drift_gate(base, id_column=ID)))


@query("d9_drift_job_numeric_and_odd", sql(
    _SEVERITY + ", CAST(CASE WHEN count(*) FILTER (WHERE score < 0.05) / count(*) >= 0.5 THEN 2 WHEN count(*) FILTER (WHERE score < 0.05) / count(*) >= 0.2 THEN 1 ELSE 0 END AS INT) AS exit_level FROM v",
    **SHIFTED, **p_value_sql(["amount_inr", "V1", "V4", "V7", "card_age"], ["merchant_category"], "hs")))
def d9_odd(spark, sf):
    from txnmill.plans.drift_job import drift_report

    reference, current = shifted(spark, sf, ["amount_inr", "V1", "V4", "V7", "card_age", "merchant_category"])
    return rounded(drift_report(reference, current))


@query("d10_key_features", sql("SELECT \"column\", \"column\" IN (" + _KEYS + ") AS key_feature FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\"" for c in [*_N, *_C]) + ")"))
def d10(spark, sf):
    return _distance_scores(spark, sf).select("column", "key_feature")
