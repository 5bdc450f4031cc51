"""Two-sample distribution drift between a reference and a current table.

Both tables are united with a side flag. All numeric columns share one histogram that decides most of
Kolmogorov-Smirnov and Wasserstein (see ``distances``); all categorical columns share one frequency table (chi-square,
Jensen-Shannon). Every watched column has a row, if without values then with a null score.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import tails
from .distances import distances
from .order import running_sums, with_buckets
from .projection import monitored

# Decision levels.
P_VALUE_LEVEL = 0.05
DISTANCE_LEVEL = 0.1
WARNING_RATIO = 0.2
CRITICAL_RATIO = 0.5


class DriftCritical(ValueError):
    """Raised by the gate when half or more of the columns have drifted."""


@dataclass(frozen=True)
class Thresholds:
    warning: float = WARNING_RATIO
    critical: float = CRITICAL_RATIO


def _both(reference: DataFrame, current: DataFrame, columns: list[str], cast: str) -> DataFrame:
    side = lambda df, flag: df.select(*[F.col(c).cast(cast).alias(c) for c in columns], F.lit(flag).alias("__cur"))
    return side(reference, 0).unionByName(side(current, 1))


# --- numeric columns ----------------------------------------------------------

def numeric_points(reference: DataFrame, current: DataFrame, columns: list[str], buckets: int | None = None) -> DataFrame:
    """(column, bucket, value, ref, cur): counts per distinct value of every column."""
    both = with_buckets(_both(reference, current, columns, "double"), columns, buckets)
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c + "__b").alias("bucket"), F.col(c).alias("value")) for c in columns]
    )
    return (
        both.select("__cur", F.inline(cells))
        # ``bucket`` is never null here; saying so lets both readers of the aggregate share one exchange.
        .where(F.col("value").isNotNull() & ~F.isnan("value") & F.col("bucket").isNotNull())
        .groupBy("column", "bucket", "value")
        .agg(F.sum(1 - F.col("__cur")).alias("ref"), F.sum("__cur").alias("cur"))
    )


def numeric_walk(reference: DataFrame, current: DataFrame, columns: list[str], buckets: int | None = None) -> DataFrame:
    """``numeric_points`` with running sums ``cum_ref`` and ``cum_cur`` per column."""
    return running_sums(numeric_points(reference, current, columns, buckets), "value", ["ref", "cur"], "bucket", ["column"])


def numeric_distances(reference: DataFrame, current: DataFrame, columns: list[str], buckets: int | None = None, wanted: tuple[str, ...] = ("ks", "wasserstein")) -> DataFrame:
    """(column, n_ref, n_cur, ks, wasserstein): KS is the largest gap of the two distribution
    functions; Wasserstein is the area between them over the reference standard deviation."""
    return distances(_both(reference, current, columns, "double"), columns, wanted, buckets)


def kolmogorov_smirnov(reference: DataFrame, current: DataFrame, columns: list[str], buckets: int | None = None) -> DataFrame:
    """(column, n_ref, n_cur, ks, p_value) with the asymptotic p-value."""
    out = numeric_distances(reference, current, columns, buckets, ("ks",)).drop("wasserstein")
    return out.withColumn("p_value", tails.kolmogorov_tail("ks", "n_ref", "n_cur"))


# --- categorical columns --------------------------------------------------------

def category_counts(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, ref, cur) with both totals on each row; one aggregate for all columns."""
    both = _both(reference, current, columns, "string")
    counts = (
        both.unpivot(["__cur"], columns, "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.sum(1 - F.col("__cur")).alias("ref"), F.sum("__cur").alias("cur"))
    )
    totals = counts.groupBy("column").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    return counts.join(F.broadcast(totals), "column")  # one row per column


def chi_square_fit(counts: DataFrame, with_p: bool = True) -> DataFrame:
    """(column, chi2, dof): current counts against the reference shares. A category that the
    reference lacks makes the statistic infinite."""
    expected = F.col("ref") * F.col("n_cur") / F.col("n_ref")
    term = F.when(F.col("ref") == 0, F.lit(float("inf"))).otherwise(
        F.try_divide((F.col("cur") - expected) * (F.col("cur") - expected), expected)
    )
    out = counts.groupBy("column").agg(F.sum(term).alias("chi2"), (F.count("*") - 1).cast("int").alias("dof"))
    return out.withColumn("p_value", tails.chi_square_tail("chi2", "dof")) if with_p else out


def jensen_shannon(counts: DataFrame) -> DataFrame:
    """(column, js): square root of the Jensen-Shannon divergence of the shares, natural log."""
    p, q = F.try_divide("ref", "n_ref"), F.try_divide("cur", "n_cur")
    m = (p + q) / 2
    part = lambda s: F.when(s > 0, s * F.log(s / m)).otherwise(F.lit(0.0))
    divergence = F.sum(part(p) + part(q)) / 2
    return counts.groupBy("column").agg(F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("js"))


def proportion_z(reference: DataFrame, current: DataFrame, columns: list[str], with_p: bool = True) -> DataFrame:
    """(column, n_ref, n_cur, z) for 0/1 columns, pooled variance."""
    parts = []
    for i, c in enumerate(columns):
        for side, name in ((0, "ref"), (1, "cur")):
            x = F.when(F.col("__cur") == side, F.col(c))
            parts += [F.count(x).alias(f"n_{name}_{i}"), F.sum(x).alias(f"s_{name}_{i}")]
    wide = _both(reference, current, columns, "double").agg(*parts)
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{k}_{s}_{i}").alias(f"{k}_{s}") for k in ("n", "s") for s in ("ref", "cur")])
        for i, c in enumerate(columns)
    ]
    long = wide.select(F.inline(F.array(*rows)))
    pooled = F.try_divide(F.col("s_ref") + F.col("s_cur"), F.col("n_ref") + F.col("n_cur"))
    spread = pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), "n_ref") + F.try_divide(F.lit(1.0), "n_cur"))
    gap = F.try_divide("s_ref", "n_ref") - F.try_divide("s_cur", "n_cur")
    out = long.select("column", "n_ref", "n_cur", F.try_divide(gap, F.sqrt(spread)).alias("z"))
    return out.withColumn("p_value", tails.normal_two_sided("z")) if with_p else out


def _of_all(columns: list[str], scored: DataFrame, test: str, score: str) -> DataFrame:
    """A row for every column: one without values has no frequencies and a null score."""
    every = scored.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return every.join(scored, "column", "left").select("column", F.lit(test).alias("test"), F.col(score).alias("score"))


# --- verdicts --------------------------------------------------------------------

def column_scores(
    reference: DataFrame,
    current: DataFrame,
    method: str = "pvalue",
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """(column, test, score) for every watched column that both tables have.

    ``pvalue``: KS and chi-square p-values, small means drift. ``distance``: Wasserstein and
    Jensen-Shannon, large means drift.
    """
    found = monitored(reference, current)
    numeric = found[0] if numeric is None else numeric
    categorical = found[1] if categorical is None else categorical
    parts = []
    if numeric:
        if method == "pvalue":
            scored = kolmogorov_smirnov(reference, current, numeric, buckets)
            parts.append(scored.select("column", F.lit("ks").alias("test"), F.col("p_value").alias("score")))
        else:
            scored = numeric_distances(reference, current, numeric, buckets, ("wasserstein",))
            parts.append(scored.select("column", F.lit("wasserstein").alias("test"), F.col("wasserstein").alias("score")))
    if categorical:
        counts = category_counts(reference, current, categorical)
        if method == "pvalue":
            scored = chi_square_fit(counts)
            parts.append(_of_all(categorical, scored, "chi_square", "p_value"))
        else:
            scored = jensen_shannon(counts)
            parts.append(_of_all(categorical, scored, "jensen_shannon", "js"))
    if not parts:
        return reference.sparkSession.createDataFrame([], "column string, test string, score double")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def with_verdict(scores: DataFrame, method: str = "pvalue", level: float | None = None) -> DataFrame:
    """Add ``drifted`` (direction set by the method; a missing score counts as none) and ``key_feature``."""
    if method == "pvalue":
        drifted = F.coalesce("score", F.lit(1.0)) < F.lit(P_VALUE_LEVEL if level is None else level)
    else:
        drifted = F.coalesce("score", F.lit(0.0)) >= F.lit(DISTANCE_LEVEL if level is None else level)
    return scores.withColumns({"drifted": drifted, "key_feature": F.col("column").isin(*schemas.DRIFT_KEY)})


def severity_of(ratio: Column, thresholds: Thresholds = Thresholds()) -> Column:
    return F.when(ratio >= thresholds.critical, "critical").when(ratio >= thresholds.warning, "warning").otherwise("none")


def severity(verdicts: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """One row: columns analysed, columns drifted, their ratio (0 if none) and the severity."""
    counts = verdicts.agg(F.count("*").alias("total_columns"), F.count_if("drifted").alias("drifted_columns"))
    ratio = F.coalesce(F.try_divide("drifted_columns", "total_columns"), F.lit(0.0))
    return counts.withColumn("drift_ratio", ratio).withColumn("severity", severity_of(F.col("drift_ratio"), thresholds))


def detect(reference: DataFrame, current: DataFrame, method: str = "pvalue", **options) -> DataFrame:
    """The verdict table of all watched columns."""
    return with_verdict(column_scores(reference, current, method, **options), method)
