"""Correlation, contingency and mean-difference tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars, tails
from .profile import pairs_of

TARGET = "is_fraud"


def target_correlations(df: DataFrame, columns: list[str], target: str = TARGET, floor: float = 0.01) -> DataFrame:
    """Absolute Pearson correlation with the target per column, from one aggregate."""
    wide = df.agg(*[F.abs(F.corr(F.col(c).cast("double"), F.col(target).cast("double"))).alias(c) for c in columns])
    long = wide.unpivot([], columns, "column", "correlation")
    return long.where(F.col("correlation") >= floor).withColumn("strength", scalars.strength("correlation"))


def top_correlations(df: DataFrame, columns: list[str], n: int = 10, target: str = TARGET) -> DataFrame:
    return target_correlations(df, columns, target).orderBy(F.desc("correlation"), "column").limit(n)


def pair_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, correlation) for all pairs of the given columns, from one aggregate."""
    pairs = pairs_of(columns)
    wide = df.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]
    )
    rows = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*rows)))


def collinear_pairs(df: DataFrame, columns: list[str], top: int = 5, above: float = 0.8, target: str = TARGET) -> DataFrame:
    """Strongly correlated pairs among the columns that correlate most with the target."""
    leaders = [r["column"] for r in top_correlations(df, columns, top, target).collect()]
    return pair_correlations(df, leaders).where(F.abs("correlation") > above)


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n) counts in long form, nulls left out."""
    return (
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
        .agg(F.count("*").alias("n"))
    )


def chi_square(df: DataFrame, a: str, b: str, with_p: bool = True) -> DataFrame:
    """Independence test on the cross table; a 2 x 2 table gets the continuity correction.

    One scan: the cells carry their row and column totals by window sums over the small cell table. The statistic is
    N * (sum n^2 / (row * col) - 1), in which empty cells need no row. In a 2 x 2 table all four gaps |n - expected| are
    equal, so one cell gives the corrected form.
    """
    total_of = lambda side: F.sum("n").over(Window.partitionBy(side)).cast("double")
    cells = contingency(df, a, b).select("a", "b", "n", total_of("a").alias("row_n"), total_of("b").alias("col_n"))
    sums = cells.agg(
        F.sum("n").cast("double").alias("total"),
        F.sum(F.col("n") * F.col("n") / (F.col("row_n") * F.col("col_n"))).alias("ratio"),
        F.countDistinct("a").alias("r"),
        F.countDistinct("b").alias("c"),
        F.max(F.struct("n", "row_n", "col_n")).alias("cell"),
    )
    total, row, col = F.col("total"), F.col("cell.row_n"), F.col("cell.col_n")
    gap = F.abs(F.col("cell.n") - row * col / total)
    corrected = gap - F.least(F.lit(0.5), gap)
    inverse = lambda side: F.try_divide(F.lit(1.0), side) + F.try_divide(F.lit(1.0), total - side)
    two_by_two = corrected * corrected * total * inverse(row) * inverse(col)
    plain = F.greatest(total * (F.col("ratio") - 1), F.lit(0.0))
    out = sums.select(
        F.when((F.col("r") == 2) & (F.col("c") == 2), two_by_two).otherwise(plain).alias("chi2"),
        ((F.col("r") - 1) * (F.col("c") - 1)).cast("int").alias("dof"),
    )
    if with_p:
        out = out.withColumn("p_value", tails.chi_square_tail("chi2", "dof")).withColumn(
            "verdict", scalars.significance("p_value")
        )
    return out


def welch_test(df: DataFrame, columns: list[str], target: str = TARGET, with_p: bool = True) -> DataFrame:
    """Unequal-variance t-test of class 0 against class 1, one row per column, from one aggregate."""
    parts = []
    for i, c in enumerate(columns):
        for y in (0, 1):
            x = F.when(F.col(target) == y, F.col(c).cast("double"))
            parts += [
                F.count(x).alias(f"n{y}_{i}"), F.avg(x).alias(f"m{y}_{i}"), F.var_samp(x).alias(f"v{y}_{i}"),
            ]
    wide = df.agg(*parts)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{k}{y}_{i}").alias(f"{k}{y}") for y in (0, 1) for k in ("n", "m", "v")],
        )
        for i, c in enumerate(columns)
    ]
    long = wide.select(F.inline(F.array(*rows)))
    e0, e1 = F.try_divide("v0", "n0"), F.try_divide("v1", "n1")
    bottom = F.try_divide(e0 * e0, F.col("n0") - 1) + F.try_divide(e1 * e1, F.col("n1") - 1)
    out = long.select(
        "column",
        F.col("m0").alias("mean_legit"),
        F.col("m1").alias("mean_fraud"),
        F.try_divide(F.col("m0") - F.col("m1"), F.sqrt(e0 + e1)).alias("t"),
        F.try_divide((e0 + e1) * (e0 + e1), bottom).alias("dof"),
    )
    if with_p:
        out = out.withColumn("p_value", tails.student_two_sided("t", "dof")).withColumn(
            "verdict", scalars.significance("p_value")
        )
    return out
