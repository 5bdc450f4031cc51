"""Profiling aggregates: rates, frequencies, summaries, sanity counters.

Each function makes one pass with partial aggregation before the shuffle. Totals that every row of
a small result needs come from scalar subqueries or from windows over the aggregate, not the data.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars
from .order import exact_quantiles

TARGET = "is_fraud"


# --- rates -------------------------------------------------------------------

def _groups(df: DataFrame, dims: list, target: str) -> DataFrame:
    return df.groupBy(*dims).agg(F.count(target).alias("total"), F.sum(target).cast("long").alias("fraud_count"))


def _rates(groups: DataFrame, min_rows: int) -> DataFrame:
    return groups.withColumn("fraud_rate", F.try_divide("fraud_count", "total") * 100).where(F.col("total") >= min_rows)


def overall_rate(groups: DataFrame) -> Column:
    """The overall rate in percent, as a scalar over the groups of all rows: their one scan serves both."""
    return groups.agg((F.try_divide(F.sum("fraud_count"), F.sum("total")) * 100).alias("baseline")).scalar()


def rate_by(df: DataFrame, *dims: str, target: str = TARGET, min_rows: int = 0) -> DataFrame:
    """Rows, positives and rate in percent per group, groups below the support dropped."""
    return _rates(_groups(df, list(dims), target), min_rows)


def rate_multiples(df: DataFrame, dim: str, target: str = TARGET) -> DataFrame:
    """Rates per group with their multiple of the overall rate."""
    groups = _groups(df, [dim], target)
    return _rates(groups, 0).withColumn("multiple", F.try_divide("fraud_rate", overall_rate(groups)))


def top_rates(df: DataFrame, dim: str, n: int = 5, min_rows: int = 101, target: str = TARGET) -> DataFrame:
    """The n groups with the highest rate and their multiple of the overall rate."""
    groups = _groups(df, [dim], target)
    return (
        _rates(groups, min_rows).withColumn("multiple", F.try_divide("fraud_rate", overall_rate(groups)))
        .orderBy(F.desc("fraud_rate"), dim)
        .limit(n)
    )


def hotspots(
    df: DataFrame, pairs: list[tuple[str, str]], n: int = 3, min_rows: int = 50, target: str = TARGET
) -> DataFrame:
    """Top rates per pair of dimensions: all pairs in one aggregate by GROUPING SETS."""
    dims = list(dict.fromkeys(c for pair in pairs for c in pair))
    keyed = df.select(*[F.col(c).cast("string").alias(c) for c in dims], F.col(target).alias("__y"))
    grouped = keyed.groupingSets([[F.col(a), F.col(b)] for a, b in pairs], *[F.col(c) for c in dims]).agg(
        F.count("__y").alias("total"),
        F.sum("__y").cast("long").alias("fraud_count"),
        *[F.grouping(c).alias(f"__g_{c}") for c in dims],
    )
    name, first, second = F.lit(None), F.lit(None), F.lit(None)
    for a, b in pairs:
        here = (F.col(f"__g_{a}") == 0) & (F.col(f"__g_{b}") == 0)
        name = F.when(here, f"{a}+{b}").otherwise(name)
        first = F.when(here, F.col(a)).otherwise(first)
        second = F.when(here, F.col(b)).otherwise(second)
    # The groups of the first pair hold every row once; the window sees groups, not rows.
    whole = F.greatest(*[F.col(f"__g_{c}") for c in pairs[0]]) == 0
    sums = [F.sum(F.when(whole, F.col(c))).over(Window.partitionBy()) for c in ("fraud_count", "total")]
    rates = (
        _rates(grouped.withColumn("baseline", F.try_divide(*sums) * 100), min_rows)
        .select("baseline", name.alias("pair"), first.alias("first"), second.alias("second"), "total", "fraud_count", "fraud_rate")
        .where(F.col("first").isNotNull() & F.col("second").isNotNull())
    )
    order = Window.partitionBy("pair").orderBy(F.desc("fraud_rate"), "first", "second")
    return (
        rates.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= n)
        .withColumn("multiple", F.try_divide("fraud_rate", "baseline"))
        .drop("baseline")
    )


def mean_of_group_rates(
    df: DataFrame, dim: str, low, high, factor: float = 2.0, min_rows: int = 101, target: str = TARGET
) -> DataFrame:
    """Unweighted mean of the group rates for low <= dim <= high against factor x the overall rate."""
    counted = F.col(dim).between(low, high) & (F.col("total") >= min_rows)
    rate = F.when(counted, F.try_divide("fraud_count", "total") * 100)
    return _groups(df, [dim], target).agg(
        F.avg(rate).alias("mean_rate"),
        (F.try_divide(F.sum("fraud_count"), F.sum("total")) * 100).alias("baseline"),
    ).withColumn("spike", F.coalesce(F.col("mean_rate") > F.lit(factor) * F.col("baseline"), F.lit(False)))


# --- frequencies -------------------------------------------------------------

def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, nulls left out, largest first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def share(df: DataFrame, column: str) -> DataFrame:
    """Frequency as a share of the non-null rows; the total is a scalar over the counts."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), "value")


#: Columns of a cross table, at most.
WIDEST = 1_000


def cross_table(df: DataFrame, rows: str, columns: str, values: list | None = None) -> DataFrame:
    """Counts with one column per value, 0 where a cell is empty.

    ``values`` are the distinct values of ``columns`` by default; a given list must hold them all, since a row
    outside it would be lost.
    """
    held = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    found = held.select(columns).distinct().limit(WIDEST + 1).collect()
    if len(found) > WIDEST:
        raise ValueError(f"{columns} has more than {WIDEST} values; count the pairs instead")
    present = {r[0] for r in found}
    if values is None:
        values = sorted(present)
    elif unlisted := present - set(values):
        raise ValueError(f"values of {columns} that are not listed: {sorted(map(str, unlisted))}")
    cells = [F.count_if(F.col(columns) == F.lit(v)).alias(f"c_{v}") for v in values]
    return held.groupBy(rows).agg(*cells)


def distinct_count(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.countDistinct(c).alias(c) for c in columns])


def distinct_count_approx(df: DataFrame, *columns: str, rsd: float = 0.02) -> DataFrame:
    return df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])


#: Bits of a sketch's registers, and four standard errors of what it estimates.
SKETCH_BITS = 12
SKETCH_ERROR = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)


def distinct_sketches(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(``by``, one sketch per column): a small table to store, from which the distinct values of any set of its rows
    are estimated without the data. A sketch has a fixed size, whatever it has seen."""
    return df.groupBy(by).agg(*[F.hll_sketch_agg(c, SKETCH_BITS).alias(c) for c in columns])


def merged_distinct(sketches: DataFrame, starts: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(from, column, estimate): distinct values over the rows of ``sketches`` from each start on.

    Every row of ``sketches`` stands once for each start before it; both are tables of days, not of data.
    """
    wide = starts.join(sketches, F.col(by) >= F.col("from")).groupBy("from").agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])
    return wide.unpivot(["from"], columns, "column", "estimate")


def distinct_values(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    return (df if where is None else df.where(where)).select(column).distinct()


def concentration(df: DataFrame, key: str, top: int = 5) -> DataFrame:
    """Largest and median number of rows per key, and the percent of all rows of the ``top`` keys.

    One scan: rows per key, then a table of how many keys have n rows, which answers all three. That table has one row
    per distinct count, at most about the square root of twice the rows, so its order is one small window.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    sizes = counts.groupBy("n").agg(F.count(key).alias("keys"), F.sum("n").alias("rows"))
    upward = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    downward = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    placed = sizes.select("n", "keys", F.sum("keys").over(upward).alias("upto"), F.coalesce(F.sum("keys").over(downward), F.lit(0)).alias("above"), F.sum("keys").over(every).alias("all"), F.sum("rows").over(every).alias("total"))
    # The keys numbered (all - 1) div 2 and all div 2, from 0, are the middle ones.
    middle = lambda place: F.min(F.when(F.col("upto") > place, F.col("n")))
    taken = F.greatest(F.least(F.col("keys"), F.lit(top) - F.col("above")), F.lit(0))
    return placed.agg(
        F.max(F.when(F.col("keys") > 0, F.col("n"))).alias("max_n"), ((middle(F.expr("(all - 1) div 2")) + middle(F.expr("all div 2"))) / 2).alias("median_n"),
        (F.sum(taken * F.col("n")) / F.max("total") * 100).alias("top_percent"),
    )


def group_mean(df: DataFrame, dim: str, value: str) -> DataFrame:
    return df.groupBy(dim).agg(F.avg(value).alias("mean")).orderBy("mean", dim)


def rows_by_hour(df: DataFrame, start: str, hours: int = 24, time_column: str = "timestamp") -> DataFrame:
    """Row count per hour of day within the first hours after ``start``."""
    begin = F.expr(f"timestamp_ntz'{start} 00:00:00'")
    first = df.where(F.col(time_column) < begin + F.make_dt_interval(hours=F.lit(hours)))
    return first.groupBy(F.hour(time_column).alias("hour")).agg(F.count("*").alias("n"))


# --- summaries ---------------------------------------------------------------

def describe(df: DataFrame, columns: list[str], **search) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max, one row per column."""
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns}, **search)
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                *[F.lit(q).cast("double").alias(n) for n, q in zip(("q25", "q50", "q75"), quartiles[c])],
                F.max(c).cast("double").alias("max"),
            ).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    )
    return stats.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))


def percentiles(df: DataFrame, column: str, probabilities: list[float], **search) -> DataFrame:
    values = exact_quantiles(df, {column: probabilities}, **search)[column]
    return df.sparkSession.createDataFrame(list(zip(probabilities, values)), "p double, value double")


def value_range(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def skewness(df: DataFrame, column: str) -> DataFrame:
    """Bias-adjusted skewness (G1); Spark's own is unadjusted."""
    n = F.count(column)
    return df.agg((F.skewness(column) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0))).alias("skewness"))


def amount_tiers(df: DataFrame, amount: str = "amount_inr", target: str = TARGET, **search) -> DataFrame:
    """Rate per amount tier; the edges are 0, p90, p99, p99.9 and the maximum."""
    edges = exact_quantiles(df, {amount: [0.9, 0.99, 0.999, 1.0]}, **search)[amount]
    tiered = df.withColumn("tier", scalars.amount_tier(amount, [0.0, *edges]))
    return tiered.where(F.col("tier").isNotNull()).groupBy("tier").agg((F.avg(target) * 100).alias("fraud_rate"))


def histogram(df: DataFrame, value: Column, bins: int = 100) -> DataFrame:
    """Rows per equal-width bin between min and max; the last bin is closed, empty bins are absent."""
    values = df.select(value.alias("x")).where("x is not null")
    ends = values.agg(F.min("x").alias("low"), F.max("x").alias("high")).first()
    if ends["low"] is None:
        return values.select(F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
    low, width = ends["low"], (ends["high"] - ends["low"]) or 1.0
    slot = F.least(F.floor((F.col("x") - F.lit(low)) / F.lit(width) * bins), F.lit(bins - 1)).cast("int")
    return values.groupBy(slot.alias("bin")).agg(F.count("*").alias("n"))


# --- quality -----------------------------------------------------------------

def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, nulls) from one pass."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "nulls")


def critical_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    total = sum((F.count_if(F.col(c).isNull()) for c in columns[1:]), F.count_if(F.col(columns[0]).isNull()))
    return df.agg(total.alias("missing_critical"))


def counters(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows that meet each named condition, all in one pass."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def sanity_conditions(now: Column) -> dict[str, Column]:
    return {
        "negative_amounts": F.col("amount_inr") < 0,
        "future_dates": F.col("timestamp") > now,
        "impossible_limits": (F.col("credit_limit") <= 0) | (F.col("credit_limit") > 1e9),
        "negative_age": F.col("card_age") < 0,
    }


def class_balance(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rate in percent, negatives per positive, accuracy of always answering the majority class."""
    pos, neg = F.count_if(F.col(target) == 1), F.count_if(F.col(target) == 0)
    return df.agg(pos.alias("positives"), neg.alias("negatives"), F.count("*").alias("rows")).select(
        (F.try_divide("positives", "rows") * 100).alias("fraud_rate"),
        F.try_divide("negatives", "positives").alias("imbalance_ratio"),
        (F.try_divide("negatives", "rows") * 100).alias("baseline_accuracy"),
    )


def class_weight(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.agg(
        F.try_divide(F.count_if(F.col(target) == 0), F.count_if(F.col(target) == 1)).alias("scale_pos_weight")
    )


def split_summary(df: DataFrame, target: str = TARGET, time_column: str = "timestamp") -> DataFrame:
    groups = df.groupBy("split").agg(
        F.count("*").alias("n"),
        F.min(time_column).alias("first_ts"),
        F.max(time_column).alias("last_ts"),
        (F.avg(target) * 100).alias("fraud_rate"),
    )
    # One row per split.
    return groups.withColumn("percent", F.col("n") / F.sum("n").over(Window.partitionBy()) * 100)


def flag_share(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.sum(flag).cast("long").alias("flagged"), (F.avg(flag) * 100).alias("percent"))


def predicted_total(df: DataFrame, predicted: str = "is_fraud_predicted") -> DataFrame:
    return df.agg(F.sum(predicted).cast("long").alias("detected"), F.count("*").alias("rows"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def pairs_of(columns: list[str]) -> list[tuple[str, str]]:
    return list(combinations(columns, 2))
