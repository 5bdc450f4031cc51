"""Seeded draws that depend on the row key alone.

``rand(seed)`` depends on how rows are partitioned, so a retried task could draw other numbers.
Here a draw is a function of (key, salt): equal on every retry, partitioning and cluster.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import as_column


def key_hash(key, salt: str) -> Column:
    """52 bits of md5(key || salt) as a long."""
    text = F.concat(as_column(key).cast("string"), F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def uniform(key, salt: str) -> Column:
    """A number in [0, 1) for this key and salt."""
    return key_hash(key, salt).cast("double") / F.lit(float(2 ** 52))


def weighted(u: Column, weights: dict) -> Column:
    """The value whose share of [0, 1) holds ``u``; the last value takes the rounding rest."""
    values = [v for v, w in weights.items() if w > 0]
    edges = list(accumulate(w for w in weights.values() if w > 0))
    out = F.lit(values[-1])
    for value, edge in reversed(list(zip(values[:-1], edges[:-1]))):
        out = F.when(u < F.lit(edge), F.lit(value)).otherwise(out)
    return out


def weighted_by(group: Column, u: Column, weights_of: dict[str, dict], default=None) -> Column:
    """``weighted`` with one distribution per group; a group without one gets the default."""
    out = F.lit(default)
    for name, weights in weights_of.items():
        if weights:
            out = F.when(group == name, weighted(u, weights)).otherwise(out)
    return out


def uniform_int(u: Column, low, high) -> Column:
    """An integer in [low, high)."""
    low, high = (c if isinstance(c, Column) else F.lit(c) for c in (low, high))
    return F.floor(low + u * (high - low)).cast("int")


def zeta(a: float, terms: int = 1000) -> float:
    """Riemann zeta for a > 1: a direct sum plus the Euler-Maclaurin tail."""
    head = math.fsum(k ** -a for k in range(1, terms))
    tail = terms ** (1 - a) / (a - 1) + 0.5 * terms ** -a + a * terms ** (-a - 1) / 12
    return head + tail


def power_law_edges(a: float, n: int) -> list[float]:
    """Cumulative probabilities of 1..n-1 under k^-a / zeta(a); all further mass falls on n."""
    total = zeta(a)
    return list(accumulate(k ** -a / total for k in range(1, n)))


def with_power_law(df: DataFrame, column: str, u: Column, a: float, n: int) -> DataFrame:
    """Add an integer in 1..n, power-law distributed. The lookup of ``u`` among the n edges is a
    binary search inside the JVM, so no join and no shuffle."""
    edges = power_law_edges(a, n)
    raw, slot = f"__{column}_u", f"__{column}_slot"
    search = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol=raw, outputCol=slot)
    return (
        search.transform(df.withColumn(raw, u))
        .withColumn(column, F.col(slot).cast("int") + 1)
        .drop(raw, slot)
    )
