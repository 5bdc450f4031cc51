"""Joins whose left side may hold a third of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], by: Sequence[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """``left`` with the columns of ``right``, which has one row for each value of ``keys`` (all not null).

    The rows of one key are dealt over ``salts`` parts by the columns ``by``. The right side is repeated for the parts
    that are there and no others: at most ``salts`` rows a key meet in the first join, and a key's share divided by
    ``salts`` in the second. Empty sides give what the plain join gives.
    """
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by]), F.lit(salts)).cast("int"))
    there = dealt.select(*keys, "_salt").distinct()
    return dealt.join(there.join(right, list(keys)), [*keys, "_salt"], how).drop("_salt")
