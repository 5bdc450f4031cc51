"""Exact and near duplicates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import micros_of
from ..session import cut_lineage


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows that have at least one identical row, nulls equal, all copies counted.

    Whole rows are not shuffled to find them: first only a 64-bit row hash is grouped. Rows whose
    hash repeats are then compared in full, so a hash collision changes nothing. The semi-join is the
    same at every size; adaptive execution broadcasts the repeated hashes where they are few.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    hashed = df.withColumn("__h", F.xxhash64(*columns))
    repeated = hashed.groupBy("__h").agg(F.count("*").alias("n")).where("n > 1").select("__h")
    candidates = hashed.join(repeated, "__h", "left_semi")
    groups = candidates.groupBy(*columns).agg(F.count("*").alias("__n")).where("__n > 1")
    return groups.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("duplicates"))


def near_duplicate_rows(
    df: DataFrame,
    key: str = "user_id",
    amount: str = "amount_inr",
    time_column: str = "timestamp",
    id_column: str = "transaction_id",
    gap_seconds: int = 10,
) -> DataFrame:
    """Rows whose predecessor (same key, by time then id) has the same amount and is less than
    ``gap_seconds`` older.

    One key may own a large part of the table, so no window is a key. Rows are dealt into ranges of (key, time, id), whose
    borders follow the density of the rows: a key with half of the table is many ranges, and no task holds more than
    its share. A task compares neighbours as it reads its sorted range; what is left is the first row of each
    range, compared with the last row of the range before it: one row per range.
    """
    gap = gap_seconds * 1_000_000
    base = df.where(F.col(key).isNotNull() & F.col(time_column).isNotNull()).select(
        F.col(key).alias("k"), F.col(id_column).alias("i"), F.col(amount).alias("a"), micros_of(time_column).alias("t")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, first = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch] if last is None else [last, batch])
            first = first or batch.slice(0, 1)
            now, before = table.slice(1), table.slice(0, len(table) - 1)
            near = pc.less(pc.subtract(now["t"], before["t"]), gap)
            # A null amount equals none.
            close = pc.and_(pc.and_(pc.equal(now["k"], before["k"]), near), pc.fill_null(pc.equal(now["a"], before["a"]), False))
            found = now.filter(close)
            for rows in found.to_batches():
                yield marked(rows, 0, part)
            last = batch.slice(len(batch) - 1, 1)
        if first is not None:
            yield marked(first, 1, part)
            yield marked(last, 2, part)

    def marked(rows: pa.RecordBatch, kind: int, part: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(len(rows), kind, np.int32)), pa.array(np.full(len(rows), part, np.int32))], names=[*rows.schema.names, "kind", "part"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    ranged = base.repartitionByRange("k", "t", "i").sortWithinPartitions("k", "t", "i")
    found = cut_lineage(ranged.mapInArrow(run, f"{kinds}, kind int, part int"), "near")
    # Two rows per range.
    edges = found.where("kind > 0")
    order = Window.orderBy("part", "kind")
    seen = edges.select("*", *[F.lag(c).over(order).alias(f"before_{c}") for c in ("k", "t", "a")])
    across = seen.where((F.col("kind") == 1) & (F.col("k") == F.col("before_k")) & (F.col("t") - F.col("before_t") < gap) & (F.col("a") == F.col("before_a")))
    both = found.where("kind = 0").select("k", "i", "a").union(across.select("k", "i", "a"))
    return both.select(F.col("k").alias(key), F.col("i").alias(id_column), F.col("a").alias(amount))


def near_duplicates(df: DataFrame, **options) -> DataFrame:
    return near_duplicate_rows(df, **options).agg(F.count("*").alias("near_duplicates"))
