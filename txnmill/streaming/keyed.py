"""A small table that a stream keeps current: every batch replaces it, or the rows of its keys.

A generation is a folder named by the number of its batch. ``base=N`` holds the whole table after batch N, ``part=N`` the
rows that batch N changed. Spark writes a folder's ``_SUCCESS`` file last, so a folder counts once it has one, and
readers never see half a batch. Batches have numbers that grow and are repeated after a failure: a batch at or
below the newest base is in it already, any other overwrites its own folder.

After ``every`` changed parts the newest base and the parts behind it are merged into a new base. The generation before is
kept until the next merge, so a reader that started on it can finish; older folders are deleted. The number of
folders is thus bounded, whatever the length of the stream, and a merge costs one pass over the table per ``every`` batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVERY = 16


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), every: int = EVERY):
        self.spark, self.path, self.keys, self.every = spark, path.rstrip("/"), tuple(keys), every

    def replace(self, batch: DataFrame, epoch: int) -> None:
        """The batch is the whole table."""
        held = self._generations()
        if epoch < max(held["base"], default=-1):
            return
        batch.write.mode("overwrite").parquet(f"{self.path}/base={epoch}")
        self._delete(held, keep=max((n for n in held["base"] if n != epoch), default=-1))

    def update(self, batch: DataFrame, epoch: int) -> None:
        """The batch has the new rows of its keys."""
        held = self._generations()
        newest = max(held["base"], default=-1)
        if epoch <= newest:
            return
        batch.write.mode("overwrite").parquet(f"{self.path}/part={epoch}")
        behind = sorted({*(n for n in held["part"] if n > newest), epoch})
        if len(behind) >= self.every:
            self._merged(newest, behind).write.mode("overwrite").parquet(f"{self.path}/base={epoch}")
            self._delete(held, keep=newest)

    def read(self) -> DataFrame:
        held = self._generations()
        newest = max(held["base"], default=-1)
        return self._merged(newest, sorted(n for n in held["part"] if n > newest))

    def _merged(self, base: int, parts: list[int]) -> DataFrame:
        """The last row of every key; rows of one part have keys of their own."""
        folders = ([(base, f"base={base}")] if base >= 0 else []) + [(n, f"part={n}") for n in parts]
        rows = [self.spark.read.parquet(f"{self.path}/{name}").withColumn("__epoch", F.lit(n)) for n, name in folders]
        if not parts:
            return rows[0].drop("__epoch")
        every = rows[0]
        for more in rows[1:]:
            every = every.unionByName(more)
        values = [c for c in every.columns if c not in (*self.keys, "__epoch")]
        last = every.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "__epoch").alias("__last"))
        return last.select(*self.keys, *[F.col("__last")[c].alias(c) for c in values])

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, folder, folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _generations(self) -> dict[str, list[int]]:
        """Numbers of the finished folders by kind."""
        jvm, folder, files = self._files()
        out: dict[str, list[int]] = {"base": [], "part": []}
        if files.exists(folder):
            for status in files.listStatus(folder):
                kind, _, number = status.getPath().getName().partition("=")
                if kind in out and files.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                    out[kind].append(int(number))
        return out

    def _delete(self, held: dict[str, list[int]], keep: int) -> None:
        """Folders that neither the newest base nor the generation from base ``keep`` on needs."""
        jvm, _, files = self._files()
        for kind, numbers in held.items():
            for n in numbers:
                if n < keep or (kind == "part" and n == keep):
                    files.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}={n}"), True)
