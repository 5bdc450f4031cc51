"""Target encoding of a categorical column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookups import stored_side


def category_statistics(df: DataFrame, column: str, target: str = "is_fraud") -> DataFrame:
    """(category, n, positives), null category included: the only pass over the data that a fit needs."""
    return df.groupBy(F.col(column).alias("category")).agg(
        F.count(target).alias("n"), F.coalesce(F.sum(target), F.lit(0)).alias("positives")
    )


def encodings(statistics: DataFrame, global_mean, smoothing: float) -> DataFrame:
    """(category, n, encoding): (n * mean + m * global) / (n + m); ``smoothing=0`` is the plain mean."""
    m = F.lit(float(smoothing))
    return statistics.where(F.col("category").isNotNull()).select(
        "category", "n", ((F.col("positives") + m * global_mean) / F.nullif(F.col("n") + m, F.lit(0.0))).alias("encoding")
    )


def overall_rate(statistics: DataFrame):
    return F.try_divide(F.sum("positives"), F.sum("n"))


def encoding_table(df: DataFrame, column: str, target: str = "is_fraud", smoothing: float = 10.0) -> DataFrame:
    """The fitted table as one lazy query; null categories count for the global mean only."""
    statistics = category_statistics(df, column, target)
    return encodings(statistics, statistics.agg(overall_rate(statistics)).scalar(), smoothing)


@dataclass(frozen=True)
class TargetEncoder:
    """A fitted encoding: its table (hinted for broadcast only if small) and the fallback value."""

    column: str
    table: DataFrame
    global_mean: float | None

    @classmethod
    def fit(
        cls, df: DataFrame, column: str, target: str = "is_fraud", smoothing: float = 10.0,
    ) -> "TargetEncoder":
        statistics = stored_side(category_statistics(df, column, target))
        mean = statistics.agg(overall_rate(statistics)).first()[0]
        return cls(column, encodings(statistics, F.lit(mean), smoothing), mean)

    def transform(self, df: DataFrame, output: str | None = None) -> DataFrame:
        """Add ``<column>_encoded``; an unknown or null category gets the global mean."""
        output = output or f"{self.column}_encoded"
        side = self.table.select(F.col("category").alias("__category"), F.col("encoding").alias("__encoding"))
        joined = df.join(side, F.col(self.column) == F.col("__category"), "left")
        return joined.withColumn(output, F.coalesce("__encoding", F.lit(self.global_mean))).drop(
            "__category", "__encoding"
        )

    def save(self, path: str) -> None:
        """The table with the fallback as the row of the null category."""
        spark = self.table.sparkSession
        fallback = spark.createDataFrame([(0, self.global_mean)], "n long, encoding double")
        self.table.unionByName(fallback, allowMissingColumns=True).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str, column: str) -> "TargetEncoder":
        stored = spark.read.parquet(path)
        mean = stored.where(F.col("category").isNull()).first()["encoding"]
        return cls(column, stored_side(stored.where(F.col("category").isNotNull())), mean)
