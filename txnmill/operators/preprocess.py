"""Model input preparation: category dictionaries, sparse indicators, dummies, robust scaling.

Text columns are prepared by a fitted dictionary, a stored table of (column, value, place), looked up by joins; the
model's vector holds the places as sparse entries, so a column may have any number of values. Numbers are scaled by
SQL text inside a ``SQLTransformer``, which is stored and loaded with the model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .order import exact_quantiles


def categories(df: DataFrame, columns: list[str], max_values: int = 2_000) -> dict[str, list[str]]:
    """Sorted distinct values per column, for ``indicators``, which makes a table column of each. A table of more
    than ``max_values`` columns is refused; models and ``sparse_indicators`` use a ``Dictionary``, without such a bound."""
    if not columns:
        return {}
    values = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .where("value is not null")
        .distinct()
        .limit(max_values + 1)
        .collect()
    )
    if len(values) > max_values:
        raise ValueError(f"more than {max_values} categories in {columns}; use a dictionary")
    return {c: sorted(r["value"] for r in values if r["column"] == c) for c in columns}


def indicators(df: DataFrame, values: dict[str, list[str]], prefixes: dict[str, str] | None = None, drop_first: bool = False) -> DataFrame:
    """Replace each column by 0/1 columns ``<prefix>_<value>``; unseen values and nulls give all 0.

    The columns come from the fitted values, so every table that goes through gets the same ones.
    """
    prefixes = prefixes or {}
    added = [
        F.when(F.col(c) == v, 1).otherwise(0).alias(f"{prefixes.get(c, c)}_{v}")
        for c, vs in values.items()
        for v in (vs[1:] if drop_first else vs)
    ]
    return df.select(*[F.col(c) for c in df.columns if c not in values], *added)


def robust_parameters(df: DataFrame, columns: list[str], **search) -> dict[str, tuple[float, float]]:
    """(median, interquartile range or 1) per column, exact."""
    found = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns}, **search)
    out = {}
    for c in columns:
        q1, q2, q3 = found[c]
        out[c] = (0.0, 1.0) if q2 is None else (q2, (q3 - q1) or 1.0)
    return out


def robust_scale(df: DataFrame, parameters: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in parameters.items()})


@dataclass(frozen=True)
class Dictionary:
    """The values of text columns: ``table`` has (column, value, place), and ``sizes`` the places of each column.

    Places follow the order of the values. With ``drop_first`` the first value of a column has no place.
    """

    table: DataFrame
    sizes: dict[str, int]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], drop_first: bool = True) -> Dictionary:
        """One pass: values are made distinct before the shuffle, so its size follows the values and not the rows."""
        if not columns:
            return cls(df.sparkSession.createDataFrame([], "column string, value string, place int"), {})
        found = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value").where("value is not null").distinct()
        in_order = Window.partitionBy("column").orderBy("value")
        placed = found.select("column", "value", (F.row_number().over(in_order) - (2 if drop_first else 1)).cast("int").alias("place"))
        return cls.of(cut_lineage(placed.where("place >= 0"), "dictionary"), columns)

    @classmethod
    def of(cls, table: DataFrame, columns: list[str]) -> Dictionary:
        found = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.max("place").alias("n")).collect()}
        return cls(table, {c: found.get(c, -1) + 1 for c in columns})

    def look_up(self, df: DataFrame, prefix: str = "__p_") -> DataFrame:
        """``df`` with the place of each column's value. Values without a place, and nulls, get the number of places."""
        for c, size in self.sizes.items():
            own = self.table.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("place").alias(f"{prefix}{c}"))
            df = df.join(own, F.col(f"`{c}`").cast("string") == F.col("__value"), "left").drop("__value")
            df = df.withColumn(f"{prefix}{c}", F.coalesce(f"`{prefix}{c}`", F.lit(size)))
        return df

    def names(self, separator: str = "_") -> DataFrame:
        """(index, name) of the places of all columns, one column after another."""
        return self.table.select((self._before("column") + F.col("place")).alias("index"), F.concat_ws(separator, "column", "value").alias("name"))

    @property
    def width(self) -> int:
        return sum(self.sizes.values())

    def _before(self, column: str):
        total, out = 0, F.lit(0)
        for c, size in self.sizes.items():
            out = F.when(F.col(column) == c, total).otherwise(out)
            total += size
        return out


def sparse_indicators(df: DataFrame, dictionary: Dictionary, output: str = "indices") -> DataFrame:
    """``df`` without the dictionary's columns, plus the ascending indices (see ``Dictionary.names``) of its indicators that
    are 1. Unseen values and nulls have none."""
    placed, before = dictionary.look_up(df), 0
    found = []
    for c, size in dictionary.sizes.items():
        found.append(F.when(F.col(f"`__p_{c}`") < size, F.col(f"`__p_{c}`") + before))
        before += size
    own = [F.col(f"`{c}`") for c in df.columns if c not in dictionary.sizes]
    return placed.select(*own, F.array_compact(F.array(*found)).alias(output))


@dataclass(frozen=True)
class Preprocessor:
    """Fitted preparation: the dictionary of text columns, and stages for what it looks up and for numbers."""

    dictionary: Dictionary
    stages: list
    numbers: list[str]

    @property
    def width(self) -> int:
        return self.dictionary.width + len(self.numbers)

    def transform(self, df: DataFrame) -> DataFrame:
        return PipelineModel(self.stages).transform(self.dictionary.look_up(df))

    def names(self) -> DataFrame:
        """(index, name) of the vector's entries."""
        spark, first = self.dictionary.table.sparkSession, self.dictionary.width
        return self.dictionary.names().union(spark.createDataFrame([(first + k, c) for k, c in enumerate(self.numbers)], "index int, name string"))


def _one_hot(spark: SparkSession, sizes: dict[str, int]):
    """Encoder of places: the place beyond the last stands for no value and gives an all-zero sparse vector."""
    sized = {c: n for c, n in sizes.items() if n}
    if not sized:
        return None
    encoder = OneHotEncoder(inputCols=[f"__p_{c}" for c in sized], outputCols=[f"__v_{c}" for c in sized], handleInvalid="keep")
    largest = spark.createDataFrame([tuple(float(n - 1) for n in sized.values())], ", ".join(f"`__p_{c}` double" for c in sized))
    return encoder.fit(largest)


def create_preprocessor(df: DataFrame, features: list[str], output: str = "features", **search) -> Preprocessor:
    """Strings -> drop-first sparse indicators, numbers -> robust scaling, chosen by column type.

    A missing number becomes 0 after scaling, that is the median.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    text = [c for c in features if isinstance(kinds[c], T.StringType)]
    numbers = [c for c in features if isinstance(kinds[c], T.NumericType)]
    dictionary = Dictionary.fit(df, text)
    scales = robust_parameters(df, numbers, **search)
    encoder = _one_hot(df.sparkSession, dictionary.sizes)
    expressions = [
        f"COALESCE((CAST(`{c}` AS DOUBLE) - {scales[c][0]!r}D) / {scales[c][1]!r}D, 0.0D) AS `__n_{k}`" for k, c in enumerate(numbers)
    ]
    inputs = [*(encoder.getOutputCols() if encoder else []), *[f"__n_{k}" for k in range(len(numbers))]]
    stages = [SQLTransformer(statement=f"SELECT {', '.join(['*', *expressions])} FROM __THIS__")]
    if encoder:
        stages.append(encoder)
    return Preprocessor(dictionary, [*stages, VectorAssembler(inputCols=inputs, outputCol=output)], numbers)
