"""Tree ensembles as a relation: one row per node, scored by expressions.

A node table has ``tree, weight, node, feature, threshold, low, high, value``. A row goes to ``low`` where its feature
is at or below the threshold, else to ``high``; leaves have neither and carry ``value``. The root of a tree is node 0.
Such a table is read from a stored model, can be kept beside it, looked at and joined like any other, and scores rows
without the library that fitted it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODES = "tree int, weight double, node int, feature int, threshold double, low int, high int, value double"


def stored_nodes(spark: SparkSession, path: str, stage: int) -> DataFrame:
    """The node table of the boosted trees stored as stage number ``stage`` of the pipeline at ``path``."""
    folder = f"{path}/stages/{stage}_*"
    data = spark.read.parquet(f"{folder}/data")
    weights = spark.read.parquet(f"{folder}/treesMetadata").toDF("treeID", "metadata", "weight").select("treeID", "weight")
    n, split = F.col("nodeData"), F.col("nodeData")["split"]
    values = split["leftCategoriesOrThreshold"]
    # A feature known to be 0 or 1 is split by the set of values that go left; one with more values has no order.
    binary, inner = split["numCategories"] == 2, n["leftChild"] >= 0
    swapped = binary & (F.get(values, F.lit(0)) == 1.0)
    threshold = F.when(binary, F.lit(0.5)).when(split["numCategories"] == -1, F.get(values, F.lit(0))).otherwise(F.raise_error(F.lit("a split over unordered values")))
    rows = data.join(weights, "treeID").select(
        F.col("treeID").alias("tree"),
        "weight",
        n["id"].alias("node"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner, threshold).alias("threshold"),
        F.when(inner, F.when(swapped, n["rightChild"]).otherwise(n["leftChild"])).alias("low"),
        F.when(inner, F.when(swapped, n["leftChild"]).otherwise(n["rightChild"])).alias("high"),
        F.when(~inner, n["prediction"]).alias("value"),
    )
    return rows.select(*[F.col(name).cast(kind).alias(name) for name, kind in (part.split() for part in NODES.split(", "))])


def margin(nodes: DataFrame, vector: Column) -> Column:
    """Weighted sum of the leaves that ``vector`` (array of double) reaches.

    The node table becomes constant arrays of the plan: its size is that of a model and does not grow with the rows.
    Every tree is walked from its root by as many steps as the deepest tree has, so the expression's size is fixed.
    """
    rows = nodes.orderBy("tree", "node").collect()
    if not rows:
        return F.lit(0.0)
    at = {(r["tree"], r["node"]): i for i, r in enumerate(rows)}
    leaf = [r["low"] is None for r in rows]

    def constant(values: list, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")

    # A leaf leads to itself.
    feature = constant([0 if x else r["feature"] for r, x in zip(rows, leaf)], "int")
    threshold = constant([0.0 if x else r["threshold"] for r, x in zip(rows, leaf)], "double")
    low = constant([i if x else at[r["tree"], r["low"]] for i, (r, x) in enumerate(zip(rows, leaf))], "int")
    high = constant([i if x else at[r["tree"], r["high"]] for i, (r, x) in enumerate(zip(rows, leaf))], "int")
    value = constant([r["weight"] * r["value"] if x else 0.0 for r, x in zip(rows, leaf)], "double")
    roots = constant([i for i, r in enumerate(rows) if r["node"] == 0], "int")
    depth = _depth(rows, at, leaf)

    def walk(x: Column, root: Column) -> Column:
        if not depth:
            return root
        step = lambda n, _: F.when(F.get(x, F.get(feature, n)) <= F.get(threshold, n), F.get(low, n)).otherwise(F.get(high, n))
        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), root, step)

    def total(x: Column) -> Column:
        return F.aggregate(F.transform(roots, lambda root: F.get(value, walk(x, root))), F.lit(0.0), lambda a, v: a + v)

    # The vector is bound to a variable: named in the steps, what makes it would run anew in each of them.
    return F.get(F.transform(F.array(vector), total), F.lit(0))


def _depth(rows: list, at: dict, leaf: list[bool]) -> int:
    level = [i for i, r in enumerate(rows) if r["node"] == 0]
    steps = 0
    while level := [at[rows[i]["tree"], rows[i][side]] for i in level if not leaf[i] for side in ("low", "high")]:
        steps += 1
    return steps


def probability(margin_: Column) -> Column:
    """Of the positive class, from the margin of trees boosted on the logistic loss with labels -1 and 1."""
    return 1.0 / (1.0 + F.exp(-2.0 * margin_))

