"""Synthetic minority oversampling.

New rows lie between a minority row and one of its near minority rows. The neighbours are found
once per minority row and the new rows are then exploded from that table, so the cost of the search
does not depend on how many rows are wanted. The search is the same at every size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import key_hash, uniform
from ..session import cut_lineage
from .order import order_statistics, with_buckets

#: Rows of one block of the order along a direction.
BLOCK = 2_048


def near_rows(points: DataFrame, dims: int, k: int = 5, reach: int = 20, projections: int = 4) -> DataFrame:
    """(id, vec, near): up to ``k`` near other rows of each row of (id, vec).

    Rows are sorted along ``projections`` random directions (range buckets, sorted in parallel); the
    ``reach`` rows on either side in each order are compared and the k closest kept. Every row has
    the same number of candidates, so dense regions and copies cause no skew. The neighbours are
    near ones, not always the nearest; more directions and a longer reach come closer.
    """
    directions = np.random.default_rng(0).normal(size=(projections, dims))
    found = None
    for direction in directions:
        axis = F.aggregate(
            F.arrays_zip(F.col("vec").alias("v"), F.array(*[F.lit(float(x)) for x in direction]).alias("r")),
            F.lit(0.0),
            lambda acc, e: acc + e["v"] * e["r"],
        )
        around = Window.partitionBy("block").orderBy("place").rowsBetween(-reach, reach)
        candidates = F.collect_list(F.struct("id", "vec")).over(around)
        part = (
            _blocks(points.withColumn("axis", axis), reach)
            .select("id", "vec", "home", candidates.alias("c"))
            .where("home")
            .select("id", "vec", _closest(F.col("c"), F.col("vec"), F.col("id"), k).alias("best"))
        )
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy("id").agg(F.first("vec").alias("vec"), F.flatten(F.collect_list("best")).alias("best"))
    best = F.slice(F.array_sort(F.array_distinct("best")), 1, k)
    return merged.select("id", "vec", F.transform(best, lambda s: s["vec"]).alias("near"))


def _blocks(points: DataFrame, reach: int) -> DataFrame:
    """Rows with their ``place`` in the order of ``axis``, cut into blocks of ``BLOCK`` places.

    A row within ``reach`` of a border is also in the block beyond it (``home`` is false there), so
    every row sees both sides.
    """
    placed = _even_parts(with_buckets(points, ["axis"]))
    groups = placed.groupBy("axis__b", "part").agg(F.count("*").alias("n"))
    # One row per (bucket, part).
    earlier = Window.orderBy("axis__b", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("axis__b", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("axis__b", "part").orderBy("axis", "id")) - 1
    ordered = placed.join(F.broadcast(offsets), ["axis__b", "part"]).select("id", "vec", (F.col("offset") + inside).alias("place"))
    own = F.expr(f"place div {BLOCK}")
    blocks = F.array_distinct(F.array(own, F.expr(f"(place + {reach}) div {BLOCK}"), F.expr(f"greatest(place - {reach}, 0) div {BLOCK}")))
    return ordered.select("id", "vec", "place", F.explode(blocks).alias("block")).withColumn("home", F.col("block") == own)


def _even_parts(placed: DataFrame) -> DataFrame:
    """Add ``part``: buckets far above the average size (many equal rows) are split by id hash."""
    sizes = placed.groupBy("axis__b").agg(F.count("*").alias("n"))
    parts = sizes.select("axis__b", F.ceil(F.col("n") / (2 * sizes.agg(F.avg("n").alias("m")).scalar())).alias("parts"))
    joined = placed.join(F.broadcast(parts), "axis__b")  # one row per bucket
    return joined.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).drop("parts")


def _closest(candidates: Column, vec: Column, own: Column, k: int) -> Column:
    others = F.filter(candidates, lambda s: s["id"] != own)
    scored = F.transform(
        others,
        lambda s: F.struct(
            F.aggregate(
                F.zip_with(s["vec"], vec, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, d: acc + d
            ).alias("distance"),
            s["id"].alias("id"),
            s["vec"].alias("vec"),
        ),
    )
    return F.slice(F.array_sort(scored), 1, k)


def oversample(
    df: DataFrame,
    features: list[str],
    target: str = "is_fraud",
    ratio: float = 0.1,
    k: int = 5,
    id_column: str = "transaction_id",
    reach: int = 20,
    projections: int = 4,
) -> DataFrame:
    """``df`` (features and target) with synthetic positives added until they are
    ``int(ratio * negatives)``. ``id_column`` must be a unique long; features must be numeric."""
    rows = df.select(
        F.col(id_column).cast("long").alias("id"), F.array(*[F.col(c).cast("double") for c in features]).alias("vec"), F.col(target).alias("target")
    )
    out = oversample_vectors(rows, len(features), ratio, k, reach, projections)
    return out.select(*[F.col("vec")[i].alias(c) for i, c in enumerate(features)], F.col("target").alias(target))


def oversample_vectors(rows: DataFrame, dims: int, ratio: float = 0.1, k: int = 5, reach: int = 20, projections: int = 4) -> DataFrame:
    """(vec, target) of ``rows`` (id, vec, target) with the synthetic positives. Nulls count as 0 in positives."""
    counts = rows.agg(F.count_if(F.col("target") == 1).alias("pos"), F.count_if(F.col("target") == 0).alias("neg")).first()
    wanted = int(ratio * counts["neg"]) - counts["pos"]
    base = rows.select("vec", "target")
    if wanted <= 0 or counts["pos"] < 2:
        return base
    points = rows.where("target = 1").select("id", F.transform("vec", lambda v: F.coalesce(v, F.lit(0.0))).alias("vec"))
    near = near_rows(points, dims, k, reach, projections)
    near = cut_lineage(near, "neighbours")  # one row per minority row; the search runs once
    each, rest = divmod(wanted, counts["pos"])
    copies = F.lit(each)
    if rest:
        # The ``rest`` rows with the smallest hashes make one more; ties of the hash go by id.
        keys = points.select(key_hash("id", "extra").alias("h"))
        edge = order_statistics(keys, {"h": [rest - 1]})["h"][rest - 1]
        hashed = key_hash("id", "extra")
        more = hashed < F.lit(edge.value)
        tied = points.where(hashed == F.lit(edge.value)).select("id")
        place = rest - 1 - edge.below
        last = order_statistics(tied, {"id": [place]})["id"][place].value
        copies = copies + F.when(more | ((hashed == F.lit(edge.value)) & (F.col("id") <= F.lit(last))), 1).otherwise(0)
    new = (
        near.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))) if each else
        near.where(copies > 0).withColumn("copy", F.lit(1))
    )
    key = F.concat_ws(":", F.col("id").cast("string"), F.col("copy").cast("string"))
    pick = F.floor(uniform(key, "pick") * F.size("near")).cast("int")
    new = new.withColumns({"other": F.element_at("near", pick + 1), "gap": uniform(key, "gap")})
    between = F.zip_with("vec", "other", lambda a, b: a + F.col("gap") * (b - a))
    return base.unionByName(new.select(between.alias("vec"), F.lit(1).cast(rows.schema["target"].dataType).alias("target")))
