"""Vector bin packing of documents into shards: bytes, tokens and rows are balanced jointly.

A group is the set of rows with equal text. Each group is placed where the dot product of its demand with the
residual capacity of the shard is highest, largest demands first.

Placing is sequential, so it must not follow the number of documents. Groups of up to ``1 / (shards * GRAIN)`` of
every total travel in bundles by a hash of their text (``shards * GRAIN`` bundles); larger groups travel alone, in
pieces of about that share, dealt by a hash of the id. So at most about ``10 * shards * GRAIN`` items are placed on the
driver, whatever the input. A text stays in one shard unless it is larger than a piece; one document is never cut.

Law ``bytes``: the sizes of the shards are near equal. ``slot`` counts the rows of a shard from 0: the shard's items
follow each other, rows within an item are numbered by id, so no window holds more than an item.

Edge cases: null and empty texts have size 8, checksum 0 and form one group; null ids come first; rows equal in every
column are numbered in any order, which no output shows; an empty table gives an empty result. Columns named in
``keep`` are carried; one with the name of a result column is left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnmill.session import cut_lineage

from .mixing import word_count

SHARDS = 24
GRAIN = 500
RESULT = ("doc_id", "size", "text_crc32", "n_tokens", "shard", "slot")
#: Weight of bytes, tokens and rows in the dot product.
WEIGHTS = (4.0, 1.0, 1.0)


def place(demand: np.ndarray, shards: int, weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """Shard of each item. ``demand`` is items x dimensions; totals are scaled to 1 per dimension.

    Items go by falling largest demand (ties in the given order). Capacity is an equal share of each total; a
    dimension without demand counts nothing.
    """
    total = demand.sum(axis=0)
    scaled = demand / np.where(total > 0, total, 1.0)
    weight = np.asarray(weights)
    left = np.full((shards, demand.shape[1]), 1.0 / shards) * (total > 0)
    out = np.zeros(len(demand), np.int32)
    for i in np.argsort(-scaled.max(axis=1), kind="stable").tolist():
        shard = int(np.argmax(left @ (weight * scaled[i])))
        out[i] = shard
        left[shard] -= scaled[i]
    return out


def shard(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, grain: int = GRAIN, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, size, text_crc32, n_tokens, shard, slot`` (and ``keep``) for every row."""
    spark = docs.sparkSession
    keep = tuple(c for c in keep if c not in RESULT)
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    sized = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        (F.octet_length(content) + 8).cast("long").alias("size"),
        F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
        word_count(content).alias("n_tokens"),
        F.xxhash64(content).alias("group"),
        *[F.col(f"`{c}`").alias(f"_keep{k}") for k, c in enumerate(keep)],
    )
    # Only the narrow columns are stored; carried columns move once, in the last step.
    rows = cut_lineage(sized.drop(*[f"_keep{k}" for k in range(len(keep))]), "sizes")
    sums = [F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = rows.agg(*sums).first()
    limits = {k: (total[k] or 0) / (shards * grain) for k in ("bytes", "tokens", "rows")}
    pieces = F.ceil(F.greatest(*[F.col(k) / F.lit(v) if v else F.lit(0.0) for k, v in limits.items()], F.lit(1.0))).cast("int")
    # At most shards * grain groups exceed each of the three limits, so this table is bounded.
    large = cut_lineage(
        rows.groupBy("group").agg(*sums).select("group", pieces.alias("pieces")).where("pieces > 1"), "large"
    )

    def in_pieces(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(large), "group", "left").select(*df.columns, alone.alias("alone"), part.alias("part"))

    alone = F.when(F.col("pieces").isNull(), F.lit(None).cast("long")).otherwise(F.col("group"))
    part = F.coalesce(F.pmod(F.xxhash64(F.lit("piece"), "doc_id", "group"), F.col("pieces")), F.pmod("group", F.lit(shards * grain))).cast("int")
    items = in_pieces(rows).groupBy("alone", "part").agg(*sums).orderBy("alone", "part").collect()
    demand = np.array([(i["bytes"], i["tokens"], i["rows"]) for i in items], float).reshape(len(items), 3)
    filled, table = [0] * shards, []
    for item, to in zip(items, place(demand, shards).tolist(), strict=True):
        table.append((item["alone"], item["part"], to, filled[to]))
        filled[to] += item["rows"]
    placed = spark.createDataFrame(table, "_alone long, _part int, shard int, before long")
    joined = in_pieces(sized).join(F.broadcast(placed), F.col("alone").eqNullSafe(F.col("_alone")) & (F.col("part") == F.col("_part")))
    inside = Window.partitionBy("alone", "part").orderBy("doc_id", "text_crc32", "size")
    return joined.select(
        "doc_id",
        "size",
        "text_crc32",
        "n_tokens",
        "shard",
        (F.col("before") + F.row_number().over(inside) - 1).cast("long").alias("slot"),
        *[F.col(f"_keep{k}").alias(c) for k, c in enumerate(keep)],
    )
