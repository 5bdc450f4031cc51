"""Mixing sources to target weights: equal-token blocks apportioned to sources by highest quotients.

1. A document's size is its number of words. Sources share ``share`` of all words by weight; a target stops at
   ``repeats`` times its source's size and the excess is shared again (water filling over the source table).
2. Documents are dealt to shards by a seeded hash of their id and text. In a shard, the documents of a source are laid end to
   end in seeded order and cut into blocks of equally many words.
3. Sainte-Lague per shard: the shard's seats go to the sources with the highest quotients ``votes / (2 k + 1)``, the
   votes being the blocks of the source in the shard times its target per word. Every source gets an integer quota.
4. The quota takes each block of the source in the shard equally often, and the rest by seeded rank.

A document takes the words of its part of the taken blocks, so it never exceeds ``repeats`` times its size.

The number of shards follows the number of rows (``ROWS`` per shard) and the number of blocks follows the number of
shards (``BLOCKS`` per shard), so every window below covers a bounded number of rows, whatever share one source has.
All draws are md5 of (seed, id, md5 of the text), so reruns and other partitionings agree, and rows without an id or with
a repeated one are spread like all others.

Edge cases: null or empty text has size 0 and takes 0; a null source is a source of its own, last in order; null and
repeated ids are documents of their own; rows that are equal in id, text and source are told apart only by their order,
which no output shows;
an empty table gives an empty result. Other columns of the caller are dropped except those named in
``keep``; one with the name of a result column is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnmill.session import cut_lineage

ROWS = 50_000
SHARDS = 64
BLOCKS = 3_125
WEIGHTS = (5, 2, 1)
RESULT = ("doc_id", "size", "source_size", "target", "taken")
#: One copy, in the units of running sums of copies.
ONE = 1 << 30


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def mark_of(text: Column) -> Column:
    """Digest of a text; a null one is empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def draw(seed: str, *parts: Column) -> Column:
    """32 hex digits of (seed, parts)."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeats: int = 2) -> DataFrame:
    """One row per source: ``source, source_size, weight, target``. ``sizes`` has ``source`` and ``source_size``.

    The level at which targets stop rising is found by one sorted pass over the sources (one row per source): a
    source is full when its limit per weight is at most the level that the sources after it would have.
    """
    # One row per source; the order by code point fixes the repeating weights.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = sizes.select("*", (F.row_number().over(by_name) - 1).alias("place"))
    weighed = listed.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1).cast("double").alias("weight"), "place")
    total, limit = F.sum("source_size").over(Window.partitionBy()), F.col("source_size") * F.lit(float(repeats))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    ranked = weighed.select("*", limit.alias("limit"), (total * F.lit(share)).alias("pool")).select(
        "*",
        ((F.col("pool") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
         / (F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))).alias("level"),
    )
    # Sources are full up to the first whose limit lies above the level left at its turn.
    open_ = F.min(F.when(F.col("limit") > F.col("level") * F.col("weight"), F.struct(F.col("limit") / F.col("weight"), F.col("place"), F.col("level")))).over(Window.partitionBy())
    return ranked.select("*", open_["level"].alias("final")).select(
        "source",
        "source_size",
        F.col("weight").cast("int").alias("weight"),
        F.coalesce(F.least(F.col("limit"), F.col("final") * F.col("weight")), F.col("limit")).alias("target"),
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    repeats: int = 2,
    seed: str = "mix",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` (and ``keep``) for every document."""
    keep = tuple(c for c in keep if c not in RESULT)
    own = [F.col(f"`{c}`").alias(f"_keep{k}") for k, c in enumerate(keep)]
    sized = cut_lineage(
        docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"), mark_of(F.col(f"`{text}`")).alias("mark"), *own),
        "sizes",
    )
    totals = sized.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("words")).first()
    shards = max(SHARDS, -(-totals["rows"] // ROWS))
    block = max(1, totals["words"] // (shards * BLOCKS))
    per_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats)
    per_source = cut_lineage(per_source, "targets")

    digits = draw(seed, F.col("doc_id"), F.col("mark"))
    placed = sized.select("*", F.pmod(F.conv(F.substring(digits, 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int").alias("shard"), digits.alias("draw"))
    in_order = Window.partitionBy("source", "shard").orderBy("draw", "doc_id", "size")
    laid = placed.select("*", (F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("from"))
    cells = placed.groupBy("source", "shard").agg(F.sum("size").alias("words")).where("words > 0")
    wanted = blocks_taken(cells, per_source, block, seed, repeats)

    # Copies of the words before a position: those of earlier blocks, and the started block so far.
    def upto(position: str) -> Column:
        w = F.col(f"_{position}")
        return F.when(F.col(position) == 0, F.lit(0)).otherwise(w["before"] + w["copies"] * (F.col(position) - w["block"] * F.lit(block)))

    laid = laid.select("*", (F.col("from") + F.col("size")).alias("to"))
    for position in ("from", "to"):
        at = wanted.select(
            F.col("source").alias("_source"), F.col("shard").alias("_shard"), F.col("block").alias("_block"),
            F.struct("block", "copies", "before").alias(f"_{position}"),
        )
        # A position that ends a block is counted in that block.
        number = F.expr(f"greatest(`{position}` - 1, 0L) div {block}L")
        on = F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")) & (number == F.col("_block"))
        laid = laid.join(at, on, "left").drop("_source", "_shard", "_block")
    taken = F.when(F.col("size") == 0, F.lit(0)).otherwise(upto("to") - upto("from")).cast("long")
    named = per_source.select(F.col("source").alias("_source"), "source_size", "target")
    return laid.join(named, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id",
        "size",
        "source_size",
        F.round("target", 6).alias("target"),
        taken.alias("taken"),
        *[F.col(f"_keep{k}").alias(c) for k, c in enumerate(keep)],
    )


def blocks_taken(cells: DataFrame, per_source: DataFrame, block: int, seed: str, repeats: int) -> DataFrame:
    """Every block of every (source, shard): ``copies`` taken of it, and the words ``before`` it in those copies."""
    voted = cells.join(per_source.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).select(
        "source", "shard", "target", "source_size", F.expr(f"(words + {block - 1}) div {block}").alias("blocks")
    ).select("source", "shard", "blocks", (F.col("target") * F.col("blocks") / F.col("source_size")).alias("votes"))
    seated = voted.select("*", F.round(F.sum("votes").over(Window.partitionBy("shard").orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).cast("long").alias("seats"))
    # A source can win at most all copies of its blocks; each possible seat has its quotient.
    quotients = seated.select("source", "shard", "votes", "blocks", "seats", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") * repeats - 1)).alias("seat"))
    best = Window.partitionBy("shard").orderBy((F.col("votes") / (2 * F.col("seat") + 1)).desc(), F.col("source").asc_nulls_last(), "seat")
    won = quotients.select("*", F.row_number().over(best).alias("rank")).where("rank <= seats").groupBy("source", "shard").agg(F.count(F.lit(1)).alias("quota"))
    quota = voted.join(won.withColumnsRenamed({"source": "_source", "shard": "_shard"}), F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")), "left")
    every = quota.select("source", "shard", "blocks", F.coalesce("quota", F.lit(0)).alias("quota"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    seeded = Window.partitionBy("source", "shard").orderBy(draw(f"{seed}-block", F.col("source"), F.col("shard"), F.col("block")), "block")
    copies = F.expr("quota div blocks") + (F.row_number().over(seeded) <= F.expr("quota % blocks")).cast("long")
    earlier = Window.partitionBy("source", "shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return every.select("source", "shard", "block", copies.alias("copies")).select(
        "source", "shard", "block", "copies", (F.coalesce(F.sum("copies").over(earlier), F.lit(0)) * block).alias("before")
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with their own columns, each a whole number of times.

    The copies of a source follow its running sum of ``taken / size``: a document gets the difference of the rounded
    sums behind and before it, so what rounding leaves of one document goes to the next. The sum runs by size, which
    keeps the words of a source within about one document of what the mix takes. A document is told by id, source and
    text; rows equal in all three share their copies evenly.
    """
    key, text, source, seed = (options.get(n, d) for n, d in (("key", "doc_id"), ("text", "text"), ("source", "source"), ("seed", "mix")))
    named = docs.withColumns({"_source": F.col(f"`{source}`"), "_mark": mark_of(F.col(f"`{text}`"))})
    mixed = mix(named, **{**options, "keep": ("_source", "_mark")}).where("size > 0")
    units = mixed.groupBy("doc_id", "_source", "_mark").agg(F.first("size").alias("size"), F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("rows"))
    units = cut_lineage(units, "units")
    # Copies in whole numbers of 2^-30, so that sums do not depend on their order.
    shared = F.expr(f"(taken * {ONE} + size div 2) div size")
    digits = draw(f"{seed}-copies", F.col("doc_id"), F.col("_mark"))
    parts = max(SHARDS, -(-units.count() // ROWS))
    # Windows of a source are its size classes, four to a doubling, in parts.
    placed = units.select(
        "doc_id", "_source", "_mark", "size", "rows", shared.alias("share"), digits.alias("draw"), F.floor(4 * F.log2("size")).cast("int").alias("class"),
        F.pmod(F.conv(F.substring(digits, 1, 8), 16, 10).cast("long"), F.lit(parts)).cast("int").alias("part"),
    )
    earlier = Window.partitionBy("_source").orderBy("class", "part").rowsBetween(Window.unboundedPreceding, -1)
    cells = placed.groupBy("_source", "class", "part").agg(F.sum("share").alias("share"))
    cells = cells.select(F.col("_source").alias("_cell"), F.col("class").alias("_class"), F.col("part").alias("_part"), F.coalesce(F.sum("share").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("_source", "class", "part").orderBy("size", "draw", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.select("*", F.sum("share").over(inside).alias("upto"))
    on = F.col("_source").eqNullSafe(F.col("_cell")) & (F.col("class") == F.col("_class")) & (F.col("part") == F.col("_part"))
    copies = F.expr(f"(before + upto + {ONE // 2}) div {ONE} - (before + upto - share + {ONE // 2}) div {ONE}")
    taken = summed.join(cells, on).select(
        F.col("doc_id").alias("_taken"), F.col("_source").alias("_from"), F.col("_mark").alias("_told"), "rows", copies.alias("copies")
    ).where("copies > 0").select("_taken", "_from", "_told", F.col("rows").alias("_rows"), F.col("copies").alias("_copies"))
    own = [F.col(f"`{c}`").alias(f"_own{k}") for k, c in enumerate(docs.columns)]
    rows = docs.select(*own, F.col(f"`{key}`").alias("_id"), F.col(f"`{source}`").alias("_of"), mark_of(F.col(f"`{text}`")).alias("_text"))
    joined = rows.join(taken, F.col("_id").eqNullSafe(F.col("_taken")) & F.col("_of").eqNullSafe(F.col("_from")) & (F.col("_text") == F.col("_told")))
    # The copies of equal rows, one after another.
    numbered = joined.select("*", F.row_number().over(Window.partitionBy("_id", "_of", "_text").orderBy("_id")).cast("long").alias("_nth"))
    repeated = numbered.select("*", F.expr("_copies * _nth div _rows - _copies * (_nth - 1) div _rows").cast("int").alias("_times")).where("_times > 0")
    return repeated.select(*own_back(docs.columns), F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy")).select(*[F.col(f"`{c}`") for c in docs.columns])


def own_back(columns: list[str]) -> list[Column]:
    return [F.col(f"_own{k}").alias(c) for k, c in enumerate(columns)]


def oracle(weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeats: int = 2, seed: str = "mix") -> str:
    """The query over ``documents`` in DuckDB SQL, blocks written out word range by word range."""
    weight = " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(weights))
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(text, '')) AS mark FROM documents),
totals AS (SELECT greatest({SHARDS}, CAST(ceil(count(*) / {float(ROWS)}) AS BIGINT)) AS shards, coalesce(CAST(sum(size) AS BIGINT), 0) AS words FROM sized),
setting AS (SELECT shards, greatest(1, words // (shards * {BLOCKS})) AS block FROM totals),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {weight} END AS DOUBLE) AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS place, CAST(source_size * {repeats} AS DOUBLE) AS lim FROM per_source),
ranked AS (
  SELECT *, (CAST((SELECT sum(source_size) FROM per_source) AS DOUBLE) * CAST({share} AS DOUBLE)
      - coalesce(sum(lim) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
final AS (SELECT arg_min(level, (lim / weight, place)) AS final FROM ranked WHERE lim > level * weight),
aimed AS (SELECT source, source_size, coalesce(least(lim, final * weight), lim) AS target FROM ranked CROSS JOIN (SELECT (SELECT final FROM final) AS final)),
drawn AS (SELECT s.*, md5('{seed}|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || mark) AS draw FROM sized s),
placed AS (SELECT d.*, CAST(('0x' || substr(draw, 1, 8)) AS BIGINT) % shards AS shard FROM drawn d CROSS JOIN setting),
laid AS (
  SELECT *, CAST(sum(size) OVER w AS BIGINT) - size AS lo, CAST(sum(size) OVER w AS BIGINT) AS hi FROM placed
  WINDOW w AS (PARTITION BY source, shard ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING)),
cells AS (
  SELECT source, shard, (sum(size) + any_value(block) - 1) // any_value(block) AS blocks
  FROM placed CROSS JOIN setting GROUP BY source, shard HAVING sum(size) > 0),
voted AS (
  SELECT c.source, c.shard, CAST(blocks AS BIGINT) AS blocks, target * CAST(blocks AS BIGINT) / source_size AS votes FROM cells c JOIN aimed a ON c.source IS NOT DISTINCT FROM a.source),
seated AS (SELECT shard, CAST(round(sum(votes ORDER BY source NULLS LAST)) AS BIGINT) AS seats FROM voted GROUP BY shard),
quotients AS (SELECT *, unnest(range(0, blocks * {repeats})) AS seat FROM voted),
won AS (
  SELECT source, shard, count(*) AS quota FROM (
    SELECT q.*, s.seats, row_number() OVER (PARTITION BY q.shard ORDER BY votes / (2 * seat + 1) DESC, source NULLS LAST, seat) AS rank
    FROM quotients q JOIN seated s USING (shard)) WHERE rank <= seats GROUP BY source, shard),
every AS (
  SELECT v.source, v.shard, blocks, coalesce(quota, 0) AS quota, unnest(range(0, blocks)) AS number
  FROM voted v LEFT JOIN won w ON v.source IS NOT DISTINCT FROM w.source AND v.shard = w.shard),
chosen AS (
  SELECT source, shard, number, quota // blocks + CASE WHEN row_number() OVER (
      PARTITION BY source, shard ORDER BY md5('{seed}-block|' || coalesce(source, 'null') || '|' || shard || '|' || number), number) <= quota % blocks THEN 1 ELSE 0 END AS copies
  FROM every),
parts AS (
  SELECT l.*, unnest(range(lo // block, (hi - 1) // block + 1)) AS number, block FROM laid l CROSS JOIN setting WHERE size > 0),
took AS (
  SELECT doc_id, source, draw, size, lo, sum(copies * (least(hi, (p.number + 1) * block) - greatest(lo, p.number * block))) AS taken
  FROM (SELECT p.*, c.copies FROM parts p JOIN chosen c ON p.source IS NOT DISTINCT FROM c.source AND p.shard = c.shard AND p.number = c.number) p
  GROUP BY doc_id, source, draw, size, lo, shard)
SELECT l.doc_id, l.size, a.source_size, round(a.target, 6) AS target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM laid l JOIN aimed a ON l.source IS NOT DISTINCT FROM a.source
LEFT JOIN took t ON l.doc_id IS NOT DISTINCT FROM t.doc_id AND l.source IS NOT DISTINCT FROM t.source AND l.lo = t.lo AND l.size = t.size"""
