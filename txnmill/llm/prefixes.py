"""Prefix trie of conversations: every distinct sequence of first turns is a node, found by ROLLUP.

Method: a turn's id is a digest of role and text. A conversation is cut into blocks of ``WIDTH`` turns, one row each
with ``WIDTH`` positional id columns. One ``ROLLUP`` over these columns makes all prefixes of all blocks at once, with
``grouping_id`` telling the depth. A further block is keyed by the node that the prior block ends in, so its prefixes
hang below that node; that key is the exclusive-or of one 128-bit hash per (position, turn) of all earlier turns, so it
needs no round per block and a conversation may be of any length.

Figures of a subtree come without walking it. The member with the smallest id owns a node, and with it all deeper nodes
of its own path, so each member ``m`` owns its path from one depth ``o(m)`` on and nothing above. Then, over the members
of a node at depth ``d``: leaves are the owned path ends without children, and the saved characters are the sum, for
members that do not own the node, of the characters of their turns from depth ``d`` to ``o(m) - 1``. Both are
sums of a second ROLLUP. Parents are found by their key, dealt over salts.

Hot groups: a common prefix is pre-aggregated before the shuffle; turns are numbered inside range partitions with one
offset per partition; running values use slices of 512 blocks; the ids of a node with many ends are put in
order as strings of bounded length, and one digest runs over the strings.

Edge cases: rows without a conversation id belong to no conversation. A null role or text is empty, a null turn number
comes first, equal numbers are ordered by the digest of the turn. Repeated rows are turns of their own. A conversation
without turns after its rebuilding ends at the root. An empty table gives an empty result. Further columns play no part.
Texts and nodes are compared by 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnmill.session import cut_lineage

from .skew import SALTS, salted_join

#: Turns of a block, and blocks of a slice.
WIDTH, SLICE = 8, 512
#: Bytes of joined ids in one row.
STRING = 1 << 18


def numbered(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, pos, t, chars``: the turns of each conversation, from 1, with their digest and length."""
    who, said = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    digest = F.unhex(F.md5(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said).cast("binary")))
    rows = turns.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), digest.alias("t"), F.char_length(said).cast("long").alias("chars")
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "t"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column("conv").to_numpy()
            if not len(conv):
                continue
            begins = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            place = np.arange(len(conv)) - np.repeat(begins, np.diff(np.append(begins, len(conv)))) + 1
            if conv[0] == last:
                place[: begins[1] if len(begins) > 1 else len(conv)] += count
            last, count = conv[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array(np.full(len(conv), part, np.int32)), pa.array(place), batch.column("t"), batch.column("chars")],
                names=["conv", "part", "place", "t", "chars"],
            )

    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(sorted_.mapInArrow(run, "conv long, part int, place long, t binary, chars long"), "placed")
    # A range border splits at most one conversation, so there are at most as many offsets as partitions.
    counts = placed.groupBy("conv", "part").agg(F.max("place").alias("n"))
    split = counts.groupBy("conv").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("conv")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.join(split, "conv").select("conv", "part", F.sum("n").over(before).alias("before"))
    return placed.join(F.broadcast(offsets), ["conv", "part"], "left").select("conv", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "t", "chars")


def rebuilt(own: DataFrame, century: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(conversations ``conv``, their turns): the first ``h`` turns of the conversation of the century, then the own
    turns after the first ``h``, where ``h`` is the checksum of the id modulo ``most``."""
    convs = own.select("conv").distinct().withColumns({
        "base": F.col("conv") - F.col("conv") % century,
        "h": F.crc32(F.col("conv").cast("string").cast("binary")) % most,
    })
    heads = own.where((F.col("conv") % century == 0) & (F.col("pos") < most)).select(F.col("conv").alias("base"), "pos", "t", "chars")
    lengths = heads.groupBy("base").agg(F.count(F.lit(1)).alias("there"))
    convs = convs.join(lengths, "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken"))
    convs = cut_lineage(convs, "convs")
    first = convs.join(heads, "base").where("pos <= h").select("conv", "pos", "t", "chars")
    rest = salted_join(own, convs.select("conv", "h", "taken"), ["conv"], ["pos"], "inner").where("pos > h")
    return convs.select("conv"), first.union(rest.select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "t", "chars"))


def turn_hash(pos: Column, t: Column, lane: int) -> Column:
    return F.xxhash64(F.lit(lane), pos.cast("long"), t)


def blocks(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """``conv, block, k0, k1, before, turns, last``: rows of ``WIDTH`` turns, with the key of the prior node and the
    characters before them. Every conversation has block 0, if with no turns. ``last`` marks where it ends."""
    made = F.struct("pos", "t", "chars", turn_hash(F.col("pos"), F.col("t"), 0).alias("h0"), turn_hash(F.col("pos"), F.col("t"), 1).alias("h1"))
    cut = turns.groupBy("conv", F.floor((F.col("pos") - 1) / WIDTH).alias("block")).agg(
        F.sort_array(F.collect_list(made)).alias("turns"),
        F.bit_xor(turn_hash(F.col("pos"), F.col("t"), 0)).alias("x0"),
        F.bit_xor(turn_hash(F.col("pos"), F.col("t"), 1)).alias("x1"),
        F.sum("chars").alias("size"),
    )
    cut = cut_lineage(cut.withColumn("slice", F.floor(F.col("block") / SLICE)), "blocks")
    whole = cut.groupBy("conv", "slice").agg(F.bit_xor("x0").alias("x0"), F.bit_xor("x1").alias("x1"), F.sum("size").alias("size"), F.max("block").alias("top"))
    every = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    earlier = {"s0": F.bit_xor("x0"), "s1": F.bit_xor("x1"), "s": F.sum("size")}
    slices = whole.select("conv", "slice", *[f.over(every).alias(n) for n, f in earlier.items()], F.max("top").over(Window.partitionBy("conv")).alias("top"))
    inside = Window.partitionBy("conv", "slice").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    run = cut.select("*", F.bit_xor("x0").over(inside).alias("r0"), F.bit_xor("x1").over(inside).alias("r1"), F.sum("size").over(inside).alias("r"))
    zero = F.lit(0).cast("long")

    def both(a: str, b: str) -> Column:
        return F.coalesce(F.col(a), zero).bitwiseXOR(F.coalesce(F.col(b), zero))

    full = run.join(slices, ["conv", "slice"]).select(
        "conv", "block", both("s0", "r0").alias("k0"), both("s1", "r1").alias("k1"), (F.coalesce("s", zero) + F.coalesce("r", zero)).alias("before"), "turns", (F.col("block") == F.col("top")).alias("last")
    )
    none = convs.join(whole.select("conv").distinct(), "conv", "left_anti").select("conv", zero.alias("block"), zero.alias("k0"), zero.alias("k1"), zero.alias("before"), F.lit(None).cast(full.schema["turns"].dataType).alias("turns"), F.lit(True).alias("last"))
    return cut_lineage(full.union(none), "rows")


def rolled(rows: DataFrame, sums: dict[str, Column], each: dict[str, tuple[str, Column]]) -> DataFrame:
    """The nodes of all blocks. ``sums`` are summed over a node's members; ``each`` gives, by name, an aggregate and the
    array of its ``WIDTH + 1`` values by depth, of which that of the node's depth is returned."""
    t = [f"t{i}" for i in range(1, WIDTH + 1)]
    wide = rows.select(
        "conv", "block", "k0", "k1", "ends",
        *[F.get("turns", F.lit(i))["t"].alias(c) for i, c in enumerate(t)],
        *[c.alias(n) for n, c in sums.items()],
        *[F.get(c, F.lit(d)).alias(f"{n}_{d}") for n, (_, c) in each.items() for d in range(WIDTH + 1)],
    )
    ends = [f"sum(CASE WHEN ends = {d} THEN 1 ELSE 0 END) AS ends_{d}" for d in range(WIDTH + 1)]
    aggregates = [*ends, *[f"sum({n}) AS {n}" for n in sums], *[f"{f}({n}_{d}) AS {n}_{d}" for n, (f, _) in each.items() for d in range(WIDTH + 1)]]
    nodes = rows.sparkSession.sql(
        f"""SELECT block, k0, k1, {", ".join(t)}, {WIDTH} - bit_count(grouping_id()) AS d, count(1) AS n_convs, min(conv) AS conv_id, {", ".join(aggregates)}
        FROM {{wide}} GROUP BY block, k0, k1, ROLLUP({", ".join(t)})""",
        wide=wide,
    )
    # Groups of shorter conversations are no nodes, and the head of a further block is the prior block's node.
    depth = F.col("block") * WIDTH + F.col("d")
    real = nodes.where("CASE d " + " ".join(f"WHEN {d} THEN t{d} IS NOT NULL" for d in range(1, WIDTH + 1)) + " ELSE block = 0 END")

    def key(lane: int, upto: Column) -> Column:
        out = F.col(f"k{lane}")
        for i, c in enumerate(t):
            h = turn_hash(F.col("block") * WIDTH + i + 1, F.col(c), lane)
            out = out.bitwiseXOR(F.when(upto > i, h).otherwise(F.lit(0).cast("long")))
        return out

    def at_depth(name: str) -> Column:
        return F.expr("CASE d " + " ".join(f"WHEN {d} THEN {name}_{d}" for d in range(WIDTH + 1)) + " END").alias(name)

    up = F.col("d") - 1
    return real.select(
        depth.alias("depth"), "conv_id", "n_convs", *sums, at_depth("ends"), *[at_depth(n) for n in each],
        *[key(lane, F.col("d")).alias(f"n{lane}") for lane in (0, 1)],
        *[F.when(F.col("d") > 0, key(lane, up)).alias(f"p{lane}") for lane in (0, 1)],
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """``n0, n1, ends_sha256``: digest of the ascending ids (``conv``) of each key, joined by commas."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, held, size = None, None, [], 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([first]), pa.array([",".join(held)])], names=["n0", "n1", "first", "ids"])

        for batch in batches:
            for a, b, conv in zip(*(batch.column(c).to_pylist() for c in ("n0", "n1", "conv")), strict=True):
                if (a, b) != key or size >= STRING:
                    if held:
                        yield made()
                    key, first, held, size = (a, b), conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield made()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None

        def made(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], names=["n0", "n1", "ends_sha256"])

        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("n0", "n1", "ids")), strict=True):
                if (a, b) == key:
                    running.update(b"," + ids.encode())
                    continue
                if key:
                    done.append((*key, running.hexdigest()))
                key, running = (a, b), hashlib.sha256(ids.encode())
            if done:
                yield made(done)
        if key:
            yield made([(*key, running.hexdigest())])

    joined = ends.repartitionByRange("n0", "n1", "conv").sortWithinPartitions("n0", "n1", "conv").mapInArrow(strings, "n0 long, n1 long, first long, ids string")
    return joined.repartition("n0", "n1").sortWithinPartitions("n0", "n1", "first").mapInArrow(digests, "n0 long, n1 long, ends_sha256 string")


def trie(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node of the rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``, and ``n_ends``, the members that end there."""
    rows = blocks(*rebuilt(numbered(turns, key, turn, role, text)))
    zero = F.lit(0).cast("long")
    size = F.coalesce(F.size("turns"), F.lit(0))
    size = F.when(size < 0, 0).otherwise(size)
    # Characters before the turn of each depth of the block; of depth 0, before the root.
    none = F.array().cast(rows.schema["turns"].dataType)
    lengths = F.transform(F.coalesce("turns", none), lambda x: x["chars"])
    ahead = F.concat(F.array(F.col("before"), F.col("before")), F.transform(F.sequence(F.lit(1), F.lit(WIDTH - 1)), lambda i: F.col("before") + F.aggregate(F.slice(lengths, 1, i), zero, lambda a, b: a + b)))
    rows = rows.select("conv", "block", "k0", "k1", "turns", ahead.alias("ahead"), size.alias("size"), F.when(F.col("last"), size).alias("ends"), (F.col("before") + F.aggregate(lengths, zero, lambda a, b: a + b)).alias("total"))

    owned = rolled(rows, {}, {"ahead": ("min", F.col("ahead"))})
    owners = owned.groupBy(F.col("conv_id").alias("conv")).agg(
        F.min(F.struct("depth", "ahead")).alias("top"), F.max(F.struct("depth", (F.col("ends") == F.col("n_convs")).alias("leaf"))).alias("end")
    ).select("conv", F.col("top")["depth"].alias("own"), F.col("top")["ahead"].alias("reach"), F.col("end")["leaf"].cast("long").alias("leaf"))

    def key_of_end(lane: int) -> Column:
        of_turn = F.transform(F.coalesce("turns", none), lambda x: x[f"h{lane}"])
        return F.aggregate(of_turn, F.col(f"k{lane}"), lambda a, h: a.bitwiseXOR(h)).alias(f"n{lane}")

    ends = cut_lineage(rows.where("ends IS NOT NULL").select("conv", "total", key_of_end(0), key_of_end(1)), "ends")
    info = ends.join(owners, "conv", "left").select("conv", "own", F.coalesce("reach", "total").alias("reach"), F.coalesce("leaf", zero).alias("leaf"))

    known = salted_join(rows, cut_lineage(info, "owners"), ["conv"], ["block"], "inner")
    # What a member adds to the node at each depth, unless it owns it.
    saved = F.transform("ahead", lambda a, d: F.when(F.col("own").isNull() | (F.col("own") > F.col("block") * WIDTH + d), F.col("reach") - a).otherwise(zero))
    nodes = cut_lineage(rolled(known, {"leaf": F.col("leaf")}, {"saved": ("sum", saved)}), "nodes")

    dealt = nodes.withColumn("salt", F.pmod(F.col("n0"), F.lit(SALTS)))
    met = cut_lineage(dealt.where("depth > 0").groupBy("p0", "p1", "salt").agg(F.count(F.lit(1)).alias("n")), "children")
    children = met.groupBy(F.col("p0").alias("n0"), F.col("p1").alias("n1")).agg(F.sum("n").alias("n_children"))
    parents = met.select("p0", "p1", "salt").join(nodes.select(F.col("n0").alias("p0"), F.col("n1").alias("p1"), F.col("conv_id").alias("parent_conv_id")), ["p0", "p1"])
    out = dealt.join(parents, ["p0", "p1", "salt"], "left").join(children, ["n0", "n1"], "left").join(end_digests(ends.select("n0", "n1", "conv")), ["n0", "n1"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), F.col("ends").alias("n_ends"),
    )


def oracle(century: int = 100, most: int = 6) -> str:
    """The query over ``conversations`` in DuckDB SQL, by lists of turns."""
    digest = "md5(length(role) || ':' || role || text)"
    # The checksum's table by its rule, then byte by byte over the decimal id.
    table = "list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"
    checksum = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, v[(xor(c, b) & 255) + 1])), 4294967295)"
    return f"""
WITH codes AS (SELECT {table} AS v),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, {digest}) AS turns
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
marked AS (SELECT conv_id, turns, conv_id - conv_id % {century} AS base, {checksum} % {most} AS h FROM own, codes),
built AS (SELECT m.conv_id, list_concat(coalesce(b.turns[:m.h], []), m.turns[m.h + 1:]) AS turns FROM marked m LEFT JOIN own b ON m.base = b.conv_id),
members AS (SELECT conv_id, d, turns[:d] AS path, len(turns) AS n FROM built, unnest(range(0, len(turns) + 1)) AS u(d)),
nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '') AS ends
  FROM members GROUP BY path, d),
children AS (SELECT path[:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
joined AS (SELECT x.*, coalesce(c.n, 0) AS n_children FROM nodes x LEFT JOIN children c ON x.path = c.path),
below AS (
  SELECT path[:k] AS path, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
         CAST(sum(CASE WHEN d > 0 THEN (n_convs - 1) * length(path[d].text) ELSE 0 END) AS BIGINT) AS saved_tokens
  FROM joined, unnest(range(0, d + 1)) AS u(k) GROUP BY 1)
SELECT j.conv_id, j.d AS depth, p.conv_id AS parent_conv_id, j.n_convs, j.n_children, b.n_leaves, b.saved_tokens, sha256(j.ends) AS ends_sha256,
       CASE WHEN j.ends = '' THEN 0 ELSE len(string_split(j.ends, ',')) END AS n_ends
FROM joined j JOIN below b ON j.path = b.path LEFT JOIN nodes p ON j.d > 0 AND p.d = j.d - 1 AND p.path = j.path[:j.d - 1]"""
