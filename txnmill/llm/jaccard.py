"""N-gram Jaccard self-join: documents whose sets of word shingles overlap by a given percentage, and their groups.

Method: prefix filtering with token combinations. Shingles have a global order, rare ones first. For a set of ``n``
shingles any partner shares ``ceil(n * percent / 100)`` of them, so at most ``n - ceil(...)`` are not shared. A
prefix is extended until its coverage exceeds that number, where a class of single tokens covers one per token and a
class indexed by ``k``-token combinations covers ``tokens - k + 1``. Of two linked sets, the one whose prefix ends
first shares ``k`` tokens of some class with the other, inside both prefixes, so both emit that combination. Rare
shingles are indexed alone, frequent ones by pairs, very frequent ones by triples. To keep combinations few, a
frequent class is dealt into subclasses by hash; their number depends on the size bracket of the larger partner, and
a set emits for each bracket that a partner can have.

The classes come from counts of shingles within slices of the input, of which shingles seen once in a slice are left
out. They plan the work; no result depends on them. The list of frequent shingles that tasks get is bounded by
``listed``: the frequency from which a shingle is listed rises until the list fits.

Sets with equal shingles are one node from the start (a 64-bit digest). Candidates are verified exactly, in an order
that needs no pairs within a large group of near copies. The leader of a signature is the member whose own signatures
are shared most, which among near copies is the one closest to their origin.

1. Every set is compared with the leader it shares most signatures with; components of these links follow.
2. Signatures that still span components: every member is compared with a pivot set, the leader's shingles and all
   that are listed about as often as the leader has members. This gives its overlap with the pivot and the shingles it
   has besides; among near copies those are its own edits.
3. Two such members of sizes ``m`` and ``n`` need an overlap ``t``. Either both overlap the pivot by ``t``, or they share
   shingles that the pivot lacks; those are indexed by a prefix again. The pairs found, from different components, are
   compared. All other pairs are ruled out by the overlaps with the pivot alone.

Edge cases: a text with fewer words than a shingle is one shingle of all its words; a null, empty or blank text has
an empty set, is linked with nothing and is its own component. Rows with equal ids are rows of their own. A null id
is never a component's id while the component has another; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnmill.session import cut_lineage

from . import words as W
from .components import components

SHINGLE = 5
PERCENT = 80
#: Shingles listed as frequent, at most.
LISTED = 1 << 20
#: Combination size by document frequency: alone below the first bound, pairs below the second, then triples.
PAIRS_FROM, TRIPLES_FROM = 64, 4096
#: Sets below this size use single tokens only; larger ones have a subclass for each so many shingles.
SMALL, PER_SUBCLASS = 32, 32
#: Tokens counted together in a task, and tasks' salts of a combination.
SLICE, SALTS = 1 << 22, 64


def least_overlap(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` that any partner must share."""
    return -(-n * percent // 100)


def fingerprint(tokens: np.ndarray) -> int:
    """Signed 64-bit digest of a sorted set."""
    with np.errstate(over="ignore"):
        at = np.arange(1, len(tokens) + 1, dtype=np.uint64)
        total = W.mix(tokens ^ W.mix(at)).sum(dtype=np.uint64) + np.uint64(len(tokens)) * W.BASE
        return int(W.mix(np.array([total]))[0].view(np.int64))


def _sets(batch: pa.RecordBatch, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    for low, _, offsets, data in W.chunks(batch.column("text")):
        for d, tokens in enumerate(W.shingle_sets(W.find(offsets, data, lower=True), shingle)):
            yield low + d, tokens


def _counted(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that occur twice or more, with their counts."""
    every = np.sort(np.concatenate(tokens))
    starts = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    counts = np.diff(np.append(starts, len(every)))
    often = counts > 1
    return every[starts[often]], counts[often]


def digests(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One pass over ``doc_id, text`` and any ``long`` columns: rows (doc_id, n, fp, and those) per document, and rows
    (token, df) of counted slices."""
    more = [c for c in docs.columns if c not in ("doc_id", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("fp", pa.int64()), ("token", pa.int64()), ("df", pa.int64()), *((c, pa.int64()) for c in more)])
        held, size, seen = [], 0, set()

        def counts() -> pa.RecordBatch:
            tokens, df = _counted(held)
            none = pa.nulls(len(tokens), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, pa.array(tokens.view(np.int64)), pa.array(df), *[none] * len(more)], schema=schema)

        for batch in batches:
            n, fp = [], []
            for _, tokens in _sets(batch, shingle):
                n.append(len(tokens))
                fp.append(fingerprint(tokens) if len(tokens) else None)
                if len(tokens) and fp[-1] not in seen:
                    seen.add(fp[-1])
                    held.append(tokens)
                    size += len(tokens)
                    if size >= SLICE:
                        yield counts()
                        held, size, seen = [], 0, set()
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(fp, pa.int64()), none, none, *(batch.column(c) for c in more)], schema=schema)
        if held:
            yield counts()

    return docs.mapInArrow(run, "doc_id long, n long, fp long, token long, df long" + "".join(f", {c} long" for c in more))


def frequent(counts: DataFrame, listed: int = LISTED) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens, at most ``listed``, sorted; and log2 of their document frequency."""
    summed = cut_lineage(counts.groupBy("token").agg(F.floor(F.log2(F.sum("df"))).cast("int").alias("band")), "frequent")
    sizes = {r["band"]: r["count"] for r in summed.groupBy("band").count().collect()}
    least, total = 64, 0
    for band in sorted(sizes, reverse=True):
        total += sizes[band]
        if total > listed:
            break
        least = band
    table = summed.where(F.col("band") >= least).toArrow()
    tokens = table["token"].to_numpy().astype(np.int64).view(np.uint64)
    bands = table["band"].to_numpy().astype(np.uint8)
    order = np.argsort(tokens)
    return tokens[order], bands[order]


class Bands:
    """Band of each token: 0 if it is not listed."""

    def __init__(self, tokens: np.ndarray, bands: np.ndarray):
        self.tokens, self.bands = tokens, bands
        # Most tokens are not listed; one bit per hash prefix tells so without a search.
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[tokens >> np.uint64(42)] = True

    def of(self, tokens: np.ndarray) -> np.ndarray:
        out = np.zeros(len(tokens), np.uint8)
        at = np.flatnonzero(self.maybe[tokens >> np.uint64(42)])
        if len(at):
            place = np.searchsorted(self.tokens, tokens[at])
            place[place == len(self.tokens)] = 0
            same = self.tokens[place] == tokens[at]
            out[at[same]] = self.bands[place[same]]
        return out


def choices(n: int, k: int) -> np.ndarray:
    """All ways to take 2 or 3 of ``n`` places, one per row."""
    a, b = np.triu_indices(n, 1)
    if k == 2:
        return np.stack([a, b], 1)
    c = np.repeat(np.arange(n)[None], len(b), 0)
    pair, third = np.nonzero(c > b[:, None])
    return np.stack([a[pair], b[pair], third], 1)


def signatures(tokens: np.ndarray, bands: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of one set (sorted tokens and their bands): those of single tokens, and those of combinations."""
    n = len(tokens)
    need = n - least_overlap(n, percent) + 1
    order = np.argsort(bands, kind="stable")
    many = np.where(bands >= TRIPLES_FROM.bit_length() - 1, 3, np.where(bands >= PAIRS_FROM.bit_length() - 1, 2, 1))
    tokens, many = tokens[order], many[order]
    if many[need - 1] == 1:
        return tokens[:need], tokens[:0]
    single, combined = [], []
    for bracket in range(n.bit_length(), (n * 100 // percent).bit_length() + 1):
        if 1 << bracket <= SMALL:
            single.append(tokens[:need])
            continue
        subclasses = np.uint64(max(1, (1 << bracket) // PER_SUBCLASS))
        group = np.where(many == 1, 0, (tokens >> np.uint64(8)) % subclasses * np.uint64(4) + many.astype(np.uint64)).astype(np.int64)
        # Place of each token within its group, in the global order.
        by_group = np.argsort(group, kind="stable")
        sorted_group = group[by_group]
        begins = np.flatnonzero(np.append(True, sorted_group[1:] != sorted_group[:-1]))
        place = np.empty(n, np.int64)
        place[by_group] = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
        covers = np.cumsum(place + 1 >= many)
        end = int(np.searchsorted(covers, need)) + 1
        alone = many[:end] == 1
        single.append(tokens[:end][alone])
        rest, groups = tokens[:end][~alone], group[:end][~alone]
        by_group = np.argsort(groups, kind="stable")
        rest, groups = rest[by_group], groups[by_group]
        cuts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])) if len(groups) else groups
        for a, b in zip(cuts.tolist(), [*cuts.tolist()[1:], len(groups)], strict=True):
            k = int(groups[a]) & 3
            if b - a >= k:
                members = np.sort(rest[a:b])
                chosen = members[choices(b - a, k)]
                combined.append(W.mix(W.rolling(chosen.ravel(), k)[::k] + np.uint64(k)))
    return tuple(np.unique(np.concatenate(x)) if x else tokens[:0] for x in (single, combined))


def index(docs: DataFrame, listed: tuple[np.ndarray, np.ndarray], shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(sig, salt, fp, n): the signatures of each set and its size; salt is -1 for single tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("sig", pa.int64()), ("salt", pa.int32()), ("fp", pa.int64()), ("n", pa.int64())])
        bands, seen = Bands(*shared.value), set()
        for batch in batches:
            sigs, rows, sizes, held = [], [], [], 0

            def made() -> pa.RecordBatch:
                salt, fp, n = (np.repeat(np.array(c, np.int64), sizes) for c in zip(*rows, strict=True))
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(fp), pa.array(n)], schema=schema)

            for _, tokens in _sets(batch, shingle):
                if not len(tokens) or (fp := fingerprint(tokens)) in seen:
                    continue
                seen.add(fp)
                for salt, found in zip((-1, fp % SALTS), signatures(tokens, bands.of(tokens), percent), strict=True):
                    if len(found):
                        sigs.append(found)
                        rows.append((salt, fp, len(tokens)))
                        sizes.append(len(found))
                        held += len(found)
                if held >= 1 << 18:
                    yield made()
                    sigs, rows, sizes, held = [], [], [], 0
            if sigs:
                yield made()

    return docs.select("text").mapInArrow(run, "sig long, salt int, fp long, n long")


def live_rows(signed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(sig, fp, score): signatures that several sets share, of sets that may be linked.

    A set indexed by single tokens only shares at least ``t - max(m - p, n - p')`` of them with a partner, where ``t``
    is the overlap that their sizes need and ``p`` the length of a prefix. If no size of other members occurs so often
    among its signatures, it has no partner.

    The score tells how well shared the set's signatures are; of near copies, the one closest to their common origin
    has the highest.
    """
    inside = Window.partitionBy("sig", "salt")
    shared = signed.select("*", F.min("fp").over(inside).alias("lo"), F.max("fp").over(inside).alias("hi"), F.count(F.lit(1)).over(inside).alias("size"))
    # The members of a combination are spread over salts, so a lone one may have partners elsewhere.
    live = cut_lineage(shared.where("salt >= 0 or lo != hi").select("sig", "salt", "fp", "n", "size").distinct(), "live")

    single = live.where("salt < 0").select("sig", "fp", "n")
    sizes = single.groupBy("sig", F.col("n").alias("other")).agg(F.count(F.lit(1)).alias("k"))
    met = single.join(sizes, "sig").where(f"(n != other or k > 1) and 100 * least(n, other) >= {percent} * greatest(n, other)")
    least = f"({percent} * (n + other) + {99 + percent}) div {100 + percent} - (greatest(n, other) * {percent} + 99) div 100 + 1"
    often = met.groupBy("fp", "n", "other").agg(F.count(F.lit(1)).alias("c")).where(f"c >= {least}").select("fp")
    kept = often.union(live.where("salt >= 0").select("fp")).distinct()
    live = cut_lineage(live.join(kept, "fp", "left_semi").select("sig", "fp", "size"), "kept")
    several = live.groupBy("sig").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo != hi").select("sig")
    live = live.join(several, "sig")
    score = live.groupBy("fp").agg(F.sum("size").alias("score"))
    return cut_lineage(live.select("sig", "fp").join(score, "fp"), "scored")


def spanning(live: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of ``live`` with their components, for signatures whose members are not all in one."""
    member = live.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("sig", "fp", "score", F.coalesce("root", "fp").alias("root"))
    member = cut_lineage(member, "members")
    open_ = member.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("sig")
    return cut_lineage(member.join(open_, "sig"), "spanning")


def led(rows: DataFrame) -> DataFrame:
    """(a, b, n): each member ``b`` of a signature with the leader ``a``, and how many signatures they share."""
    leaders = rows.groupBy("sig").agg(F.max(F.struct("score", "fp")).alias("best")).select("sig", F.col("best")["fp"].alias("a"))
    return rows.join(leaders, "sig").where("fp != a").groupBy("a", F.col("fp").alias("b")).agg(F.count(F.lit(1)).alias("n"))


def texts_of(docs: DataFrame, needed: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(fp, packed): one compressed text for each needed set. Ids play no part: they can be null or repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, seen = zstandard.ZstdCompressor(level=3), set()
        for batch in batches:
            texts, fps, packed = batch.column("text"), [], []
            for d, tokens in _sets(batch, shingle):
                if len(tokens) and (fp := fingerprint(tokens)) not in seen:
                    seen.add(fp)
                    fps.append(fp)
                    packed.append(pack.compress(texts[d].as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(packed, pa.binary())], names=["fp", "packed"])

    return docs.select("text").mapInArrow(run, "fp long, packed binary").join(needed, "fp", "left_semi").dropDuplicates(["fp"])


PAIR = "a long, b long, same long, m long, n long, pivot long, rest array<long>"


def compared(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int, listed: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Pairs with their overlap ``same`` and sizes ``m`` and ``n``. With ``listed``, also the overlap of ``b`` with the
    ``pivot``, which is ``a`` and all shingles of the band ``from`` or above, and ``rest``: those shingles of ``b`` that
    the pivot lacks, as far as a partner of ``b`` must share one of them."""
    shared = pairs.sparkSession.sparkContext.broadcast(listed) if listed else None

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        unpack = zstandard.ZstdDecompressor()
        for packed in column:
            text = np.frombuffer(unpack.decompress(packed.as_buffer()), np.uint8)
            yield next(W.shingle_sets(W.find(np.array([0, len(text)]), text, lower=True), shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(*shared.value) if shared else None
        for batch in batches:
            rows, held, last = [], np.zeros(0, np.uint64), None
            # Neighbouring rows often have the same leader.
            for i, y in enumerate(sets(batch.column("right"))):
                a = batch.column("a")[i].as_py()
                if a != last:
                    held, last = next(sets(batch.column("left").slice(i, 1))), a
                inside = np.searchsorted(held, y)
                inside[inside == len(held)] = 0
                known = held[inside] == y
                same, pivot, rest = int(known.sum()), None, None
                if bands:
                    own = y[~known]
                    band = bands.of(own)
                    own, band = own[band < batch.column("from")[i].as_py()], band[band < batch.column("from")[i].as_py()]
                    pivot = len(y) - len(own)
                    must = max(1, least_overlap(len(y), percent) - pivot)
                    rest = own[np.argsort(band, kind="stable")][: max(0, len(own) - must + 1)].view(np.int64)
                rows.append((same, len(held), len(y), pivot, rest))
            same, m, n, pivot, rest = zip(*rows, strict=True) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *(pa.array(x, pa.int64()) for x in (same, m, n, pivot)), pa.array(rest, pa.list_(pa.int64()))],
                names=["a", "b", "same", "m", "n", "pivot", "rest"],
            )

    one = pairs.select("a", "b", *(["from"] if listed else [])).join(texts.select(F.col("fp").alias("b"), F.col("packed").alias("right")), "b")
    two = one.join(texts.select(F.col("fp").alias("a"), F.col("packed").alias("left")), "a")
    return cut_lineage(two.mapInArrow(run, PAIR), "compared")


def links_of(pairs: DataFrame, percent: int) -> DataFrame:
    return pairs.where(f"100 * same >= {percent} * (m + n - same)").select("a", "b")


def across(pairs: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b): members of one leader, from different components, that their overlaps with the pivot do not rule out."""
    member = pairs.select(F.col("a").alias("p"), F.col("b").alias("fp"), F.col("pivot").alias("same"), "n", "rest").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    member = member.withColumn("root", F.coalesce("root", "fp"))
    # The leader's own component is among the groups to compare.
    least = member.groupBy("p").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("p")
    member = cut_lineage(member.join(least, "p"), "led")

    # Shingles that the pivot lacks: only those shared across components. A pair needs t less the smaller overlap of
    # them, of which those beyond the shorter prefix are at most one less than what that set must share.
    must = F.expr(f"greatest(1, (n * {percent} + 99) div 100 - same)")
    tokens = member.select("p", "fp", "root", "n", "same", must.alias("must"), F.explode("rest").alias("token"))
    several = tokens.groupBy("p", "token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("p", "token")
    tokens = cut_lineage(tokens.join(several, ["p", "token"]), "besides")
    names = ["fp", "root", "n", "same", "must"]
    x, y = (tokens.select("p", "token", *[F.col(c).alias(f"{side}_{c}") for c in names]) for side in "xy")
    counted = x.join(y, ["p", "token"]).where("x_fp < y_fp and x_root != y_root").groupBy("p", *[f"{side}_{c}" for side in "xy" for c in names]).agg(F.count(F.lit(1)).alias("c"))
    need = f"({percent} * (x_n + y_n) + {99 + percent}) div {100 + percent} - least(x_same, y_same)"
    besides = counted.where(f"c >= {need} - greatest(x_must, y_must) + 1").select(F.col("x_fp").alias("a"), F.col("y_fp").alias("b"))

    # Both overlap the pivot enough: 100 * t >= percent * (m + n - t) for t = the smaller overlap. A member that is not
    # itself linked with the leader can have such partners only of few sizes, which are listed.
    high = F.expr(f"least(n * 100 div {percent}, ({100 + percent} * same) div {percent} - n)")
    sizes = member.select("p", F.col("fp").alias("a"), F.col("root").alias("x"), F.col("n").alias("m"), "same", F.expr(f"(n * {percent} + 99) div 100").alias("low"), high.alias("high"))
    # A member linked with the leader is compared from the other side.
    lone = sizes.join(roots.select(F.col("node").alias("p"), F.col("root").alias("own")), "p", "left").where("x != coalesce(own, p)").where("low <= high")
    lone = lone.select("p", "a", "x", "m", F.explode(F.sequence("low", "high")).alias("n"))
    other = member.select("p", F.col("fp").alias("b"), F.col("root").alias("y"), "n", F.col("same").alias("other"))
    both = lone.join(other, ["p", "n"]).where(f"x != y and {100 + percent} * other >= {percent} * (m + n)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return besides.union(both).distinct()


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, listed: int = LISTED) -> DataFrame:
    """``doc_id, n_shingles, component_id, fp`` for every row; ``fp`` identifies equal sets (null for empty ones)."""
    read = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return grouped(read, shingle, percent, listed)


def grouped(read: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, listed: int = LISTED) -> DataFrame:
    """``join`` for columns ``doc_id`` and ``text``; further ``long`` columns stay beside their row."""
    beside = [c for c in read.columns if c not in ("doc_id", "text")]
    first = cut_lineage(digests(read, shingle), "digests")
    sets = first.where("n is not null").select("doc_id", "n", "fp", *beside)
    classes = frequent(first.where("token is not null").select("token", "df"), listed)
    live = live_rows(index(read, classes, shingle, percent), percent)

    # One row of text for each set that may be linked.
    texts = cut_lineage(texts_of(read, live.select("fp").distinct(), shingle), "texts")

    star = led(live).groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a")).select("a", "b")
    links = links_of(compared(star, texts, shingle, percent), percent)
    roots = cut_lineage(components(links), "roots")
    pairs = cut_lineage(led(spanning(live, roots)), "led")
    # Shingles that a quarter of the leader's members may share, or more, belong to the pivot.
    sizes = pairs.groupBy(F.col("a").alias("_a")).agg(F.greatest(F.lit(1), F.floor(F.log2(F.count(F.lit(1)))) - 2).cast("int").alias("from"))
    pairs = compared(pairs.join(sizes, F.col("a") == F.col("_a")), texts, shingle, percent, classes)
    links = links.union(links_of(pairs, percent))
    roots = cut_lineage(components(links), "roots")
    more = links_of(compared(cut_lineage(across(pairs, roots, percent), "across"), texts, shingle, percent), percent)
    roots = cut_lineage(components(links.union(more)), "roots")

    rooted = cut_lineage(sets.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("doc_id", "n", "fp", F.coalesce("root", "fp").alias("root"), *beside), "rooted")
    least = rooted.where("root is not null").groupBy(F.col("root").alias("_root")).agg(F.min("doc_id").alias("least"))
    return rooted.join(least, F.col("root") == F.col("_root"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        "fp",
        "root",
        *beside,
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, one with the smallest id, with its own columns.

    Rows are found again by id and two hashes of the text (128 bits); of rows with the smallest id the one with the
    smallest hashes stays, and of rows equal in all three one. Ids may be null: a component without ids keeps the row with
    the smallest hashes. Texts without words stay all. The groups are found on narrow rows; whole documents pass one join.
    """
    own = [F.col(f"`{c}`").alias(f"_own{k}") for k, c in enumerate(docs.columns)]
    said = F.col(f"`{text}`")
    named = {"_id": F.col(f"`{key}`").cast("long"), "_t0": F.xxhash64(said), "_t1": F.xxhash64(F.lit(1), said)}
    has_words = F.coalesce(said.rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    read = docs.select(named["_id"].alias("doc_id"), said.alias("text"), named["_t0"].alias("t0"), named["_t1"].alias("t1"))
    found = grouped(read, **options).where("root is not null and doc_id <=> component_id")
    chosen = found.groupBy("root").agg(F.min(F.struct("doc_id", "t0", "t1")).alias("one"))
    chosen = cut_lineage(chosen.select(*[F.col("one")[c].alias(f"_c{k}") for k, c in enumerate(("doc_id", "t0", "t1"))]), "chosen")
    rows = docs.select(*own, *[c.alias(n) for n, c in named.items()], has_words.alias("_words"))
    on = F.col("_id").eqNullSafe(F.col("_c0")) & (F.col("_t0") == F.col("_c1")) & (F.col("_t1") == F.col("_c2"))
    kept = rows.where("_words").join(chosen, on, "left_semi")
    first = kept.select("*", F.row_number().over(Window.partitionBy("_id", "_t0", "_t1").orderBy("_id")).alias("_nth")).where("_nth = 1")
    back = [F.col(f"_own{k}").alias(c) for k, c in enumerate(docs.columns)]
    return first.select(*back).union(rows.where("not _words").select(*back))
