"""Benchmark decontamination: rare word pairs join passages to test items, Smith-Waterman alignment scores them.

1. Every test item is a sequence of words. The frequency of each of its pairs of neighbouring words is counted over all
   documents.
2. An alignment of ``m`` matches and ``e`` errors scores ``m - e``. Its matches stand in at most ``e + 1`` runs, so at
   least ``m - e - 1`` pairs of the item stand unbroken in the passage: one less than the score, whatever the edits. Of
   the ``g`` pairs of an item any ``g - k`` thus meet all but ``k`` of them. The most frequent half of what an accepted
   score must meet is left out, the others are seeds, and as many seeds as remain sure must stand within the reach of an
   alignment, which is the item's words and the gaps that its score allows. This misses no alignment.
3. Such passages are aligned word by word (match 1, mismatch and gap -1, local). The score is the best alignment
   divided by the words of the item: 1 for a copy, lower with every edit. ``least`` decides.
4. A part of a long item counts by itself: items of more than ``2 * passage`` words are also cut into pieces of so many
   words, each begun ``passage`` words after the one before, and an item matches where one of its pieces scores
   ``passage``. So every ``passage`` words copied in a row match, however long the item is; the score is still that of
   the whole item and may then be below ``least``.

The test items are a stated query set. They go to the tasks in blocks of at most ``GRAMS`` words,
one scan of the documents for each block, so what is broadcast is bounded for a test set of any size. Nothing but the
counts and the hits is shuffled.

Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z. A match has a pair
of the item's words, in an item of one word that word; items without words match nothing.

Edge cases: null and empty texts and items match nothing; repeated items and repeated rows give repeated results;
null ids are kept as null; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

LEAST = 0.5
#: Score that is a match in an item of any length.
PASSAGE = 20
#: Words of one block of test items.
GRAMS = 1_000_000


def _item_words(text: str | None) -> np.ndarray:
    ends, data = W.buffers(pa.array([text or ""]))
    return W.find(ends - ends[0], data, W.MARKS, lower=True).hash


def _needed(words: np.ndarray, least: float) -> int:
    """Score that an alignment of the words must reach."""
    return max(1, int(np.ceil(least * len(words) - 1e-9)))


def _pieces(size: int, passage: int) -> list[int]:
    """First words of the pieces of an item of ``size`` words."""
    return [*range(0, size - 2 * passage, passage), size - 2 * passage] if size > 2 * passage else []


def blocks(items: DataFrame, key: str, text: str, limit: int = GRAMS) -> Iterator[list[tuple[int, np.ndarray]]]:
    """(item id, word hashes) lists with at most ``limit`` words together; a longer item is a block of its own."""
    held, size = [], 0
    for row in items.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").alias("t")).orderBy("k", "t").toLocalIterator():
        words = _item_words(row["t"])
        if held and size + len(words) > limit:
            yield held
            held, size = [], 0
        if len(words):
            held.append((row["k"], words))
            size += len(words)
    if held:
        yield held


def _lookup(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in ``sorted_keys``, -1 if absent."""
    place = np.searchsorted(sorted_keys, values)
    place[place == len(sorted_keys)] = 0
    return np.where(sorted_keys[place] == values, place, -1)


class Grams:
    """Distinct grams of a block by size."""

    def __init__(self, block: list[tuple[int, np.ndarray]]):
        self.sizes = sorted({min(2, len(w)) for _, w in block})
        self.keys = {k: np.unique(np.concatenate([W.rolling(w, k) for _, w in block if min(2, len(w)) == k])) for k in self.sizes}
        self.maybe = {}
        for k, keys in self.keys.items():
            self.maybe[k] = np.zeros(1 << 20, bool)
            self.maybe[k][keys >> np.uint64(44)] = True

    def hits(self, words: W.Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, positions in the chunk, places of their n-grams)."""
        for k in self.sizes:
            hashes, at = W.windows(words, k)
            some = np.flatnonzero(self.maybe[k][hashes >> np.uint64(44)])
            place = _lookup(self.keys[k], hashes[some])
            found = place >= 0
            yield k, at[some][found], place[found]


def gram_counts(docs: DataFrame, grams: Grams, block) -> dict[int, np.ndarray]:
    """Occurrences of each gram of the block over all documents; as many numbers as the block has grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Grams(block.value)
        total = {k: np.zeros(len(known.keys[k]), np.int64) for k in known.sizes}
        for batch in batches:
            for _, _, offsets, data in W.chunks(batch.column("text")):
                for k, _, place in known.hits(W.find(offsets, data, W.MARKS, lower=True)):
                    total[k] += np.bincount(place, minlength=len(total[k]))
        for k, counts in total.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"size": np.full(len(some), k), "place": some, "n": counts[some]}, pa.schema([("size", pa.int32()), ("place", pa.int64()), ("n", pa.int64())]))

    summed = docs.select("text").mapInArrow(run, "size int, place long, n long").groupBy("size", "place").agg(F.sum("n").alias("n")).toArrow()
    out = {k: np.zeros(len(keys), np.int64) for k, keys in grams.keys.items()}
    size, place, n = (summed[c].to_numpy() for c in ("size", "place", "n"))
    for k in out:
        out[k][place[size == k]] = n[size == k]
    return out


class Seeds:
    """For each seed gram of a block, the parts and positions it stands for. A part is an item or a piece of one."""

    def __init__(self, block: list[tuple[int, np.ndarray]], grams: Grams, counts: dict[int, np.ndarray], least: float, passage: int):
        self.grams, self.items = grams, block
        #: (item, words, score needed); an item comes before its pieces.
        self.parts = []
        for i, (_, words) in enumerate(block):
            self.parts.append((i, words, _needed(words, least)))
            self.parts += [(i, words[a : a + 2 * passage], passage) for a in _pieces(len(words), passage)]
        #: Words of a passage that the score allows, and the seeds that it must meet.
        self.reach = np.array([len(w) + max(0, len(w) - needed) for _, w, needed in self.parts], np.int64)
        self.sure = np.zeros(len(self.parts), np.int64)
        rows: dict[int, list[tuple[int, int, int]]] = {k: [] for k in grams.sizes}
        for i, (_, words, needed) in enumerate(self.parts):
            k = min(2, len(words))
            place = _lookup(grams.keys[k], W.rolling(words, k))
            met = max(1, needed - 1)
            left_out = met // 2
            self.sure[i] = met - left_out
            order = np.lexsort((np.arange(len(place)), counts[k][place]))
            for position in order[: len(place) - left_out].tolist():
                rows[k].append((int(place[position]), i, position))
        self.entries = {k: np.array(sorted(r), np.int64).reshape(-1, 3) for k, r in rows.items()}

    def found(self, words: W.Words) -> np.ndarray:
        """Rows (text, part, word of the text), one for each part at each place of a seed."""
        out = [np.zeros((0, 3), np.int64)]
        for k, at, place in self.grams.hits(words):
            entries = self.entries[k]
            low, high = np.searchsorted(entries[:, 0], place), np.searchsorted(entries[:, 0], place, side="right")
            count = high - low
            which = np.repeat(np.arange(len(place)), count)
            row = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            text = words.text[at[which]]
            out.append(np.stack([text, entries[row, 1], at[which] - words.first[text]], 1))
        return np.concatenate(out)

    def passages(self, words: W.Words) -> np.ndarray:
        """Rows (text, part, from, to): words of a text that an accepted alignment of the part can lie in."""
        found = self.found(words)
        if not len(found):
            return np.zeros((0, 4), np.int64)
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        text, part, at = found.T
        # The seed that completes the sure number, if it stands within the reach.
        last = np.arange(len(found)) + self.sure[part] - 1
        held = np.flatnonzero(last < len(found))
        end = last[held]
        held = held[(text[end] == text[held]) & (part[end] == part[held]) & (at[end] - at[held] < self.reach[part[held]])]
        if not len(held):
            return np.zeros((0, 4), np.int64)
        text, part, low = text[held], part[held], at[held]
        high = at[held + self.sure[part] - 1]
        # Groups that overlap are one passage, with the reach of an alignment on both sides.
        new = np.append(True, (text[1:] != text[:-1]) | (part[1:] != part[:-1]) | (low[1:] > high[:-1] + self.reach[part[1:]]))
        first = np.flatnonzero(new)
        stop = np.append(first[1:], len(held)) - 1
        text, part = text[first], part[first]
        return np.stack([text, part, np.maximum(0, low[first] - self.reach[part]), np.minimum(words.counts[text], high[stop] + self.reach[part] + 1)], 1)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of word hashes: (score, first word, word after the last) of the passage.

    Match 1, mismatch -1, gap -1. Of equal scores the one that ends first. The row update is vectorised: a gap in the
    item is a running maximum along the row.
    """
    m = len(passage)
    score, origin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    along = np.arange(m + 1)
    best = (0, 0, 0)
    for word in item.tolist():
        diagonal = score[:-1] + np.where(passage == word, 1, -1)
        above = score[1:] - 1
        value = np.maximum(np.maximum(diagonal, above), 0)
        start = np.where(value == 0, along[1:], np.where(diagonal >= above, origin[:-1], origin[1:]))
        # Gaps along the row: value[j] = max over i <= j of value[i] - (j - i).
        raised = np.concatenate([[0], value]) + along
        top = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == top, along, 0))
        new = top - along
        new_origin = np.concatenate([[0], start])[source]
        empty = new <= 0
        score, origin = np.where(empty, 0, new), np.where(empty, along, new_origin)
        j = int(np.argmax(score))
        if score[j] > best[0]:
            best = (int(score[j]), int(origin[j]), j)
    return best


def _placed(item: np.ndarray, words: W.Words, text: int, low: int, high: int) -> tuple[int, int, int]:
    """Best alignment with the words ``low`` to ``high`` of a text: (score, first word, word after the last) of the text."""
    low, high = max(0, low), min(int(words.counts[text]), high)
    score, start, stop = align(item, words.hash[words.first[text] + low : words.first[text] + high])
    return score, low + start, low + stop


def matches(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    least: float = LEAST,
    passage: int = PASSAGE,
    limit: int = GRAMS,
) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word``: the best aligned passage of each item in each document."""
    read = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return aligned(read, items, ("doc_id",), item_key, item_text, least, passage, limit)


def aligned(
    read: DataFrame,
    items: DataFrame,
    keys: tuple[str, ...],
    item_key: str = "item_id",
    item_text: str = "text",
    least: float = LEAST,
    passage: int = PASSAGE,
    limit: int = GRAMS,
) -> DataFrame:
    """As ``matches``, with the columns ``keys`` (long) of ``read`` in place of ``doc_id``."""
    spark = read.sparkSession
    schema = ", ".join(f"{k} long" for k in keys) + ", item_id long, score double, first_word long, last_word long"
    out = spark.createDataFrame([], schema)
    for block in blocks(items, item_key, item_text, limit):
        shared = spark.sparkContext.broadcast(block)
        counts = spark.sparkContext.broadcast(gram_counts(read, Grams(block), shared))
        out = out.union(read.mapInArrow(_aligner(shared, counts, least, passage, keys), schema))
    return out


def _aligner(block, counts, least: float, passage: int, keys: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Seeds(block.value, Grams(block.value), counts.value, least, passage)
        for batch in batches:
            rows = []
            for low, _, offsets, data in W.chunks(batch.column("text")):
                words = W.find(offsets, data, W.MARKS, lower=True)
                best: dict[tuple[int, int], tuple] = {}
                for text, part, a, b in known.passages(words).tolist():
                    i, own, needed = known.parts[part]
                    score, start, stop = _placed(own, words, text, a, b)
                    held = best.get((text, i), (0, 0, -1))
                    if score < needed or (held[1] <= start and stop - 1 <= held[2]):
                        continue
                    whole = known.items[i][1]
                    if len(own) < len(whole):
                        # The rest of the item stands around its piece.
                        score, start, stop = _placed(whole, words, text, start - 2 * len(whole), stop + 2 * len(whole))
                    if score > held[0]:
                        best[text, i] = (score, start, stop - 1)
                rows += [(low + t, known.items[i][0], s / len(known.items[i][1]), x, y) for (t, i), (s, x, y) in best.items()]
            at, item, score, first, last = zip(*rows, strict=True) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(pa.array(at, pa.int64())).cast(pa.int64()) for k in keys), pa.array(item, pa.int64()), pa.array(score, pa.float64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                names=[*keys, "item_id", "score", "first_word", "last_word"],
            )

    return run


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without a match, with their own columns.

    A match belongs to a text, so rows are found again by two hashes of the text (128 bits): ids play no part, whether
    null or repeated, and equal texts are judged alike. Rows with a null text have no match.
    """
    hashes = {"t0": F.xxhash64(F.col(f"`{text}`")), "t1": F.xxhash64(F.lit(1), F.col(f"`{text}`"))}
    read = docs.select(*[h.alias(n) for n, h in hashes.items()], F.col(f"`{text}`").alias("text"))
    found = aligned(read, items, ("t0", "t1"), **options).select(F.col("t0").alias("_t0"), F.col("t1").alias("_t1")).distinct()
    return docs.join(found, (hashes["t0"] == F.col("_t0")) & (hashes["t1"] == F.col("_t1")), "left_anti")
