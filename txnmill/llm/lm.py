"""Cross-entropy difference: a target and a background bigram model over one vocabulary score every document.

The vocabulary is every distinct word of all documents, and a start symbol. Both models are matched: the same
vocabulary, the same counting and the same smoothing,

    p(w)     = (count(w) + alpha) / (total + alpha * words)
    p(w | v) = (count(v, w) + beta * p(w)) / (count(v) + beta)

The background model counts every document, the target model those with a target id. The loss of a document is
the mean of ``-ln p`` over its words; the score is target loss minus background loss, so lower is closer to the target.

Nothing is capped and no model is gathered. Documents are dealt into packs of about ``PACK`` words, or one longer text,
and stored as the codes of their words within the pack. A pack sends the distinct 64-bit keys of its word pairs, words
and first words, each once with its counts, to the ranges of the key space; a range adds up the counts of equal keys of
all packs and returns them in the same order, and the pack computes its losses from them. A frequent pair is one entry
per pack, so no key is hot, and the number of ranges follows the words, at about ``RANGE`` of them each.

On request (``words``) the vocabulary is bounded: the most frequent words and ``classes`` hash classes for the others.

Edge cases: null and empty texts have 0 words and null losses; without target documents the target model is uniform;
a null id is no target; rows with equal ids are counted and scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmill.session import cut_lineage

from . import words as W

CLASSES = 256
ALPHA = 0.1
BETA = 32.0
#: Words gathered in a pack, and about the words whose keys meet in a range.
PACK, RANGE = 1 << 21, 1 << 18
#: Distinct words held by a task before it sends their counts.
HELD = 1 << 21
#: Words of a pack in one row, and documents in one batch.
LISTED, BATCH = 1 << 10, 1 << 12
#: The symbol before the first word of a text, and what tells keys of pairs, words and first words apart.
START, PAIR, SINGLE, BEFORE = (W.mix(np.arange(1, 5, dtype=W.U64) * W.BASE)).reshape(4, 1)

PACKED = "pack long, place int, doc_id long, target boolean, n_words int, codes binary, words array<long>"
SENT = "range int, pack long, n int, keys binary, background binary, target binary"
RESULT = "doc_id long, n_words long, target_loss double, background_loss double, score double"


def words_of(column: pa.Array) -> Iterator[tuple[int, W.Words]]:
    """(first row, words) by chunk. Words are runs of ``[0-9a-z]`` and non-ASCII characters, A-Z lower-cased."""
    for low, _, offsets, data in W.chunks(column):
        yield low, W.find(offsets, data, W.MARKS, lower=True)


def vocabulary(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of the ``size`` most frequent words; of equally frequent ones, the smaller hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.view(np.int64)), pa.array(counts)], names=["word", "n"])

        for batch in batches:
            for _, words in words_of(batch.column("text")):
                found, n = np.unique(words.hash, return_counts=True)
                held, at = np.unique(np.concatenate([held, found]), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([counts, n]), minlength=len(held)).astype(np.int64)
                if len(held) >= HELD:
                    yield made()
                    held, counts = held[:0], counts[:0]
        yield made()

    counted = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.col("n").desc(), "word").limit(size).toArrow()
    return np.sort(top["word"].to_numpy().astype(np.int64).view(np.uint64))


def symbols(hashes: np.ndarray, known: np.ndarray | None, classes: int) -> np.ndarray:
    """The words themselves, or for a bounded vocabulary the ``known`` ones and the classes of the others."""
    if known is None:
        return hashes
    place = np.searchsorted(known, hashes)
    place[place == len(known)] = 0
    same = known[place] == hashes if len(known) else np.zeros(len(hashes), bool)
    return np.where(same, hashes, hashes % W.U64(classes))


def shrunk(values: np.ndarray) -> bytes:
    """Numbers from 0 as compressed byte planes, and the number of planes before them."""
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + (pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if width else b"")


def grown(data: bytes, n: int) -> np.ndarray:
    out, width = np.zeros((n, 8), np.uint8), data[0]
    if width:
        planes = pa.decompress(data[1:], decompressed_size=n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view("<i8").ravel()


def packed(marked: DataFrame, known: np.ndarray | None, classes: int) -> DataFrame:
    """Packs of ``doc_id, text, target``: a row for each document, and rows that list the words of the pack."""
    shared = marked.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        types = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
        schema = pa.schema([(c.split()[0], t) for c, t in zip(PACKED.split(", "), types, strict=True)])

        def filled(n: int, **columns) -> pa.RecordBatch:
            pack = pa.array(np.full(n, (part << 32) + number))
            return pa.RecordBatch.from_arrays([pack, *(columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema if f.name != "pack")], schema=schema)

        def made() -> Iterator[pa.RecordBatch]:
            ids, targets = (pa.concat_arrays(x) for x in list(zip(*held, strict=True))[:2])
            n = np.concatenate([x[2] for x in held])
            found, at, times = np.unique(np.concatenate([x[3] for x in held]), return_inverse=True, return_counts=True)
            # Frequent words have small codes.
            order = np.argsort(-times, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            codes, found = rank[at], found[order]
            cuts = np.append(np.arange(0, len(found), LISTED), len(found)).astype(np.int32)
            yield filled(len(cuts) - 1, place=pa.array(np.arange(len(cuts) - 1, dtype=np.int32)), words=pa.ListArray.from_arrays(pa.array(cuts), pa.array(found.view(np.int64))))
            ends = np.append(0, np.cumsum(n))
            for low in range(0, len(n), BATCH):
                high = min(low + BATCH, len(n))
                rows = [shrunk(codes[a:b]) for a, b in zip(ends[low:high].tolist(), ends[low + 1 : high + 1].tolist(), strict=True)]
                yield filled(high - low, place=pa.array(np.arange(low, high, dtype=np.int32)), doc_id=ids[low:high], target=targets[low:high], n_words=pa.array(n[low:high].astype(np.int32)), codes=pa.array(rows, pa.binary()))

        for batch in batches:
            for low, words in words_of(batch.column("text")):
                n = words.counts
                held.append((batch.column("doc_id").slice(low, len(n)), batch.column("target").slice(low, len(n)), n, symbols(words.hash, shared.value, classes)))
                size += len(words.hash)
                if size >= PACK:
                    yield from made()
                    number, held, size = number + 1, [], 0
        if held:
            yield from made()

    return marked.mapInArrow(run, PACKED)


class Pack:
    """The word pairs of a pack, as cells ``before * size + now`` of its own codes (0 is the start), and their keys."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("place")
        self.docs = rows.filter(pc.is_valid(rows["codes"]))
        words = rows.filter(pc.is_null(rows["codes"]))["words"].combine_chunks()
        found = words.flatten().to_numpy().view(np.uint64) if len(words) else np.zeros(0, W.U64)
        self.n = self.docs["n_words"].to_numpy().astype(np.int64)
        self.size = 1 + len(found)
        self.now = 1 + np.concatenate([grown(c, n) for c, n in zip(self.docs["codes"].to_pylist(), self.n.tolist(), strict=True)])
        self.before = np.append(0, self.now[:-1])[: len(self.now)]
        starts = np.cumsum(self.n) - self.n
        self.before[starts[self.n > 0]] = 0
        self.cells, self.which = np.unique(self.before * self.size + self.now, return_inverse=True)
        every = np.concatenate([START, found])
        first, second = np.divmod(self.cells, self.size)
        keys = np.concatenate([W.mix(every[first] * W.STEP[0] + every[second] * W.STEP[1] + PAIR), W.mix(found * W.STEP[2] + SINGLE), W.mix(every * W.STEP[3] + BEFORE)])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(background, target) counts of the keys within the pack."""
        target = np.repeat(self.docs["target"].to_numpy().astype(bool), self.n)
        out = []
        for some in (slice(None), target):
            pairs, words, before = (np.bincount(x[some], minlength=n) for x, n in ((self.which, len(self.cells)), (self.now, self.size), (self.before, self.size)))
            out.append(np.concatenate([pairs, words[1:], before])[self.order])
        return out[0], out[1]

    def models(self, counts: list[np.ndarray], totals: list[int], symbols: int, alpha: float, beta: float) -> list[Model]:
        """A model for each of the ``counts`` of the keys within the corpus."""
        out = []
        for given, total in zip(counts, totals, strict=True):
            n = np.empty(len(given), np.int64)
            n[self.order] = given
            pairs, words, before = np.split(n, np.cumsum([len(self.cells), self.size - 1]))
            out.append(Model(self.cells, pairs, self.size, alpha, beta, before, np.append(0, words), total, symbols))
        return out

    def losses(self, model: Model) -> np.ndarray:
        """Mean loss of each document; of one without words, 0."""
        text = np.repeat(np.arange(len(self.n)), self.n)
        return np.bincount(text, weights=model.loss(*np.divmod(self.cells, self.size))[self.which], minlength=len(self.n)) / np.maximum(self.n, 1)


def sent(bits: int):
    """Distinct keys of a pack by range, as differences to the key before, with their counts."""

    def run(rows: pa.Table) -> pa.Table:
        pack = Pack(rows)
        keys, of = pack.keys, pack.keys >> W.U64(64 - bits)
        begins = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        cuts = np.append(begins, len(keys))
        steps = np.diff(keys, prepend=W.U64(0))
        steps[begins] = keys[begins] - (of[begins] << W.U64(64 - bits))
        width = max(1, (int(steps.max()).bit_length() + 7) // 8)
        data = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
        packed = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer((cuts * width).astype(np.int32)), pa.py_buffer(data)])
        counts = [pa.array([shrunk(c[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], pa.binary()) for c in pack.counts()]
        number = np.full(len(begins), rows["pack"][0].as_py(), np.int64)
        return pa.Table.from_arrays([pa.array(of[begins].astype(np.int32)), pa.array(number), pa.array(np.diff(cuts).astype(np.int32)), packed, *counts], names=["range", "pack", "n", "keys", "background", "target"])

    return run


def added(bits: int):
    """The counts of equal keys of a range added up, for each pack in the order of its keys."""

    def run(rows: pa.Table) -> pa.Table:
        sizes = rows["n"].to_numpy()
        base, parts = W.U64(rows["range"][0].as_py()) << W.U64(64 - bits), []
        for data, n in zip(rows["keys"].to_pylist(), sizes.tolist(), strict=True):
            steps = np.zeros((n, 8), np.uint8)
            steps[:, : len(data) // n] = np.frombuffer(data, np.uint8).reshape(n, -1)
            parts.append(np.cumsum(steps.view("<u8").ravel()) + base)
        _, which = np.unique(np.concatenate(parts), return_inverse=True)
        out = {}
        for name in ("background", "target"):
            n = np.concatenate([grown(data, n) for data, n in zip(rows[name].to_pylist(), sizes.tolist(), strict=True)])
            whole = np.bincount(which, weights=n).astype(np.int64)[which]
            out[name] = pa.array([shrunk(x) for x in np.split(whole, np.cumsum(sizes)[:-1])], pa.binary())
        return pa.table({"range": rows["range"], "pack": rows["pack"], "n": rows["n"], **out})

    return run


class Model:
    """Smoothed bigram model of sorted cells ``before * size + now`` and their counts. ``before`` and ``single`` count
    each symbol as first and second of a pair, ``total`` all pairs and ``symbols`` the words that can follow; unless
    given, the cells are the whole model."""

    def __init__(
        self, cells: np.ndarray, counts: np.ndarray, size: int, alpha: float, beta: float, before: np.ndarray | None = None,
        single: np.ndarray | None = None, total: int | None = None, symbols: int | None = None,
    ):
        self.cells, self.counts, self.size, self.beta = cells, counts, size, beta
        self.before = np.bincount(cells // size, weights=counts, minlength=size) if before is None else before
        single = np.bincount(cells % size, weights=counts, minlength=size) if single is None else single
        # The start symbol never follows a word.
        self.single = (single + alpha) / ((single.sum() if total is None else total) + alpha * (size - 1 if symbols is None else symbols))

    def loss(self, before: np.ndarray, now: np.ndarray) -> np.ndarray:
        cells = before * self.size + now
        at = np.searchsorted(self.cells, cells)
        at[at == len(self.cells)] = 0
        joint = np.where(self.cells[at] == cells, self.counts[at], 0)
        return -np.log((joint + self.beta * self.single[now]) / (self.before[before] + self.beta))


def score(
    docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", words: int | None = None, classes: int = CLASSES,
    alpha: float = ALPHA, beta: float = BETA,
) -> DataFrame:
    """``doc_id, n_words, target_loss, background_loss, score`` for every row.

    ``targets`` holds the ids (column ``key``) of the documents of the target model. It grows with the corpus, so it is
    joined by shuffle at every size. Rows without an id are dealt by their text and match nothing.
    """
    plain = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    known = None if words is None else vocabulary(plain, words)
    chosen = targets.select(F.col(f"`{key}`").cast("long").alias("_chosen")).where("_chosen is not null").distinct()
    same = (F.coalesce("doc_id", F.xxhash64("text")) == F.col("_chosen")) & F.col("doc_id").isNotNull()
    marked = plain.join(chosen.hint("merge"), same, "left").select("doc_id", "text", F.col("_chosen").isNotNull().alias("target"))
    packs = cut_lineage(packed(marked, known, classes), "packs")
    counted = packs.select(F.sum("n_words").alias("all"), F.sum(F.when(F.col("target"), F.col("n_words"))).alias("target")).first()
    totals = [counted["all"] or 0, counted["target"] or 0]
    size = packs.select(F.explode("words").alias("word")).distinct().count() if known is None else len(known) + classes
    bits = max(1, (totals[0] // RANGE).bit_length())

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        pack, answers = Pack(rows), answers.sort_by("range")
        if sum(answers["n"].to_pylist()) != len(pack.keys):
            raise RuntimeError("a pack and the counts returned to it differ")
        counts = [np.concatenate([grown(data, n) for data, n in zip(answers[c].to_pylist(), answers["n"].to_pylist(), strict=True)]) for c in ("background", "target")]
        background, target = (pack.losses(m) for m in pack.models(counts, totals, size, alpha, beta))
        made = [pa.array(x, pa.float64(), mask=pack.n == 0) for x in (target, background, target - background)]
        return pa.Table.from_arrays([pack.docs["doc_id"], pa.array(pack.n), *made], names=["doc_id", "n_words", "target_loss", "background_loss", "score"])

    returned = packs.groupBy("pack").applyInArrow(sent(bits), SENT).groupBy("range").applyInArrow(added(bits), "range int, pack long, n int, background binary, target binary")
    return packs.groupBy("pack").cogroup(returned.groupBy("pack")).applyInArrow(run, RESULT)
