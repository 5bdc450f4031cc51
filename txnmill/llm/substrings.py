"""Substring deduplication with fixed-block anchors.

Removes every word of a ``span``-word window whose words also start earlier: in a document with a smaller id, or
earlier in the same one. Windows are judged on the input.

Every document is cut into non-overlapping blocks of ``span / 2`` words, the anchors. Any two equal windows of
``span`` words hold an anchor of each other, so every rolling window of ``span / 2`` words probes the anchors:

1. probe: per range of hash values, which rolling windows occur twice or more and which meet an anchor elsewhere;
2. extend: around a hit the stretch grows over neighbouring rolling windows that repeat too; the ``span``-word
   windows inside a stretch are compared exactly (64-bit hashes), and the earliest of equals stays;
3. cut: the other windows join into maximal repeats, and their words are removed.

Documents travel in packs of consecutive rows (``PACK`` bytes; a longer text is a pack of its own). A pack sends
each distinct hash once to the task of its range, and gets one bit for each back, so a passage that a third of all
documents share costs one entry per pack, and no task holds more than a range. The number of ranges follows the number
of input partitions.

The input is read once for each step and must be the same each time, as tables in files are; a pack whose answers
are missing is an error.

Edge cases: null and empty texts have no words, nothing is removed and the digest is that of an empty text. Rows
without an id are documents of their own, after all with ids, in the order of the input's partitions and rows. Rows with
equal ids are one document: the earlier start stays, equal starts all stay. An empty table gives an empty result. Other
columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmill.session import cut_lineage

from . import words as W

SPAN = 20
PACK = 1 << 22
#: Rows without an id are numbered from here on.
UNNAMED = np.int64(1 << 62)


class Pack:
    """Consecutive documents: ids, texts and what is derived from them, alike in every step."""

    def __init__(self, key: str, ids: np.ndarray, valid: np.ndarray, offsets: np.ndarray, data: np.ndarray, span: int, ranges: int):
        self.key, self.ids, self.valid, self.offsets, self.data, self.span = key, ids, valid, offsets, data, span
        self.words = W.find(offsets, data)
        half = span // 2
        # Rolling half windows; those at a multiple of their length are the anchors.
        hashes, self.at = W.windows(self.words, half)
        inside = self.at - self.words.first[self.words.text[self.at]] if len(self.at) else self.at
        code = (hashes >> np.uint64(32)) % np.uint64(ranges) << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)
        self.codes, self.which, counts = np.unique(code, return_inverse=True, return_counts=True)
        anchors = np.bincount(self.which[inside % half == 0], minlength=len(self.codes))
        self.flags = ((counts > 1) * 1 + np.minimum(anchors, 2) * 2).astype(np.uint8)

    def probes(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(range, distinct hashes, their flags): 1 if repeated in the pack, plus twice the anchors, 2 at most."""
        for r, a, b in _ranges(self.codes >> np.uint64(32)):
            yield r, (self.codes[a:b] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), self.flags[a:b].tobytes()

    def extend(self, answers: dict[int, bytes], ranges: int) -> None:
        """The windows to compare: inside a stretch of repeated rolling windows that meets an anchor."""
        state = np.zeros(len(self.codes), np.uint8)
        for r, a, b in _ranges(self.codes >> np.uint64(32)):
            if r not in answers:
                raise RuntimeError(f"no answers for range {r} of pack {self.key}: the input changed between steps")
            if answers[r]:
                state[a:b] = np.frombuffer(answers[r], np.uint8)
        state = state[self.which]
        # A hash that meets only one anchor is a hit for all probes but the anchor itself.
        repeated = np.append(0, np.cumsum(state & 1))
        met = np.append(0, np.cumsum(state >> 1))
        hashes, start = W.windows(self.words, self.span)
        if len(start):
            probe = np.searchsorted(self.at, start)
            rolling = self.span - self.span // 2 + 1
            inside = (repeated[probe + rolling] - repeated[probe] == rolling) & (met[probe + rolling] > met[probe])
            hashes, start = hashes[inside], start[inside]
        # The first of equal windows inside the pack is compared with other packs; the others go at once.
        text = self.words.text[start] if len(start) else start
        doc = self.ids[text] if len(start) else start
        place = start - self.words.first[text] if len(start) else start
        order = np.lexsort((place, doc, hashes, hashes % np.uint64(ranges)))
        hashes, doc, place, start = hashes[order], doc[order], place[order], start[order]
        new = np.append(True, hashes[1:] != hashes[:-1]) if len(order) else np.zeros(0, bool)
        head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order
        later = (doc != doc[head]) | (place != place[head])
        self.removed = start[later]
        # Equal rows repeated in the input share their place; all of them follow the first.
        self.ties = start[~later], (np.cumsum(new) - 1)[~later] if len(order) else order
        self.first = hashes[new], doc[new], place[new].astype("<u4")

    def windows(self, ranges: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        hashes, doc, place = self.first
        for r, a, b in _ranges(hashes % np.uint64(ranges)):
            yield r, hashes[a:b].tobytes(), doc[a:b].tobytes(), place[a:b].tobytes()

    def cut(self, answers: dict[int, bytes], ranges: int) -> tuple[list[int], list[int], list[str], list[list[dict]]]:
        """Per document: words, removed words, digest of the kept text, removed ranges of words."""
        hashes = self.first[0]
        gone = np.zeros(len(hashes), bool)
        for r, a, b in _ranges(hashes % np.uint64(ranges)):
            if r not in answers:
                raise RuntimeError(f"no answers for range {r} of pack {self.key}: the input changed between steps")
            if answers[r]:
                gone[a:b] = np.frombuffer(answers[r], np.uint8) > 0
        starts = np.concatenate([self.removed, self.ties[0][gone[self.ties[1]]]])
        # +1 where a removed window starts, -1 after it ends; windows never cross a document's end.
        edge = np.zeros(len(self.words.start) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + self.span, -1)
        covered = np.cumsum(edge[:-1]) > 0
        raw = self.data.tobytes()
        begin, end = self.words.start.tolist(), self.words.stop.tolist()
        n, removed, digest, spans = [], [], [], []
        for low, high in zip(self.words.first[:-1].tolist(), self.words.first[1:].tolist(), strict=True):
            off = covered[low:high]
            n.append(high - low)
            removed.append(int(off.sum()))
            digest.append(hashlib.sha256(b" ".join(raw[begin[i] : end[i]] for i in (np.flatnonzero(~off) + low).tolist())).hexdigest())
            change = np.flatnonzero(np.diff(np.concatenate([[0], off.astype(np.int8), [0]])))
            spans.append([{"start": a, "stop": b} for a, b in zip(change[::2].tolist(), change[1::2].tolist(), strict=True)])
        return n, removed, digest, spans


def _ranges(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, from, to) of the runs of a sorted array."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else []
    for k, a in enumerate(starts):
        yield int(values[a]), int(a), int(starts[k + 1] if k + 1 < len(starts) else len(values))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, ids, valid, offsets, data): the same packs whenever the same partition is read."""
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids = batch.column("doc_id")
        valid = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for low, high, offsets, data in W.chunks(batch.column("text"), PACK):
            digest = hashlib.blake2b(data, digest_size=8)
            digest.update(ids[low:high].tobytes() + offsets.tobytes())
            own = UNNAMED + (np.int64(part) << 42) + (np.int64(number) << 22) + np.arange(high - low)
            yield f"{part}-{number}-{digest.hexdigest()}", np.where(valid[low:high], ids[low:high], own), valid[low:high], offsets, data
            number += 1


def _compared(low: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Answer of each entry (distinct hash of a pack): 1 if it occurs twice or more, plus 2 if it meets an anchor."""
    order = np.argsort(low, kind="stable")
    new = np.append(True, low[order][1:] != low[order][:-1])
    group = np.cumsum(new) - 1
    entries = np.bincount(group)
    several = np.bincount(group, weights=flags[order] & 1) > 0
    anchors = np.bincount(group, weights=flags[order] >> 1)
    repeated = (entries > 1) | several
    out = np.empty(len(low), np.uint8)
    out[order] = (repeated * 1 + (repeated & (anchors > 0)) * 2).astype(np.uint8)[group]
    return out


def _earliest(hashes: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """1 for windows that also start earlier."""
    order = np.lexsort((place, doc, hashes))
    hashes, doc, place = hashes[order], doc[order], place[order]
    new = np.append(True, hashes[1:] != hashes[:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    out = np.empty(len(order), np.uint8)
    out[order] = (doc != doc[head]) | (place != place[head])
    return out


def _answered(sent: DataFrame, kinds: tuple[str, ...], judge) -> DataFrame:
    """(pack, answers): the entries of a range are judged together, the answers of a pack are gathered."""

    def run(table: pa.Table) -> pa.Table:
        columns = [[np.frombuffer(v, kind) for v in table[f"c{k}"].to_pylist()] for k, kind in enumerate(kinds)]
        answer = judge(*[np.concatenate(c) for c in columns])
        cuts = np.cumsum([len(c) for c in columns[0]])[:-1]
        parts = [a.tobytes() if a.any() else b"" for a in np.split(answer, cuts)]
        return pa.table({"pack": table["pack"], "range": table["range"], "answer": pa.array(parts, pa.binary())})

    answers = sent.groupBy("range").applyInArrow(run, "pack string, range int, answer binary")
    return cut_lineage(answers.groupBy("pack").agg(F.collect_list(F.struct("range", "answer")).alias("answers")), "answers")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, removed`` for every row; ``removed`` has ranges of words."""
    if span % 2:
        raise ValueError("span must be even")
    read = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ranges = max(256, 8 * read.rdd.getNumPartitions())
    entry = pa.schema([("pack", pa.string()), ("range", pa.int32()), ("c0", pa.binary()), ("c1", pa.binary()), ("c2", pa.binary())])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fields in _packed(batches):
            rows = [(fields[0], r, c0, c1, None) for r, c0, c1 in Pack(*fields, span, ranges).probes()]
            yield pa.RecordBatch.from_pylist([dict(zip(entry.names, row, strict=True)) for row in rows], entry)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, ids, valid, offsets, data in _packed(batches):
            row = {"pack": pack, "ids": ids.tobytes(), "valid": valid.tobytes(), "offsets": offsets.tobytes(), "data": data.tobytes()}
            yield pa.RecordBatch.from_pylist([row])

    def opened(batch: pa.RecordBatch, i: int) -> Pack:
        row = {n: batch.column(n)[i].as_py() for n in ("pack", "ids", "valid", "offsets", "data", "hits")}
        pack = Pack(row["pack"], np.frombuffer(row["ids"], np.int64), np.frombuffer(row["valid"], bool), np.frombuffer(row["offsets"], np.int64), np.frombuffer(row["data"], np.uint8), span, ranges)
        pack.extend({a["range"]: a["answer"] for a in row["hits"] or []}, ranges)
        return pack

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pack = opened(batch, i)
                rows = [(pack.key, *entry_) for entry_ in pack.windows(ranges)]
                yield pa.RecordBatch.from_pylist([dict(zip(entry.names, row, strict=True)) for row in rows], entry)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pack = opened(batch, i)
                n, removed, digest, spans = pack.cut({a["range"]: a["answer"] for a in batch.column("gone")[i].as_py() or []}, ranges)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(pack.ids, mask=~pack.valid), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "removed"],
                )

    sent = "pack string, range int, c0 binary, c1 binary, c2 binary"
    hits = _answered(read.mapInArrow(probe, sent), ("<u4", "u1"), _compared)
    packs = read.mapInArrow(texts, "pack string, ids binary, valid binary, offsets binary, data binary")
    judged = packs.join(hits.withColumnsRenamed({"pack": "_pack", "answers": "hits"}), F.col("pack") == F.col("_pack"), "left").drop("_pack")
    gone = _answered(judged.mapInArrow(compare, sent), ("<u8", "<i8", "<u4"), _earliest)
    both = judged.join(gone.withColumnsRenamed({"pack": "_pack", "answers": "gone"}), F.col("pack") == F.col("_pack"), "left").drop("_pack")
    return both.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:int,stop:int>>")
