"""Alignment of two tokenizers: which tokens of one overlap which of the other, how widely a pair of ids occurs, and
how well each document's links agree with the whole corpus.

Method: inverted pair bitmaps. A task deals its documents into packs and writes one posting for each pair of ids linked
in a pack: bit-sliced multiplicity planes, where plane ``k`` is the compressed bitmap of the documents in which the
number of links has bit ``k``. The OR of the planes is the pair's document bitmap; its popcount, summed over packs, is
the document count of the pair, and the popcount of plane ``k`` times ``2**k`` the number of links. Postings then return
the scores: joined with the pairs' counts they go back to their packs, where each plane adds to its documents.

A bitmap is a list of 16-bit places where that is shorter, else one bit per document of the pack. A pair has at most one
posting per pack, so no pair is a hot key; a pack holds about ``PACK`` bytes of text, or one longer text, and at most
65,536 documents. Counts are shuffled as numbers after map-side sums.

Links are the pieces between neighbouring ends of either tokenizer: each piece lies in one token of both, and no two
pieces lie in the same two tokens.

Edge cases: texts that are null, empty, or whose token bytes differ from a space and the text have no tokens, only
zeros. Equal rows and rows with equal or null ids are documents of their own and count as such. An empty table gives an
empty result. Further columns play no part. Texts of any length are encoded in full: they are cut at single blanks between
printable ASCII characters, where neither tokenizer looks across, and a worker encodes each distinct piece once.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmill.session import cut_lineage

from . import words as W
from .tokens import Pieces, byte_level, cut_at_spaces, flat_ids, piece_model, tokenizer_path

BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text encoded at once, and gathered in a pack.
CHUNK, PACK = 1 << 20, 1 << 24
#: Distinct pieces of texts kept with their ids; beyond that a worker starts over.
HELD = 1 << 20
PRINTABLE = np.zeros(256, bool)
PRINTABLE[0x21:0x7F] = True
PLACES = 1 << 16
#: A pair of ids in one number.
SECOND = np.int64(1 << 32)

INDEX = "pair long, pack long, width int, planes array<binary>, place int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string"


@dataclass
class Aligned:
    """Texts of one chunk: per text the numbers of tokens and groups and the digest; per (pair, text) the links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digests: list[str]
    pair: np.ndarray
    text: np.ndarray
    links: np.ndarray


def numbers(size: int) -> Pieces:
    """Decimal numbers below ``size``, each with ``,``, ``|`` and ``;`` behind it."""
    return Pieces.of([str(i).encode() + mark for i in range(size) for mark in (b",", b"|", b";")])


def sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums between neighbouring edges."""
    return np.diff(np.append(0, np.cumsum(values))[edges])


class Encoded:
    """Ids of both tokenizers for distinct pieces of texts, by the 64-bit hash of the piece."""

    def __init__(self):
        self.slots: dict[int, int] = {}
        self.a, self.b = Pieces.of([]), Pieces.of([])

    def add(self, hashes: list[int], a: list[list[int]], b: list[list[int]]) -> None:
        self.slots.update(zip(hashes, range(len(self.slots), len(self.slots) + len(hashes)), strict=True))
        self.a, self.b = self._longer(self.a, a), self._longer(self.b, b)

    @staticmethod
    def _longer(old: Pieces, lists: list[list[int]]) -> Pieces:
        ids, first = flat_ids(lists)
        joined = (np.concatenate(x) for x in ((old.flat.astype(np.int64), ids), (old.start, first[:-1] + len(old.flat)), (old.size, np.diff(first))))
        return Pieces(*joined)


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.pieces_a = byte_level(byte_path, plain=True)
        self.b, self.pieces_b = piece_model(piece_path)
        if max(len(self.pieces_a.size), len(self.pieces_b.size)) > 1 << 16:
            raise ValueError("a vocabulary has more than 65,536 entries")
        self.numbers = numbers(max(len(self.pieces_a.size), len(self.pieces_b.size)))
        self.cuts, self.encoded = cut_at_spaces(self.a, self.b), Encoded()

    def _ids(self, raw: list[bytes], length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and the place of the first id of each text, and of B. Each text has a blank in front."""
        flat = b"".join(raw)
        data, edges = np.frombuffer(flat, np.uint8), np.append(0, np.cumsum(length))
        starts = np.zeros(len(data), bool)
        if self.cuts:
            starts[1:-1] = (data[1:-1] == 0x20) & PRINTABLE[data[:-2]] & PRINTABLE[data[2:]]
        starts[edges[:-1]] = True
        start = np.flatnonzero(starts)
        stop = np.append(start[1:], len(data))
        distinct, at, which = np.unique(W.word_hashes(data, start, stop), return_index=True, return_inverse=True)
        if len(self.encoded.slots) + len(distinct) > HELD:
            self.encoded = Encoded()
        hashes = distinct.tolist()
        new = [k for k, h in enumerate(hashes) if h not in self.encoded.slots]
        if new:
            texts = [flat[x:y].decode() for x, y in zip(start[at[new]].tolist(), stop[at[new]].tolist(), strict=True)]
            a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
            # B puts the blank there itself.
            self.encoded.add([hashes[k] for k in new], a, self.b.encode([t[1:] for t in texts], num_threads=1))
        slots = np.fromiter(map(self.encoded.slots.__getitem__, hashes), np.int64, len(hashes))[which]
        piece = np.searchsorted(start, edges)
        out = []
        for ids in (self.encoded.a, self.encoded.b):
            out += [ids.joined(slots), np.append(0, np.cumsum(ids.size[slots]))[piece]]
        return tuple(out)

    def align(self, texts: list[str]) -> Aligned:
        """All ``texts`` are non-empty."""
        raw = [b" " + t.encode() for t in texts]
        length = np.array([len(r) for r in raw], np.int64)
        a, first_a, b, first_b = self._ids(raw, length)
        # First by length, then byte by byte.
        good = (sums(self.pieces_a.size[a], first_a) == length) & (sums(self.pieces_b.size[b], first_b) == length)
        a, first_a = self._only(a, first_a, good)
        b, first_b = self._only(b, first_b, good)
        given = np.frombuffer(b"".join(r for r, ok in zip(raw, good.tolist()) if ok), np.uint8)
        edges = np.append(0, np.cumsum(np.where(good, length, 0)))
        wrong = sums((self.pieces_a.joined(a) != given) | (self.pieces_b.joined(b) != given), edges) > 0
        if wrong.any():
            a, first_a = self._only(a, first_a, ~wrong)
            b, first_b = self._only(b, first_b, ~wrong)
            edges = np.append(0, np.cumsum(np.where(good & ~wrong, length, 0)))

        ends_a, ends_b = np.cumsum(self.pieces_a.size[a]), np.cumsum(self.pieces_b.size[b])
        # One flag per byte tells where tokens end; running counts of the flags number the tokens.
        stops_a, stops_b = np.zeros(len(given) + 1, bool), np.zeros(len(given) + 1, bool)
        stops_a[ends_a], stops_b[ends_b] = True, True
        upto_a, upto_b = np.cumsum(stops_a), np.cumsum(stops_b)
        both, ends = np.flatnonzero(stops_a & stops_b), np.flatnonzero(stops_a | stops_b)
        text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(ends, edges, side="right")))
        # One sort of (id, id, text) in one number brings equal ones together.
        bits = max(1, len(texts).bit_length())
        keys = np.sort(((a[(upto_a - stops_a)[ends]] << 16 | b[(upto_b - stops_b)[ends]]) << bits) | text)
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else keys
        links = np.diff(np.append(begins, len(keys)))
        pair, text = keys[begins] >> bits, keys[begins] & (1 << bits) - 1
        groups = np.diff(np.searchsorted(both, edges, side="right"))
        return Aligned(np.diff(first_a), np.diff(first_b), groups, self._digests(a, b, first_a, first_b, ends_a, ends_b, both, upto_a, upto_b), (pair >> 16) * SECOND + (pair & 0xFFFF), text, links)

    @staticmethod
    def _only(ids: np.ndarray, first: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = np.diff(first)
        return ids[np.repeat(good, counts)], np.append(0, np.cumsum(np.where(good, counts, 0)))

    def _digests(self, a, b, first_a, first_b, ends_a, ends_b, both, upto_a, upto_b) -> list[str]:
        """Digests of the groups written as ``a1,a2|b1;a3|b2``, all texts in one gather."""
        group = np.zeros(len(upto_a) + 1, np.int64)
        group[both + 1] = 1
        group = np.cumsum(group)
        group_a, group_b = group[ends_a], group[ends_b]
        # A's tokens stand before those of B of the same group and behind those of all groups before.
        before_a, before_b = np.append(0, upto_b[both])[group_a], upto_a[both][group_b]
        closes_a, closes_b = both[group_a] == ends_a, both[group_b] == ends_b
        written = np.empty(len(a) + len(b), np.int64)
        written[np.arange(len(a)) + before_a] = a * 3 + closes_a
        written[np.arange(len(b)) + before_b] = b * 3 + closes_b * 2
        flat = self.numbers.joined(written)
        starts = np.append(0, np.cumsum(self.numbers.size[written]))[first_a + first_b].tolist()
        # Without the last mark of each text.
        return [hashlib.sha256(flat[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(starts[:-1], starts[1:], strict=True)]


@functools.lru_cache(maxsize=1)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    """Kept between the tasks of a worker."""
    return Aligner(byte_path, piece_path)


def packed(container: np.ndarray, place: np.ndarray, count: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of ``count`` bitmaps over ``width`` places, from entries sorted by container and place. A list
    of 16-bit places is always shorter than the plain bitmap, which tells the two apart."""
    n = np.bincount(container, minlength=count)
    plain = -(-width // 8)
    dense = 2 * n >= plain
    offsets = np.append(0, np.cumsum(np.where(dense, np.where(n > 0, plain, 0), 2 * n)))
    out = np.zeros(offsets[-1], np.uint8)
    rank = np.arange(len(container)) - np.repeat(np.cumsum(n) - n, n)
    bits = dense[container]
    at = offsets[container[~bits]] + 2 * rank[~bits]
    out[at], out[at + 1] = place[~bits] & 255, place[~bits] >> 8
    at = offsets[container[bits]] + (place[bits] >> 3)
    np.bitwise_or.at(out, at, (1 << (place[bits] & 7)).astype(np.uint8))
    return offsets, out


def unpacked(offsets: np.ndarray, data: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(container, place) of all set bits of bitmaps with the given widths."""
    size = np.diff(offsets)
    dense = size == -(-widths // 8)
    of = np.repeat(np.arange(len(size)), size)
    bits = dense[of]
    pairs = data[~bits].astype(np.int64)
    listed, places = of[~bits][::2], pairs[::2] | pairs[1::2] << 8
    nth = np.arange(len(data)) - offsets[of]
    found = np.flatnonzero(np.unpackbits(data[bits], bitorder="little"))
    return np.concatenate([listed, of[bits][found >> 3]]), np.concatenate([places, (nth[bits][found >> 3] << 3) | (found & 7)])


def planes_of(pair: np.ndarray, place: np.ndarray, links: np.ndarray, width: int) -> tuple[np.ndarray, pa.Array]:
    """(pairs, their planes) from (pair, place) entries with their number of links."""
    order = np.lexsort((place, pair))
    pair, place, links = pair[order], place[order], links[order]
    begins = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(pair))))
    most = np.maximum.reduceat(links, begins) if len(begins) else links
    depth = np.frexp(most)[1].astype(np.int64)
    first = np.append(0, np.cumsum(depth))
    containers, places = [], []
    for k in range(int(depth.max()) if len(depth) else 0):
        has = links >> k & 1 == 1
        containers.append(first[row[has]] + k)
        places.append(place[has])
    container, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (containers, places))
    order = np.lexsort((at, container))
    offsets, data = packed(container[order], at[order], int(first[-1]), width)
    binary = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
    return pair[begins], pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), binary)


def entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, plane) of all set bits of the postings of a batch."""
    lists = batch.column("planes")
    starts = lists.offsets.to_numpy()
    depth = np.diff(starts)
    binary = lists.values.slice(starts[0], starts[-1] - starts[0])
    _, offsets, data = binary.buffers()
    offsets = np.frombuffer(offsets, np.int32)[binary.offset : binary.offset + len(binary) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    row = np.repeat(np.arange(len(batch)), depth)
    container, place = unpacked(offsets - offsets[0], data, batch.column("width").to_numpy()[row])
    return row[container], place, (np.arange(len(row)) - (starts[:-1] - starts[0])[row])[container]


def index(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Postings (``pair``, ``pack``, ``width``, ``planes``) and documents (``pack``, ``place``, and the figures of the
    document alone) of ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part = aligner(byte_path, piece_path), TaskContext.get().partitionId()
        pack, ids, rows, held, size = 0, [], [], [], 0
        schema = pa.schema([("pair", pa.int64()), ("pack", pa.int64()), ("width", pa.int32()), ("planes", pa.list_(pa.binary())), ("place", pa.int32()), ("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups")] + [("groups_sha256", pa.string())])

        def filled(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

        def made() -> Iterator[pa.RecordBatch]:
            number, width = (part << 32) + pack, len(ids)
            a, b, groups, digests = zip(*rows, strict=True)
            yield filled(width, pack=pa.array(np.full(width, number)), place=pa.array(np.arange(width, dtype=np.int32)), doc_id=pa.array(ids, pa.int64()), n_a=pa.array(a, pa.int64()), n_b=pa.array(b, pa.int64()), n_groups=pa.array(groups, pa.int64()), groups_sha256=pa.array(digests, pa.string()))
            if held:
                pairs, planes = planes_of(*(np.concatenate(x) for x in zip(*held, strict=True)), width)
                for at in range(0, len(pairs), 1 << 14):
                    some = pairs[at : at + (1 << 14)]
                    yield filled(len(some), pair=pa.array(some), pack=pa.array(np.full(len(some), number)), width=pa.array(np.full(len(some), width, np.int32)), planes=planes.slice(at, len(some)))

        def add(texts: list[tuple[int, str]]) -> None:
            out = tool.align([t for _, t in texts])
            places = np.array([p for p, _ in texts])
            held.append((out.pair, places[out.text], out.links))
            for p, *row in zip(places.tolist(), out.n_a.tolist(), out.n_b.tolist(), out.n_groups.tolist(), out.digests, strict=True):
                rows[p] = tuple(row)

        waiting, bytes_ = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                text = text.as_py()
                ids.append(doc_id.as_py())
                rows.append((0, 0, 0, ""))
                if text:
                    waiting.append((len(ids) - 1, text))
                    bytes_ += len(text)
                    size += len(text)
                full = size >= PACK or len(ids) == PLACES
                if waiting and (full or bytes_ >= CHUNK):
                    add(waiting)
                    waiting, bytes_ = [], 0
                if full:
                    yield from made()
                    pack, ids, rows, held, size = pack + 1, [], [], [], 0
        if waiting:
            add(waiting)
        if ids:
            yield from made()

    return docs.mapInArrow(run, INDEX)


def pair_counts(postings: DataFrame) -> DataFrame:
    """``pair, n_docs, n_links, best``: over all packs; ``best`` where the count is the highest of the first id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, place, plane = entries(batch)
            either = np.unique(row * PLACES + place) // PLACES
            docs, links = np.bincount(either, minlength=len(batch)), np.bincount(row, weights=2.0**plane, minlength=len(batch))
            yield pa.RecordBatch.from_arrays([batch.column("pair"), pa.array(docs.astype(np.int64)), pa.array(links.astype(np.int64))], names=["pair", "n_docs", "n_links"])

    counted = postings.select("pair", "width", "planes").mapInArrow(run, "pair long, n_docs long, n_links long")
    counts = cut_lineage(counted.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")), "pairs")
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("first")).agg(F.max("n_docs").alias("most"))
    return counts.join(most, first == F.col("first")).select("pair", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best"))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def scored(index_: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document: its own figures, and those that its postings return."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, docs, totals = None, [], np.zeros((3, PLACES), np.int64)

        def made() -> pa.RecordBatch:
            own = pa.Table.from_batches(docs).combine_chunks()
            n = totals[:, own["place"].to_numpy()]
            columns = [own[c].combine_chunks() for c in ("doc_id", "n_a", "n_b", "n_groups")]
            return pa.RecordBatch.from_arrays([*columns, *(pa.array(x) for x in n), own["groups_sha256"].combine_chunks()], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

        for batch in batches:
            packs = batch.column("pack").to_numpy()
            cuts = [0, *(np.flatnonzero(packs[1:] != packs[:-1]) + 1).tolist(), len(packs)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if low == high:
                    continue
                if packs[low] != pack:
                    if docs:
                        yield made()
                    pack, docs = packs[low], []
                    totals[:] = 0
                part = batch.slice(low, high - low)
                own = part.filter(part.column("pair").is_null())
                if len(own):
                    docs.append(own)
                posted = part.filter(part.column("pair").is_valid())
                if not len(posted):
                    continue
                row, place, plane = entries(posted)
                weight = 1 << plane
                np.add.at(totals[0], place, weight)
                np.add.at(totals[1], place, weight * posted.column("best").to_numpy(zero_copy_only=False).astype(np.int64)[row])
                np.add.at(totals[2], place, weight * posted.column("n_docs").to_numpy()[row])
        if docs:
            yield made()

    # Both sides grow with the corpus, so both are shuffled at every size.
    posted = index_.where("pair is not null").select("pair", "pack", "width", "planes").join(counts.select("pair", "n_docs", "best").hint("merge"), "pair")
    own = index_.where("pair is null").select("pack", "place", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
    together = posted.unionByName(own, allowMissingColumns=True)
    return together.repartition("pack").sortWithinPartitions("pack").mapInArrow(run, RESULT)


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """``doc_id`` and the figures of its alignment, one row per row of ``docs``; ``RESULT`` has the columns."""
    read = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    made = cut_lineage(index(read, byte_path or tokenizer_path(BYTE_FILE), piece_path or tokenizer_path(PIECE_FILE)), "postings")
    return scored(made, pair_counts(made.where("pair is not null")))
