"""Byte-level BPE encoding with reuse of content-defined chunks, and decoding.

Method: a rolling hash of 32 bytes cuts texts into chunks of about 1,250 bytes, so that equal passages of different texts
are cut alike. Every distinct chunk is encoded once. A text's ids are those of its chunks, of which the ones around a
cut are repaired: the characters from one certain word border to another are encoded again, with one more word on either
side; where the ids of these words come out as they were, the ids between them are taken, else the part is widened.
A border is certain between visible ASCII and a blank, which no word of the splitting pattern crosses: words there
depend on nothing outside. A part without such a border is widened up to the ends of the text.

Words recur far more widely than chunks: a chunk is cut at its certain borders, a worker encodes each distinct piece once
and puts the ids of the chunk together from those of its pieces. For these cuts a blank in front of visible ASCII is a border
too, whatever stands before it: the pattern leaves the last blank of a run to the word behind, unless a special token begins
there. Pieces are compared by their bytes; those of up to ``LONGEST`` bytes are kept, in about ``HELD`` bytes of memory, beyond
which a worker starts over.

Where the work goes: texts are dealt to packs by their hash, equal texts once. First only chunk hashes travel, to find the
chunks of more than one pack; the smallest pack encodes such a chunk for all. Then each text travels once, compressed, to
its pack, which encodes its own chunks. Texts without a foreign chunk are finished there; for the others, ids of the
foreign chunks come to the pack, once each. Results go back to the rows by the text's hash, dealt over salts.

Texts and chunks are compared by 128-bit hashes. A pack holds about ``PACK`` bytes, or one longer text. Only byte-level
files with the usual pattern and no normalizer are taken; others raise ``ValueError``.

Edge cases: a null text is empty and has no tokens. Equal rows, and rows with equal or null ids, have a row each. Strings of
special tokens are the special tokens, also across a cut. Texts of any length are encoded whole; an empty table gives an
empty result. Further columns play no part.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmill.session import cut_lineage

from . import words as W
from .skew import salted_join
from .tokens import Pieces, byte_level, flat_ids, tokenizer_path

BYTE_FILE = "byte_bpe_50k.json"
#: Bytes of a chunk: least, most, and the number of hash bits that are zero at a cut.
LEAST, MOST, BITS = 256, 8192, 10
#: Bytes of the rolling hash.
SPAN = 32
#: Bytes of text in a pack, and assembled at once.
PACK, AT_ONCE = 1 << 23, 1 << 20
#: Memory of the pieces a worker keeps, and what one takes beside its bytes: entry, object, slot, place and ids.
HELD, BESIDE = 1 << 26, 160
#: Bytes of a kept piece, and pieces encoded as one text.
LONGEST, TOGETHER = 64, 256

GEAR = (W.mix(np.arange(1, 257, dtype=np.uint64) * W.BASE) >> np.uint64(32)).astype(np.uint32)


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places where a chunk may begin by content: the ``SPAN`` bytes before hash to zeros, and a character begins."""
    hashed = GEAR[data]
    step = 1
    while step < SPAN:
        longer = hashed.copy()
        longer[step:] += hashed[:-step] << np.uint32(step)
        hashed, step = longer, 2 * step
    at = np.flatnonzero(hashed[:-1] >> np.uint32(32 - BITS) == 0) + 1
    return at[data[at] & 0xC0 != 0x80]


def chunk_starts(data: np.ndarray, low: int, high: int, places: list[int]) -> list[int]:
    """First bytes of the chunks of the text ``data[low:high]``."""
    if low == high:
        return []
    starts = [low]
    while high - low > LEAST:
        k = bisect_left(places, low + LEAST)
        at = min(places[k] if k < len(places) else high, high)
        if at - low > MOST:
            at = low + MOST
            while data[at] & 0xC0 == 0x80:
                at -= 1
        if at >= high:
            break
        starts.append(at)
        low = at
    return starts


def chunked(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(row, chunks) of each text."""
    for row, _, offsets, data in W.chunks(texts):
        raw, places = data.tobytes(), cut_places(data).tolist() if len(data) > SPAN else []
        for k, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            starts = chunk_starts(data, low, high, places)
            yield row + k, [raw[a:b] for a, b in zip(starts, [*starts[1:], high], strict=False)]


def key_of(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


class Encoder:
    """Encodes chunks, and joins the ids of chunks to the ids of their text."""

    def __init__(self, path: str):
        self.tokenizer, pieces = byte_level(path, plain=False)
        self.kind = np.uint16 if len(pieces.size) <= 1 << 16 else np.uint32
        self.pieces = pieces
        last, first = np.zeros(len(pieces.size), np.uint8), np.zeros(len(pieces.size), np.uint8)
        some = pieces.size > 0
        first[some] = pieces.flat[pieces.start[some]]
        last[some] = pieces.flat[pieces.start[some] + pieces.size[some] - 1]
        self.ends_visible = (last > 0x20) & (last < 0x7F)
        self.begins_blank = (first == 0x20) | (first == 0x0A)
        self.visible = np.zeros(256, bool)
        self.visible[0x21:0x7F] = True
        #: Visible ASCII that begins no special token.
        self.plain = self.visible.copy()
        self.plain[[t.content.encode()[0] for t in self.tokenizer.get_added_tokens_decoder().values()]] = False
        self.leads = {bytes([0x20, c]) for c in np.flatnonzero(self.plain)}
        self._start_over()

    def _start_over(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.ids, self.held = Pieces(np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64)), 0

    def _together(self, pieces: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """``pieces`` in another order, their ids, and the place of the first id of each and the end. A piece that begins
        with a blank and a plain character may stand behind any other, so these are encoded many at a time."""
        alone, after = [], []
        for p in pieces:
            (after if p[:2] in self.leads else alone).append(p)
        texts = alone + [b"".join(after[k : k + TOGETHER]) for k in range(0, len(after), TOGETHER)]
        pieces = alone + after
        ids, _ = flat_ids([e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)])
        ends, bounds = np.cumsum(self.pieces.size[ids]), np.cumsum([len(p) for p in pieces])
        first = np.append(0, np.searchsorted(ends, bounds) + 1)
        if self.pieces.joined(ids).tobytes() == b"".join(pieces) and np.array_equal(ends[first[1:] - 1], bounds):
            return pieces, ids, first
        # A vocabulary without some byte: the ids do not tell where a piece ends.
        return pieces, *flat_ids([e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)])

    def _behind(self, known: Pieces, pieces: list[bytes]) -> tuple[dict[bytes, int], Pieces]:
        """The slots of distinct new ``pieces``, and ``known`` with their ids behind."""
        if not pieces:
            return {}, known
        pieces, ids, first = self._together(pieces)
        slots = dict(zip(pieces, range(len(known.size), len(known.size) + len(pieces)), strict=True))
        joined = ((known.flat, ids.astype(self.kind)), (known.start, first[:-1] + len(known.flat)), (known.size, np.diff(first)))
        return slots, Pieces(*map(np.concatenate, joined))

    def piece_starts(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """First bytes of the pieces of the texts between ``edges``: places no word of the pattern crosses."""
        starts = np.zeros(len(data), bool)
        blank = data == 0x20
        starts[:-1] = blank[:-1] & self.plain[data[1:]]
        # A blank that ends a text stays with its run.
        starts[edges[1:][edges[1:] > 0] - 1] = False
        starts[1:] |= self.visible[data[:-1]] & (blank[1:] | (data[1:] == 0x0A))
        starts[edges[edges < len(data)]] = True
        return np.flatnonzero(starts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as a whole."""
        raw = [t.encode() for t in texts]
        flat, edges = b"".join(raw), np.append(0, np.cumsum([len(r) for r in raw], dtype=np.int64))
        start = self.piece_starts(np.frombuffer(flat, np.uint8), edges)
        ends = np.append(start[1:], len(flat)).tolist()
        pieces = list(map(flat.__getitem__, map(slice, start.tolist(), ends)))
        if self.held > HELD:
            self._start_over()
        slots, ids = list(map(self.slots.get, pieces)), self.ids
        new = dict.fromkeys(p for p, slot in zip(pieces, slots, strict=True) if slot is None)
        if new:
            kept = [p for p in new if len(p) <= LONGEST]
            added, self.ids = self._behind(self.ids, kept)
            self.slots.update(added)
            self.held += sum(map(len, kept)) + BESIDE * len(kept)
            passing, ids = self._behind(self.ids, [p for p in new if len(p) > LONGEST])
            added |= passing
            slots = [added[p] if slot is None else slot for p, slot in zip(pieces, slots, strict=True)]
        slots = np.array(slots, np.int64)
        out, first = ids.joined(slots), np.append(0, np.cumsum(ids.size[slots]))
        # Copies, as a kept chunk would hold the ids of all.
        return [out[a:b].copy() for a, b in itertools.pairwise(first[np.searchsorted(start, edges)].tolist())]

    def decode(self, ids: np.ndarray) -> str:
        """As the library: the tokens' bytes, special tokens among them, read as UTF-8."""
        return self.pieces.joined(ids).tobytes().decode("utf-8", "replace")

    def borders(self, ids: np.ndarray) -> np.ndarray:
        """Certain word borders: places of tokens, with both ends."""
        inner = np.flatnonzero(self.ends_visible[ids[:-1]] & self.begins_blank[ids[1:]]) + 1
        return np.concatenate([[0], inner, [len(ids)]])

    def join(self, texts: list[list[np.ndarray]]) -> list[np.ndarray]:
        """The ids of each text from those of its chunks."""
        out = [np.concatenate(parts) if parts else np.zeros(0, self.kind) for parts in texts]
        waiting = []
        for k, parts in enumerate(texts):
            if len(parts) < 2:
                continue
            borders = self.borders(out[k])
            cuts = np.cumsum([len(p) for p in parts[:-1]])
            right = np.searchsorted(borders, cuts)
            open_ = borders[np.minimum(right, len(borders) - 1)] != cuts
            low = -1
            for r in right[open_].tolist():
                # The cut lies between two borders; a part may hold several cuts.
                if r - 1 > low:
                    waiting.append((k, borders, r - 1, r))
                    low = r - 1
        repaired: dict[int, list] = {}
        while waiting:
            spans = [(out[k], b[max(x - 1, 0)], b[min(y + 1, len(b) - 1)]) for k, b, x, y in waiting]
            again = self.encode([self.pieces.joined(ids[a:z]).tobytes().decode() for ids, a, z in spans])
            wider = []
            for (k, b, x, y), (ids, a, z), new in zip(waiting, spans, again, strict=True):
                before, behind = b[x] - a, z - b[y]
                if np.array_equal(new[:before], ids[a : b[x]]) and np.array_equal(new[len(new) - behind :], ids[b[y] : z]) and before + behind <= len(new):
                    repaired.setdefault(k, []).append((b[x], b[y], new[before : len(new) - behind]))
                else:
                    wider.append((k, b, max(x - 1, 0), min(y + 1, len(b) - 1)))
            waiting = wider
        for k, parts in repaired.items():
            made, at = [], 0
            for low, high, new in sorted(parts, key=lambda p: (p[0], -p[1])):
                if high <= at:
                    continue
                if low < at:
                    # Widened parts that overlap: the text as a whole.
                    made, at = self.encode([self.pieces.joined(out[k]).tobytes().decode()]), len(out[k])
                    break
                made += [out[k][at:low], new]
                at = high
            out[k] = np.concatenate([*made, out[k][at:]])
        return out


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """Kept between the tasks of a worker."""
    return Encoder(path)


RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def figures(encoder: Encoder, ids: np.ndarray) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(encoder.decode(ids).encode()).hexdigest()


def chunk_packs(texts: DataFrame, packs: int) -> DataFrame:
    """``h, pack``: the hash of every chunk and the pack of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dealt, keys, rows = batch.column("t0").to_numpy() % packs, [], []
            for row, chunks in chunked(batch.column("text")):
                keys += [key_of(c) for c in chunks]
                rows += [row] * len(chunks)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(dealt[np.array(rows, np.int64)])], names=["h", "pack"])

    return texts.mapInArrow(run, "h binary, pack long")


ENCODED = f"t0 long, t1 long, {RESULT}, pack long, counts array<int>, keys array<binary>, h binary, ids binary"


def _rows(done: list, partial: list, chunks: list) -> pa.RecordBatch:
    """Rows of ``ENCODED``: finished texts, texts with foreign chunks, and chunks for other packs."""
    squeeze = zstandard.ZstdCompressor(level=1)
    n, p, c = len(done), len(partial), len(chunks)

    def column(kind: pa.DataType, a=(), b=(), z=()) -> pa.Array:
        return pa.array([*(a or [None] * n), *(b or [None] * p), *(z or [None] * c)], kind)

    return pa.RecordBatch.from_arrays(
        [
            *(column(pa.int64(), [d[k] for d in done], [q[k] for q in partial]) for k in (0, 1)),
            *(column(t, [d[2][k] for d in done]) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))),
            column(pa.int64(), (), [q[2] for q in partial]),
            column(pa.list_(pa.int32()), (), [[-1 if x is None else len(x) for x in q[3]] for q in partial]),
            column(pa.list_(pa.binary()), (), [q[4] for q in partial]),
            column(pa.binary(), (), (), [h for h, _ in chunks]),
            column(pa.binary(), (), [squeeze.compress(b"".join(x.tobytes() for x in q[3] if x is not None)) for q in partial], [x.tobytes() for _, x in chunks]),
        ],
        names=["t0", "t1", "n_tokens", "ids_sha256", "decoded_sha256", "pack", "counts", "keys", "h", "ids"],
    )


def encoded(texts: DataFrame, shared: DataFrame, packs: int, path: str) -> DataFrame:
    """Each distinct text in its pack; ``shared`` has ``h, pack, own``. Rows as ``_rows`` says."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, seen = zstandard.ZstdCompressor(level=3), set()
        for batch in batches:
            t0, t1, packed, raw = [], [], [], batch.column("text")
            for k, key in enumerate(zip(batch.column("t0").to_pylist(), batch.column("t1").to_pylist(), strict=True)):
                if key not in seen:
                    seen.add(key)
                    t0.append(key[0])
                    t1.append(key[1])
                    packed.append(squeeze.compress(raw[k].as_buffer()))
            at = np.array(t0, np.int64) % packs
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(t0, pa.int64()), pa.array(t1, pa.int64()), pa.array(packed, pa.binary())], names=["pack", "t0", "t1", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, unpack = encoder_of(path), zstandard.ZstdDecompressor()
        pack, owned, known, last, held, size = None, {}, {}, None, [], 0

        def made() -> pa.RecordBatch:
            ready, needed = [], {}
            for row, chunks in chunked(pa.array([t for _, _, t in held], pa.large_binary())):
                keys = [key_of(c) for c in chunks]
                ready.append(keys)
                needed.update((k, c) for k, c in zip(keys, chunks, strict=True) if k not in known and owned.get(k, True))
            chunks = []
            for k, ids in zip(needed, encoder.encode([c.decode() for c in needed.values()]), strict=True):
                known[k] = ids
                if k in owned:
                    chunks.append((k, ids))
            parts = [[known.get(k) for k in keys] for keys in ready]
            whole = [k for k, p in enumerate(parts) if all(x is not None for x in p)]
            done = [(*held[k][:2], figures(encoder, ids)) for k, ids in zip(whole, encoder.join([parts[k] for k in whole]), strict=True)]
            rest = sorted(set(range(len(parts))) - set(whole))
            partial = [(*held[k][:2], pack, parts[k], [h for h, x in zip(ready[k], parts[k], strict=True) if x is None]) for k in rest]
            return _rows(done, partial, chunks)

        for batch in batches:
            columns = (batch.column(c) for c in ("pack", "t0", "t1", "packed", "h", "own"))
            for at, t0, t1, packed, h, own in zip(*columns, strict=True):
                at = at.as_py()
                if at != pack:
                    if held:
                        yield made()
                    pack, owned, known, last, held, size = at, {}, {}, None, [], 0
                if h.is_valid:
                    owned[h.as_py()] = own.as_py()
                    continue
                key = (t0.as_py(), t1.as_py())
                if key == last:
                    continue
                last = key
                held.append((*key, unpack.decompress(packed.as_buffer())))
                size += len(held[-1][2])
                if size >= AT_ONCE:
                    yield made()
                    held, size = [], 0
        if held:
            yield made()

    sent = texts.mapInArrow(send, "pack long, t0 long, t1 long, packed binary")
    both = sent.unionByName(shared.select("pack", "h", "own"), allowMissingColumns=True).repartition("pack")
    # Chunks before texts, equal texts side by side.
    return both.sortWithinPartitions("pack", F.col("t0").asc_nulls_first(), "t1").mapInArrow(run, ENCODED)


def finished(partial: DataFrame, chunks: DataFrame, path: str) -> DataFrame:
    """``t0, t1`` and the figures of the texts with foreign chunks; ``chunks`` has ``pack, h, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, unpack = encoder_of(path), zstandard.ZstdDecompressor()
        pack, known, held, size = None, {}, [], 0

        def made() -> pa.RecordBatch:
            ids = encoder.join([p for _, _, p in held])
            return _rows([(*held[k][:2], figures(encoder, x)) for k, x in enumerate(ids)], [], []).select(["t0", "t1", "n_tokens", "ids_sha256", "decoded_sha256"])

        for batch in batches:
            for at, t0, t1, counts, keys, h, ids in zip(*(batch.column(c) for c in ("pack", "t0", "t1", "counts", "keys", "h", "ids")), strict=True):
                at = at.as_py()
                if at != pack:
                    if held:
                        yield made()
                    pack, known, held, size = at, {}, [], 0
                if h.is_valid:
                    known[h.as_py()] = np.frombuffer(ids.as_py(), encoder.kind)
                    continue
                own, place, parts, missing = np.frombuffer(unpack.decompress(ids.as_buffer()), encoder.kind), 0, [], iter(keys.as_py())
                for n in counts.as_py():
                    parts.append(known[next(missing)] if n < 0 else own[place : place + n])
                    place += max(n, 0)
                held.append((t0.as_py(), t1.as_py(), parts))
                size += sum(map(len, parts))
                if size >= AT_ONCE:
                    yield made()
                    held, size = [], 0
        if held:
            yield made()

    both = partial.unionByName(chunks, allowMissingColumns=True).repartition("pack")
    return both.sortWithinPartitions("pack", F.col("t0").asc_nulls_first()).mapInArrow(run, f"t0 long, t1 long, {RESULT}")


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``."""
    path = path or tokenizer_path(BYTE_FILE)
    check_file(path)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    read = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("t0"), F.xxhash64(F.lit(1), whole).alias("t1"))
    size = read.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    packs = max(1, -(-size // PACK))
    texts = read.select("text", "t0", "t1")

    cuts = cut_lineage(chunk_packs(texts, packs).distinct(), "cuts")
    owners = cuts.groupBy("h").agg(F.min("pack").alias("owner"), F.max("pack").alias("top")).where("owner < top").select("h", "owner")
    shared = cut_lineage(salted_join(cuts, owners, ["h"], ["pack"], "inner").select("h", "pack", (F.col("pack") == F.col("owner")).alias("own")), "shared")
    made = cut_lineage(encoded(texts, shared, packs, path), "encoded")
    foreign = salted_join(shared.where("not own").select("h", "pack"), made.where("h is not null").select("h", "ids"), ["h"], ["pack"], "inner")
    rest = finished(made.where("keys is not null").select("t0", "t1", "pack", "counts", "keys", "ids"), foreign.select("pack", "h", "ids"), path)
    results = made.where("n_tokens is not null").select("t0", "t1", "n_tokens", "ids_sha256", "decoded_sha256").union(rest)
    joined = salted_join(read.select("doc_id", "t0", "t1"), cut_lineage(results, "texts"), ["t0", "t1"], ["doc_id"], "inner")
    return joined.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def check_file(path: str) -> None:
    """Raises where the file is no byte-level BPE with the usual pattern, whose word borders are known here."""
    import json

    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    split = made["pre_tokenizer"] or {}
    if made["model"]["type"] != "BPE" or made["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        raise ValueError(f"{path} is not a byte-level BPE file without normalizer")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(" \n") for t in made["added_tokens"]):
        raise ValueError(f"{path} has added tokens with blanks")
