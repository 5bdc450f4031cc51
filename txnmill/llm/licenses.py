"""License scans: exact places of short notices, and fuzzy places found from exact seeds.

A notice matched with up to ``k`` errors, cut into ``k + 1`` pieces, has at least one piece without error
(pigeonhole), so the exact pieces, found by one automaton over the text, locate every candidate. The ``regex`` library
then matches the whole notice with bounded errors around each seed and gives the span and the number of errors.

The scan is one pass over the text without shuffle. Texts are lower-cased in A-Z; words are runs of
``[0-9a-z]`` and non-ASCII characters. The fuzzy search reads the words joined by single blanks, so punctuation and line
breaks between words are no errors.

Edge cases: null and empty texts have no words, no labels and score 0. Repeated rows are scanned each on its own.
Columns of the caller that are not named in ``keep`` are dropped, so none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

# Phrases that count where their words stand one after another, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Short notices that are searched with errors, with their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "licensed under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "creative commons attribution": "cc-by",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "all rights reserved": "reserved",
}


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    errors: int

    def pieces(self) -> list[tuple[int, str]]:
        """``errors + 1`` consecutive pieces of near equal length, with their positions."""
        cuts = [round(k * len(self.text) / (self.errors + 1)) for k in range(self.errors + 2)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def notices(rate: float = 0.12, texts: dict[str, str] = NOTICES) -> list[Notice]:
    """One error for every ``1 / rate`` characters, at least one."""
    return [Notice(t, label, max(1, int(rate * len(t)))) for t, label in texts.items()]


class Scanner:
    """Built once per task; ``scan`` takes one text as the blank-joined words."""

    def __init__(self, wanted: list[Notice]):
        self.wanted = wanted
        self.seeds = ahocorasick.Automaton()
        starts: dict[str, list[tuple[int, int]]] = {}
        for k, notice in enumerate(wanted):
            for at, piece in notice.pieces():
                starts.setdefault(piece, []).append((k, at))
        for piece, places in starts.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()
        # The match must begin and end at a word; of all matches in the window the best one counts.
        self.patterns = [
            regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(n.text)}){{e<={n.errors}}}(?![^ ])", regex.V1) for n in wanted
        ]

    def scan(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(label, first character, character after the last, errors, length of the notice), overlaps of a label merged."""
        # Where seeds say the notice may begin; near places are one window.
        at: dict[int, list[int]] = {}
        for end, (size, places) in self.seeds.iter(text):
            for k, offset in places:
                at.setdefault(k, []).append(end + 1 - size - offset)
        out = []
        for k, begins in at.items():
            notice, pattern = self.wanted[k], self.patterns[k]
            slack, length = notice.errors, len(notice.text)
            begins.sort()
            low, high = begins[0], begins[0]
            for begin in [*begins[1:], None]:
                if begin is not None and begin - high <= length:
                    high = begin
                    continue
                # The search finds the best match of a part; worse ones may stand before it and behind it.
                parts = [(max(0, low - slack), min(len(text), high + length + 2 * slack))]
                while parts:
                    position, stop = parts.pop()
                    if stop - position < length - slack or not (match := pattern.search(text, position, stop)):
                        continue
                    out.append((notice.label, match.start(), match.end(), sum(match.fuzzy_counts), length))
                    # Up to the blank before the match.
                    parts += [(position, match.start() - 1), (match.end(), stop)]
                if begin is not None:
                    low = high = begin
        return merged(out)


def merged(spans: list[tuple]) -> list[tuple]:
    """Spans of one label that overlap become one, with the errors and the length of the best of them."""
    out: list[tuple] = []
    for label, start, stop, errors, length in sorted(spans):
        last = out[-1] if out else None
        if last and last[0] == label and start < last[2]:
            best = min((last[3], last[4]), (errors, length), key=lambda e: e[0] / e[1])
            out[-1] = (label, last[1], max(last[2], stop), *best)
        else:
            out.append((label, start, stop, errors, length))
    return out


def _exact(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers where the words of ``phrase`` stand; ``joined`` begins and ends with a blank."""
    out, at = [], joined.find(b" " + phrase + b" ")
    before, counted = 0, 0
    while at >= 0:
        before += joined.count(b" ", counted, at)
        counted = at
        out.append(before)
        at = joined.find(b" " + phrase + b" ", at + 1)
    return out


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,start:int,stop:int,errors:int>>"
)
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("errors", pa.int32())]))


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rate: float = 0.12, texts: dict[str, str] = NOTICES) -> DataFrame:
    """One row per row of ``docs``: the columns of ``keep``, then ``SCHEMA``. ``texts`` has the notices to search, each with
    its label: lower-case words joined by one blank.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` tell of the exact phrases; ``labels`` joins the fuzzy
    ones; ``score`` is the best share of a notice without errors (1 for an exact phrase); ``spans`` are character
    ranges in the blank-joined words.
    """
    wanted = notices(rate, texts)
    phrases = {p.encode(): label for p, label in PHRASES.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(wanted)
        for batch in batches:
            carried = batch.drop_columns(["_text"])
            for low, high, offsets, data in W.chunks(batch.column("_text")):
                found = W.find(offsets, data, W.MARKS, lower=True, hashes=False)
                # Separators become blanks; the words of a text are then joined by one blank each.
                plain = np.where(W.MARKS[found.data], np.uint8(32), found.data).tobytes()
                counts, rows = found.counts.tolist(), []
                for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    joined = b" " + b" ".join(plain[a:b].split()) + b" "
                    base = {p: places for p in phrases if p in joined and (places := _exact(joined, p))}
                    at = [i for places in base.values() for i in places]
                    exact = {phrases[p] for p in base}
                    spans = scanner.scan(joined[1:-1].decode()) if counts[d] else []
                    labels = exact | {s[0] for s in spans}
                    score = max([1.0 if exact else 0.0, *(1.0 - s[3] / s[4] for s in spans)])
                    rows.append((
                        counts[d], len(at), min(at, default=None), max(at, default=None), ",".join(sorted(exact)), ",".join(sorted(labels)), score,
                        [{"label": s[0], "start": s[1], "stop": s[2], "errors": s[3]} for s in spans],
                    ))
                types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPANS]
                names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
                made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                part = carried.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *names])

    chosen = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "_text")
    return chosen.mapInArrow(run, f"{kinds}, {SCHEMA}" if kinds else SCHEMA)
