"""Plain Python versions of the corpus operators, and the documents they are tried on."""

from __future__ import annotations

import collections
import hashlib
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Characters on both sides of the separators, and ones that other definitions of blanks would split at.
ODD = ["a\x0bb\x0cc", "x\x1cy\x1dz", "non breaking wide", "\x85next", "ÄÖÜ straße ÉCOLE", "emoji \U0001f600 end", "tab\tnew\nline\r\nend"]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    out = []
    for i in range(n):
        out.append("w%d" % int(vocabulary * rng.random() ** 2))
        out.append("\n" if rng.random() < 0.08 else " ")
    return "".join(out)


def documents(seed: int = 1, n: int = 60) -> list[tuple]:
    """Copies, near copies, shared passages, odd characters, nulls, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    texts: list[str | None] = [None, "", " \n\t ", "one", "two words", *ODD, "long " * 30_000, "x" * 300_000 + " y"]
    for _ in range(n):
        texts.append(prose(rng, rng.choice([3, 10, 40, 120, 400])))
    base = prose(rng, 300)
    for _ in range(12):
        parts = base.split(" ")
        for _ in range(rng.randrange(0, 9)):
            parts[rng.randrange(len(parts))] = "changed%d" % rng.randrange(1000)
        texts.append(" ".join(parts))
    texts += [base] * 3 + [prose(rng, 40) + passage + prose(rng, 30) for _ in range(6)]
    texts.append("loop a b c d e f g h i j k l m n o p q r s t u v " * 4)
    rows = [(i, t, "en", rng.choice(["a", "b", "c", "Z", "é", None]), len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def first_starts(rows: list[tuple], span: int = 20) -> dict:
    """doc_id -> (words, removed, digest of the kept words)."""
    seen, out = set(), {}
    for doc_id, text in sorted((r[0], r[1]) for r in [(r[0], r[1] or "") for r in rows]):
        w, gone = words(text), set()
        for i in range(len(w) - span + 1):
            window = tuple(w[i : i + span])
            if window in seen:
                gone.update(range(i, i + span))
            seen.add(window)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc_id] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def shingles(text: str | None, n: int = 5) -> set:
    w = words((text or "").translate(AZ))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def linked(rows: list[tuple], percent: int = 80) -> dict:
    """doc_id -> (size of its set, component)."""
    sets = {r[0]: shingles(r[1]) for r in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    t = text or ""
    w = words(t)
    found = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if found[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def phrase_places(text: str | None, phrases: dict[str, str]) -> tuple[int, list[int], set]:
    w = ALNUM.findall((text or "").translate(AZ))
    at, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), at, labels


def local_alignment(item: list, passage: list) -> int:
    best, row = 0, [0] * (len(passage) + 1)
    for x in item:
        above, row = row, [0]
        for j, y in enumerate(passage, 1):
            row.append(max(0, above[j - 1] + (1 if x == y else -1), above[j] - 1, row[j - 1] - 1))
            best = max(best, row[j])
    return best
