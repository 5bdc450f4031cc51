import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import SCHEMA, documents
from tokenizers import Tokenizer

from txnmill.llm import alignment
from txnmill.llm.tokens import byte_alphabet

NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    a_model = Tokenizer.from_file(public_tokenizers.path(alignment.BYTE_FILE))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECE_FILE))
    alphabet = byte_alphabet()

    def piece(name):
        return bytes([int(name[3:-1], 16)]) if len(name) == 6 and name.startswith("<0x") else name.replace("▁", " ").encode()

    out, linked = [], []
    for doc_id, text in rows:
        spaced = (" " + (text or "")).encode()
        a = a_model.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        sizes = [[bytes(alphabet[c] for c in a_model.id_to_token(i)) for i in a], [piece(b_model.id_to_piece(i)) for i in b]]
        if any(b"".join(s) != spaced for s in sizes):
            a, b, sizes = [], [], [[], []]
        ends = [list(np.cumsum([len(x) for x in s])) if s else [] for s in sizes]
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for e in shared:
            x, y = i, j
            while i < len(a) and ends[0][i] <= e:
                i += 1
            while j < len(b) and ends[1][j] <= e:
                j += 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        links = []
        for k, x in enumerate(a):
            low = ends[0][k - 1] if k else 0
            links += [(x, y) for m, y in enumerate(b) if (ends[1][m - 1] if m else 0) < ends[0][k] and ends[1][m] > low]
        linked.append(links)
        out.append([len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    count = collections.Counter(p for links in linked for p in set(links))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    return collections.Counter(
        (row[0], r[0], r[1], r[2], r[3], sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), r[4])
        for row, r, links in zip(rows, out, linked)
    )


def short(rows):
    return [(r[0], r[1][:6000] if r[1] else r[1]) for r in rows]


@pytest.mark.parametrize("pack", [1 << 24, 3000])
def test_equals_brute_force(spark, monkeypatch, pack):
    monkeypatch.setattr(alignment, "PACK", pack)
    monkeypatch.setattr(alignment, "CHUNK", 2000)
    rows = short(documents(3, 30))
    rows += [(None, "no id at all"), (None, "no id at all"), (7, "the same id"), (7, "the same id"), (900, "  two  blanks "), (901, "▁ mark"), (902, "<s> <|endoftext|> </s><unk>"), (903, "a\0b\r\n"), (904, "你好世界 " * 5), (905, "the " * 700)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).selectExpr("*", "1 AS pair", "'x' AS pack")
    found = alignment.align(docs.repartition(3)).collect()
    assert collections.Counter((r["doc_id"], *[r[c] for c in NAMES]) for r in found) == brute(rows)


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    for width in (1, 9, 400, 65536):
        pair, place = np.divmod(np.unique(rng.integers(0, 40 * width, 3000)), width)
        keep = rng.random(len(pair)) < np.where(pair % 3 == 0, 1, 0.1)
        pair, place = pair[keep], place[keep]
        links = rng.integers(1, 40, len(pair))
        pairs, planes = alignment.planes_of(pair * 7, place, links, width)
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays([planes, pa.array(np.full(len(pairs), width, np.int32))], names=["planes", "width"])
        row, at, plane = alignment.entries(batch)
        got = collections.Counter()
        for r, p, k in zip(row.tolist(), at.tolist(), plane.tolist()):
            got[(int(pairs[r]), p)] += 1 << k
        assert got == {(int(x) * 7, int(y)): int(n) for x, y, n in zip(pair, place, links)}


def test_empty(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r["n_a"] for r in alignment.align(spark.createDataFrame([(1, None, None, None, None)], SCHEMA)).collect()] == [0]


def whole(a, b, texts):
    a_ids = [e.ids for e in a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    return a_ids, b.encode(texts, num_threads=1)


def test_pieces_are_encoded_as_in_the_whole_text(monkeypatch):
    rng = random.Random(4)
    parts = [" ", " ", " ", " ", "  ", "\n", "\t ", " \n", "'s", "'ll ", "don't", "a", "The", "x9", "42", ",", ". ", "!?", "\u00a0", "\u3000", "\u0301", "\u2581", "\u2581 ", "é", "你好", "\U0001f600", "\0", "<s>", "<|endoftext|>", "</s>", "\x1c", "\x85", "-", "_", "' s"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 40))) for _ in range(2000)]
    texts += [" ", "  ", " a", "a ", " a ", "a b", "x" * 300 + " y " + "z" * 200 + " 'll", "it 's 've"]
    aligner = alignment.Aligner(public_tokenizers.path(alignment.BYTE_FILE), public_tokenizers.path(alignment.PIECE_FILE))
    expected = whole(aligner.a, aligner.b, texts)
    assert aligner.cuts
    for held in (1 << 20, 50):
        monkeypatch.setattr(alignment, "HELD", held)
        for low in range(0, len(texts), 97):
            some = texts[low : low + 97]
            raw = [b" " + t.encode() for t in some]
            a, first_a, b, first_b = aligner._ids(raw, np.array([len(r) for r in raw]))
            assert [a[x:y].tolist() for x, y in zip(first_a[:-1], first_a[1:])] == expected[0][low : low + 97]
            assert [b[x:y].tolist() for x, y in zip(first_b[:-1], first_b[1:])] == expected[1][low : low + 97]


def test_equal_pieces_are_encoded_once():
    class Counting:
        def __init__(self, model):
            self.model, self.given = model, 0

        def __getattr__(self, name):
            def call(texts, **options):
                self.given += sum(map(len, texts))
                return getattr(self.model, name)(texts, **options)

            return call

    aligner = alignment.Aligner(public_tokenizers.path(alignment.BYTE_FILE), public_tokenizers.path(alignment.PIECE_FILE))
    aligner.a, aligner.b = Counting(aligner.a), Counting(aligner.b)
    text = " ".join(f"word{i % 50}," for i in range(1000))
    for _ in range(3):
        assert len(aligner.align([text + str(i) for i in range(20)]).digests) == 20
    assert aligner.a.given < len(text) and aligner.b.given < len(text)
