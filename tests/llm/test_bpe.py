import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from brute import SCHEMA, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from txnmill.llm import bpe

PATH = public_tokenizers.path(bpe.BYTE_FILE)
PARTS = ["a", "don", "'", "'re", "'ll", "r", "e", " ", "  ", "\n", "\t", "\r\n", "the", " quick", "12", "3", "!", "...", "é", "ß", "你好", "　", "\xa0", "<|endoftext|>", "<|endof", "text|>", "\U0001f600", "\0", "x" * 30]


def whole(text):
    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40), st.lists(st.integers(0, 120), max_size=12))
def test_joins_are_exact_for_any_cuts(tokenizer, parts, cuts):
    text = "".join(parts)
    at = sorted({0, len(text), *[c for c in cuts if c < len(text)]})
    encoder = bpe.Encoder(PATH)
    chunks = encoder.encode([text[a:b] for a, b in zip(at[:-1], at[1:])])
    assert encoder.join([chunks])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def blank_merges():
    """A byte-level tokenizer that merges blanks with blanks and signs, so that a cut within a run shows in the ids."""
    alphabet = sorted(pre_tokenizers.ByteLevel.alphabet())
    some = [pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0] for c in " \n\t\r<a's"] + ["Â", "\u0142"]
    merges = [(x, y) for x in some for y in some]
    made = Tokenizer(models.BPE({t: k for k, t in enumerate([*alphabet, *(x + y for x, y in merges)])}, merges))
    made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    made.add_special_tokens(["<|endoftext|>"])
    return made


@pytest.mark.parametrize("held", [1 << 26, 2000])
@pytest.mark.parametrize("file", ["public", "blank merges"])
def test_encoding_by_pieces_is_exact(monkeypatch, tmp_path, file, held):
    path = PATH
    if file != "public":
        path = str(tmp_path / "made.json")
        blank_merges().save(path)
        bpe.check_file(path)
    monkeypatch.setattr(bpe, "HELD", held)
    encoder, library = bpe.Encoder(path), Tokenizer.from_file(path)
    odd = [*PARTS, " ", " ", "<", " <|endoftext|>", "  <|endoftext|>  ", "<|endoftext|> a", "\x85", "\u2028", "\u200b ", "\v", "\f ", "é ", " é", " 's", "' s", "\x7f", " \n a", "\n\n", "\u0301 ", " a" + "z" * 80]

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(odd), max_size=25), max_size=6))
    def check(texts):
        texts = ["".join(t) for t in texts]
        assert [x.tolist() for x in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]

    check()


class Counting:
    """A tokenizer that adds up the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.given += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_recurring_words_are_encoded_once():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgé") for _ in range(9)) for _ in range(300)]
    # No chunk of one text is one of another: only the words recur.
    texts = [" ".join(rng.sample(words, 300)) for _ in range(30)]
    encoder = bpe.Encoder(PATH)
    encoder.tokenizer = counting = Counting(encoder.tokenizer)
    found = [ids.tolist() for k in range(0, 30, 10) for ids in encoder.encode(texts[k : k + 10])]
    assert found == [whole(t) for t in texts]
    assert counting.given < 0.3 * sum(map(len, texts))


def test_chunks_follow_the_content():
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh \n") for _ in range(20_000))
    texts = [passage, "x" * 777 + passage, "é" * 9000, "", "short"]
    import pyarrow as pa

    found = [chunks for _, chunks in bpe.chunked(pa.array(texts))]
    assert [b"".join(c).decode() for c in found] == texts
    assert len(set(found[0]) & set(found[1])) > 0.8 * len(found[0])
    assert all(len(c) <= bpe.MOST for chunks in found for c in chunks)
    assert 600 < 20_000 / len(found[0]) < 2400


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out = collections.Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        out[doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("pack", [1 << 23, 20_000])
def test_equals_the_library(spark, monkeypatch, pack):
    monkeypatch.setattr(bpe, "PACK", pack)
    monkeypatch.setattr(bpe, "AT_ONCE", 30_000)
    rows = [(r[0], r[1]) for r in documents(4, 50)]
    shared = " ".join(f"passage{i}" for i in range(400))
    rng = random.Random(2)
    for k in range(30):
        rows.append((1000 + k, "".join(rng.choice(PARTS) for _ in range(300)) + shared + "".join(rng.choice(PARTS) for _ in range(200))))
    rows += [(None, "no id"), (None, "no id"), (3, shared), (3, shared), (2000, "a<|endoftext|>b" * 400)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).selectExpr("*", "'x' AS h", "1 AS pack", "2 AS t0")
    found = bpe.encode(docs.repartition(5))
    assert collections.Counter(tuple(r) for r in found.collect()) == expected(rows)


def test_each_shared_chunk_is_encoded_once(spark, monkeypatch):
    monkeypatch.setattr(bpe, "PACK", 10_000)
    shared = " ".join(f"passage{i}" for i in range(3000))
    texts = spark.createDataFrame([(f"{k} " * 200 + shared,) for k in range(40)], "text string").selectExpr("text", "xxhash64(text) AS t0", "xxhash64(1, text) AS t1")
    cuts = bpe.chunk_packs(texts, 20).distinct()
    owners = cuts.groupBy("h").agg({"pack": "min"}).withColumnRenamed("min(pack)", "owner")
    held = cuts.join(owners, "h").selectExpr("h", "pack", "pack = owner AS own")
    several = cuts.groupBy("h").count().where("count > 1").select("h")
    made = bpe.encoded(texts, held.join(several, "h"), 20, PATH)
    keys = [bytes(r["h"]) for r in made.where("h is not null").collect()]
    assert len(keys) == len(set(keys)) == several.count() > 10


def test_empty_and_other_files(spark):
    assert bpe.encode(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        bpe.check_file(public_tokenizers.path("word_bpe_49k.json"))
