import math
import random
from collections import Counter

import numpy as np
import pytest
from brute import ALNUM, AZ, SCHEMA, documents, local_alignment, phrase_places, prose

from txnmill.llm import decontaminate, licenses, lm
from txnmill.llm import words as W


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(1, len(out) - 1)
        kind = rng.random()
        if kind < 0.4:
            out[at] = rng.choice("abcdefgh")
        elif kind < 0.7:
            del out[at]
        else:
            out.insert(at, rng.choice("abcdefgh"))
    return "".join(out)


def test_license_base_columns_equal_brute_force(spark):
    rng = random.Random(3)
    rows = documents(8, 30)
    extra = ["Released under the MIT License.", "CC BY-NC 4.0, cc by", "mit license " * 5, "GNU General\nPublic  License; Apache-License", "mit licenses mitlicense", "cc by"]
    rows += [(1000 + i, prose(rng, 20) + t + prose(rng, 20), "en", "a", 0) for i, t in enumerate(extra)] + [(2000 + i, t, "en", "a", 0) for i, t in enumerate(extra)]
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    for doc_id, text, *_ in rows:
        n, at, labels = phrase_places(text, licenses.PHRASES)
        r = out[doc_id]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (n, len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_every_notice_is_found_with_its_errors():
    rng, wanted = random.Random(11), licenses.notices()
    scanner = licenses.Scanner(wanted)
    for notice in wanted:
        for errors in range(notice.errors + 1):
            for _ in range(10):
                text = "some words before " + edited(rng, notice.text, errors) + " and after"
                spans = [s for s in scanner.scan(text) if s[0] == notice.label]
                assert any(s[3] <= errors and abs(s[1] - 18) <= errors + 1 for s in spans), (notice.text, text)
    assert scanner.scan("nothing here resembles a notice at all, " * 20) == []


def test_worse_matches_before_and_behind_the_best_are_found():
    scanner = licenses.Scanner(licenses.notices())
    spans = lambda text, label: [(text[a:b], e) for n, a, b, e, _ in scanner.scan(text) if n == label]
    assert spans("creative comons attribution creative commons attribution", "cc-by") == [("creative comons attribution", 1), ("creative commons attribution", 0)]
    three = "creative commons attributoin creative commons attribution creativ commons attribution"
    assert [e for _, e in spans(three, "cc-by")] == [2, 0, 1] and " ".join(t for t, _ in spans(three, "cc-by")) == three
    mit = "foo relesed undr the mit license bar released under the mit license baz"
    assert [e for _, e in spans(mit, "mit")] == [2, 0]


def test_overlaps_of_a_label_are_merged():
    made = licenses.merged([("a", 0, 10, 2, 10), ("a", 8, 20, 0, 12), ("b", 5, 9, 1, 4), ("a", 20, 30, 1, 10)])
    assert made == [("a", 0, 20, 0, 12), ("a", 20, 30, 1, 10), ("b", 5, 9, 1, 4)]


def test_own_notices(spark):
    df = spark.createDataFrame([(1, "All rights are resrved by the Maker!"), (2, "released under the mit license")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in licenses.scan(df, texts={"all rights are reserved by": "closed"}).collect()}
    assert out[1]["labels"] == "closed" and out[1]["spans"][0]["errors"] == 1 and out[2]["labels"] == "mit"


def test_pieces_cover_the_notice():
    for notice in licenses.notices():
        pieces = notice.pieces()
        assert len(pieces) == notice.errors + 1 and "".join(p for _, p in pieces) == notice.text


def test_license_edges(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(None, None, "x"), (1, "", "y"), (1, "mit license", "z")], "doc_id long, text string, labels string")
    out = [(r["doc_id"], r["n_words"], r["labels"], r["score"]) for r in licenses.scan(df).collect()]
    assert sorted(out, key=str) == sorted([(None, 0, "", 0.0), (1, 0, "", 0.0), (1, 2, "mit", 1.0)], key=str)


def test_alignment_equals_plain_table():
    rng = np.random.default_rng(2)
    for _ in range(300):
        item, passage = rng.integers(0, 6, rng.integers(1, 15)), rng.integers(0, 6, rng.integers(0, 30))
        score, start, stop = decontaminate.align(item, passage)
        assert score == local_alignment(item.tolist(), passage.tolist())
        assert local_alignment(item.tolist(), passage[start:stop].tolist()) == score


def test_contaminated_documents_are_found(spark):
    rng = random.Random(7)
    items = [(k, prose(rng, rng.randrange(14, 60), 5000)) for k in range(25)] + [(77, "two words"), (78, None), (79, " . ")]
    rows, truth = [], set()
    for i in range(250):
        text = prose(rng, rng.randrange(5, 300), 5000)
        if i % 5 == 0:
            k, item = items[i // 5 % 25]
            w = item.split()
            for _ in range(len(w) // 9):
                w[rng.randrange(len(w))] = "EDITED"
            if len(w) > 20:
                del w[rng.randrange(len(w))]
            text = text + " " + ", ".join(w).upper() + " " + prose(rng, 20)
            truth.add((i, k))
        rows.append((i, text, "en", "a", 0))
    rows += [(900, None, "en", "a", 0), (901, "", "en", "a", 0), (902, "say two words", "en", "a", 0), (None, items[0][1], "en", "a", 0)]
    docs, tests = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    whole = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, tests).collect()}
    assert whole == truth | {(902, 77), (None, 0)}
    # Blocks of a few items give the same.
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, tests, limit=100).collect()} == whole
    clean = decontaminate.clean(docs, tests)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {r[0] for r in rows} - {i for i, _ in whole}


def broken(rng, words, kind):
    """A copy of an item with edits spread so that few of its n-grams survive."""
    if kind == 0:
        return [w if k % 5 else f"new{k}" for k, w in enumerate(words)]
    if kind == 1:
        return [w if (k + 1) % 4 else f"new{k}" for k, w in enumerate(words)]
    if kind == 2:
        at = set(rng.sample(range(len(words)), len(words) // 5))
        return [f"new{k}" if k in at else w for k, w in enumerate(words)]
    if kind == 3:
        at = set(rng.sample(range(len(words)), len(words) // 4))
        return [f"new{k}" if k in at else w for k, w in enumerate(words)]
    return [x for k, w in enumerate(words) for x in ([w, f"new{k}"] if k % 2 and k + 1 < len(words) else [w])]


def test_heavily_edited_copies_equal_brute_force(spark):
    rng = random.Random(17)
    items = [(k, prose(rng, rng.randrange(12, 40), 300)) for k in range(12)]
    split = {k: ALNUM.findall(t.translate(AZ)) for k, t in items}
    rows = [(i, " ".join(prose(rng, rng.randrange(1, 30), 300).split() + broken(rng, split[i % 12], i % 5) + prose(rng, 10, 300).split()), "en", "a", 0) for i in range(60)]
    least, truth = decontaminate.LEAST, {}
    for doc_id, text, *_ in rows:
        words = ALNUM.findall(text.translate(AZ))
        for k, item in split.items():
            score = local_alignment(item, words)
            if score >= least * len(item):
                truth[doc_id, k] = score / len(item)
    assert len(truth) >= 50 and {i % 5 for i, _ in truth} == set(range(5))
    found = decontaminate.matches(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found} == truth


def test_part_of_a_long_item_is_found(spark):
    rng = random.Random(23)
    items = [(0, prose(rng, 57, 3000)), (1, prose(rng, 1000, 3000)), (2, prose(rng, 41, 3000))]
    split = {k: t.split() for k, t in items}
    parts = [(0, 3, 28), (0, 32, 57), (1, 300, 700), (1, 511, 531), (1, 0, 20), (1, 980, 1000), (2, 11, 31)]
    text = lambda words: f"{prose(rng, 70, 3000)} {' '.join(words)} {prose(rng, 70, 3000)}"
    rows = [(n, text(split[k][a:b]), "en", "a", 0) for n, (k, a, b) in enumerate(parts)]
    rows += [(100 + k, text(split[k][5:17]), "en", "a", 0) for k in split]
    docs = spark.createDataFrame(rows, SCHEMA)
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = {r["doc_id"]: (r["item_id"], r["score"]) for r in decontaminate.matches(docs, tests).collect()}
    assert {n: k for n, (k, _) in found.items()} == {n: k for n, (k, _, _) in enumerate(parts)}
    for n, (k, a, b) in enumerate(parts):
        assert found[n][1] >= (b - a) / len(split[k])
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, tests).collect()) == [100, 101, 102]


def test_decontamination_edges(spark):
    empty, none = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame(documents(1, 5), SCHEMA)
    assert decontaminate.matches(empty, spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0
    assert decontaminate.matches(docs, none).count() == 0 and decontaminate.clean(docs, none).count() == docs.count()


def loss(counts, single, before, symbols, sequence, alpha=lm.ALPHA, beta=lm.BETA):
    total, out, last = sum(single.values()), 0.0, None
    for s in sequence:
        p1 = (single[s] + alpha) / (total + alpha * (symbols - 1))
        out -= math.log((counts[last, s] + beta * p1) / (before[last] + beta))
        last = s
    return out / len(sequence)


def test_scores_equal_brute_force(spark):
    rows = [r for r in documents(9, 40)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r["doc_id"]: r for r in lm.score(df, df.where("source = 'a'"), words=20, classes=7).collect()}
    tokens = {r[0]: ALNUM.findall((r[1] or "").translate(AZ)) for r in rows}
    hashes = {}
    for w in {w for ws in tokens.values() for w in ws}:
        data = np.frombuffer(w.encode(), np.uint8)
        hashes[w] = int(W.find(np.array([0, len(data)]), data, W.MARKS).hash[0])
    counts = Counter(w for ws in tokens.values() for w in ws)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    top = set(sorted(counts, key=lambda w: (-counts[w], signed(hashes[w])))[:20])
    symbol = lambda w: w if w in top else hashes[w] % 7
    models = []
    for keep in (lambda r: r[3] == "a", lambda r: True):
        pair, single, before = Counter(), Counter(), Counter()
        for r in filter(keep, rows):
            last = None
            for s in map(symbol, tokens[r[0]]):
                pair[last, s] += 1
                single[s] += 1
                before[last] += 1
                last = s
        models.append((pair, single, before))
    for doc_id, ws in tokens.items():
        assert out[doc_id]["n_words"] == len(ws)
        if ws:
            expected = [loss(*m, 28, list(map(symbol, ws))) for m in models]
            assert out[doc_id]["target_loss"] == pytest.approx(expected[0], rel=1e-5)
            assert out[doc_id]["score"] == pytest.approx(expected[0] - expected[1], abs=1e-4)
        else:
            assert out[doc_id]["score"] is None


@pytest.mark.parametrize("pack, span", [(1 << 21, 1 << 18), (900, 64)])
def test_every_word_has_its_own_symbol(spark, monkeypatch, pack, span):
    monkeypatch.setattr(lm, "PACK", pack, raising=False)
    monkeypatch.setattr(lm, "RANGE", span, raising=False)
    rng = random.Random(31)
    rows = [r for r in documents(9, 40) if len(r[1] or "") < 10_000]
    rows += [(5000 + i, prose(rng, 200, 9000) + " the same pair", "en", rng.choice("ab"), 0) for i in range(60)]
    rows += [(None, "an id is missing", "en", "a", 0)] * 2 + [(6000, "the same id", "en", "a", 0)] * 2
    tokens = [ALNUM.findall((r[1] or "").translate(AZ)) for r in rows]
    symbols = 1 + len({w for ws in tokens for w in ws})
    assert symbols > 4000
    models = []
    for keep in (lambda r: r[3] == "a" and r[0] is not None, lambda r: True):
        pair, single, before = Counter(), Counter(), Counter()
        for r, ws in zip(rows, tokens):
            if keep(r):
                pair.update(zip([None, *ws], ws))
                single.update(ws)
                before.update([None, *ws][: len(ws)])
        models.append((pair, single, before))
    df = spark.createDataFrame(rows, SCHEMA)
    found = lm.score(df.repartition(3), df.where("source = 'a'")).collect()
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    expected = [(r[0], len(ws), *(loss(*m, symbols, ws) if ws else None for m in models)) for r, ws in zip(rows, tokens)]
    assert [r[:2] for r in order(found)] == [r[:2] for r in order(expected)]
    for r, e in zip(order(found), order(expected)):
        if e[1]:
            assert r[2:] == pytest.approx((*e[2:], e[2] - e[3]), rel=1e-9, abs=1e-9)
        else:
            assert r[2:] == (None, None, None)


def test_model_sums_to_one():
    rng = np.random.default_rng(0)
    cells = np.unique(rng.integers(0, 100, 60))
    cells = cells[cells % 10 > 0]
    model = lm.Model(cells, rng.integers(1, 9, len(cells)), 10, 0.1, 4.0)
    for before in range(10):
        assert np.exp(-model.loss(np.full(9, before), np.arange(1, 10))).sum() == pytest.approx(1.0, rel=1e-5)


def test_score_tells_sources_apart(spark):
    rng = random.Random(1)
    a = [f"a{i}" for i in range(40)] + ["the", "of"]
    b = [f"b{i}" for i in range(40)] + ["the", "of"]
    rows = [(i, " ".join(rng.choices(a if i % 2 else b, k=50)), "en", "a", 0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = lm.score(df, df.where("doc_id % 2 = 1 and doc_id < 150")).toPandas()
    held = out[out.doc_id >= 150]
    assert (held[held.doc_id % 2 == 1].score.max()) < held[held.doc_id % 2 == 0].score.min()


def test_lm_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lm.score(empty, empty).count() == 0
    df = spark.createDataFrame([(None, None, "target"), (1, "a b", None), (1, "a b", "x")], "doc_id long, text string, target string")
    out = lm.score(df, df.where("target = 'none'")).collect()
    assert sorted(str(r["n_words"]) for r in out) == ["0", "2", "2"]
