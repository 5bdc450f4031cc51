import random

import numpy as np
import pytest
from brute import SCHEMA, documents, linked, prose

from txnmill.llm import components, jaccard


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("listed", [1 << 20, 50, 0])
def test_components_equal_brute_force(spark, listed):
    """The classes of frequent shingles plan the work; no result depends on them."""
    rows = documents()
    assert got(jaccard.join(spark.createDataFrame(rows, SCHEMA), listed=listed)) == linked(rows)


def test_chains_of_edits(spark):
    """Each text is linked with its neighbours only; the component is the whole chain."""
    rng = random.Random(5)
    parts, rows = prose(rng, 200).split(), []
    for i in range(25):
        rows.append((100 - i, " ".join(parts), "en", "a", 0))
        for _ in range(2):
            parts[rng.randrange(len(parts))] = f"new{i}"
    assert got(jaccard.join(spark.createDataFrame(rows, SCHEMA))) == linked(rows)


def test_many_near_copies_of_two_kinds(spark, monkeypatch):
    """Low bounds of the classes send whole groups through pairs and triples."""
    monkeypatch.setattr(jaccard, "PAIRS_FROM", 4)
    monkeypatch.setattr(jaccard, "TRIPLES_FROM", 16)
    rng = random.Random(3)
    shared, rows = prose(rng, 90).split(), []
    for kind in range(2):
        base = shared + prose(rng, 60).split()
        for i in range(40):
            parts = list(base)
            for _ in range(rng.randrange(6)):
                parts[rng.randrange(len(parts))] = f"edit{rng.randrange(500)}"
            rows.append((kind * 1000 + i, " ".join(parts), "en", "a", 0))
    assert got(jaccard.join(spark.createDataFrame(rows, SCHEMA))) == linked(rows)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 31, 33, 64, 127, 300, 1100):
        for _ in range(6):
            x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            drop = rng.integers(0, len(x) - jaccard.least_overlap(len(x), 80) + 1)
            y = np.sort(rng.permutation(x)[: len(x) - drop])
            for bands in (np.zeros(len(x)), rng.choice([0, 7, 12], len(x)), np.full(len(x), 13), np.full(len(x), 8)):
                bands = bands.astype(np.uint8)
                a = jaccard.signatures(x, bands, 80)
                b = jaccard.signatures(y, bands[np.isin(x, y)], 80)
                assert any(len(np.intersect1d(p, q)) for p, q in zip(a, b, strict=True))


def test_choices():
    assert jaccard.choices(4, 2).tolist() == [[0, 1], [0, 2], [0, 3], [1, 2], [1, 3], [2, 3]]
    assert sorted(map(tuple, jaccard.choices(5, 3).tolist())) == sorted(__import__("itertools").combinations(range(5), 3))


def test_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h i j k l m n o p"
    rows = [(7, text, "en", "a", 0), (7, text, "en", "a", 0), (None, text, "en", "a", 0), (None, "other words here that differ", "en", "a", 0), (9, None, "en", "a", 0), (9, "", "en", "a", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()), key=str)
    assert out == sorted([(7, 12, 7), (7, 12, 7), (None, 12, 7), (None, 1, None), (9, 0, 9), (9, 0, 9)], key=str)
    kept = sorted(((r["doc_id"], r["text"]) for r in jaccard.keep_one(df).collect()), key=str)
    assert kept == sorted([(7, text), (None, "other words here that differ"), (9, None), (9, "")], key=str)


def test_near_copies_without_ids_and_texts_that_share_an_id(spark):
    rng = random.Random(31)
    base = prose(rng, 80, 4000).split()
    near = [" ".join(base), " ".join([*base[:-1], "edited"]), " ".join(["edited", *base[1:]])]
    # Two thirds of the words in common: a shared signature, and no link.
    half = base[:54] + prose(rng, 26, 4000).split()
    rows = [(None, t, "en", "a", 0) for t in near] + [(5, " ".join(half), "en", "a", 0), (5, near[0], "en", "a", 0), (5, prose(rng, 60, 4000), "en", "a", 0)]
    for chosen in (rows[:3], rows[3:], rows):
        truth = linked([(i, r[1]) for i, r in enumerate(chosen)])
        df = spark.createDataFrame(chosen, SCHEMA)
        out = jaccard.join(df).collect()
        assert len({r["root"] for r in out}) == len({c for _, c in truth.values()})
        assert jaccard.keep_one(df).count() == len({c for _, c in truth.values()})


def test_keep_one_keeps_columns_and_the_smallest_id(spark):
    rows = documents(2)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "doc_id * 2 AS _set", "'x' AS fp")
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    parts = linked(rows)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for n, c in parts.values() if n} | {i for i, (n, _) in parts.items() if not n})


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert jaccard.join(empty).count() == 0
    assert jaccard.keep_one(empty).count() == 0


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (60, 100)]
    out = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 100: 50}
