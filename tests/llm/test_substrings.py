import random

from brute import SCHEMA, documents, first_starts, prose, words

from txnmill.llm import substrings


def got(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def test_equals_brute_force(spark):
    rows = documents(4, 80)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id")
    from txnmill.session import cut_lineage

    stored = cut_lineage(df)
    assert got(substrings.remove_repeats(stored)) == first_starts(rows)


def test_small_packs(spark, monkeypatch):
    """Packs of a few documents meet only through the ranges."""
    monkeypatch.setattr(substrings, "PACK", 2000)
    rows = documents(6, 50)
    assert got(substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA))) == first_starts(rows)


def test_removed_ranges_cover_what_is_cut(spark):
    rng = random.Random(8)
    passage = prose(rng, 25)
    rows = [(2, prose(rng, 10) + passage + prose(rng, 5) + passage, "en", "a", 0), (1, passage, "en", "a", 0)]
    out = {r["doc_id"]: r for r in substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[1]["removed"] == []
    assert [(r["start"], r["stop"]) for r in out[2]["removed"]] == [(10, 35), (40, 65)]
    assert out[2]["n_removed"] == 50 and out[2]["n_words"] == len(words(rows[0][1]))


def test_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(5, text, "en", "a", 0), (5, text, "en", "a", 0), (None, text, "en", "a", 0), (6, text, "en", "a", 0), (None, None, "en", "a", 0)]
    out = sorted(((r["doc_id"], r["n_removed"]) for r in substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert out == sorted([(5, 0), (5, 0), (None, 30), (6, 30), (None, 0)], key=str)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substrings.remove_repeats(empty).count() == 0
    df = spark.createDataFrame([(1, "a b", "x", "y")], "doc_id long, text string, pack string, hits string")
    assert substrings.remove_repeats(df).first()["n_words"] == 2


def test_equal_texts_without_ids_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text)] * 3 + [(None, "x y z " + text)] + [(7, "only " * 3)]
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert sorted((r["n_words"], r["n_removed"]) for r in out) in ([(3, 0), (60, 0), (60, 60), (60, 60), (63, 60)], [(3, 0), (60, 60), (60, 60), (60, 60), (63, 0)])
