import binascii
import random

import duckdb
import numpy as np
import pytest
from brute import SCHEMA, documents, words
from compare import differences
from pyspark.sql import functions as F

from txnmill.llm import mixing, sharding


def on_duck(rows, sql):
    import pyarrow as pa

    con = duckdb.connect()
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    table = pa.table({n.split()[0]: pa.array(c, t) for n, c, t in zip(SCHEMA.split(", "), columns, kinds, strict=True)})
    con.register("documents", table)
    return con.execute(sql).to_arrow_table()


def test_mix_equals_sql_with_nulls_and_odd_texts(spark):
    rows = documents(7, 100)
    assert differences(mixing.mix(spark.createDataFrame(rows, SCHEMA)).toArrow(), on_duck(rows, mixing.oracle())) == []


def test_targets_by_repeated_resharing(spark):
    rng = random.Random(4)
    for _ in range(5):
        sizes = [(f"s{i:02d}", rng.choice([0, 1, 10, 100, 1000])) for i in range(rng.randrange(1, 12))]
        weights = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
        pool, target, full = 1.5 * sum(n for _, n in sizes), [0.0] * len(sizes), set()
        while True:
            open_ = [k for k in range(len(sizes)) if k not in full]
            rest = pool - sum(2 * sizes[k][1] for k in full)
            for k in open_:
                target[k] = rest * weights[k] / sum(weights[j] for j in open_)
            over = {k for k in open_ if target[k] > 2 * sizes[k][1]}
            if not over:
                break
            full |= over
            for k in full:
                target[k] = 2.0 * sizes[k][1]
        out = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
        assert [out[s] for s, _ in sizes] == pytest.approx(target)


def test_mix_laws(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randrange(0, 200), "en", "hot" if i % 3 == 0 else f"s{rng.randrange(6)}", 0) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(df, keep=("source",)).toPandas()
    assert (out.taken <= 2 * out["size"]).all() and (out.taken >= 0).all()
    by = out.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert np.allclose(by.taken, by.target, rtol=0.02)
    again = mixing.mix(df.repartition(7), keep=("source",)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert out.sort_values(key)[key].values.tolist() == again.sort_values(key)[key].values.tolist()
    copies = mixing.mixed_rows(df)
    assert copies.columns == df.columns
    running_sum_law(out, {r["doc_id"]: r["count"] for r in copies.groupBy("doc_id").count().collect()})


def running_sum_law(out, copies):
    """Words of each source come within one document of what the mix takes, and no document stands more than twice."""
    assert max(copies.values()) <= 2
    for _, rows in out.groupby("source", dropna=False):
        words = sum(copies.get(r.doc_id, 0) * r.size for r in rows.itertuples())
        assert abs(words - rows.taken.sum()) <= rows["size"].max()


def test_a_third_of_the_rows_without_id(spark):
    """Rows without an id are documents of their own: each source reaches its target, equal rows are shared evenly."""
    rng = random.Random(3)
    rows = [(None if i % 3 == 0 else i, f"t{i} " + "w " * rng.randrange(1, 150), "en", "hot" if i % 3 == 0 else f"s{i % 4}", 0) for i in range(1800)]
    rows += [(None, "the same row " * 20, "en", "hot", 0)] * 40
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(df, keep=("source",)).toPandas()
    copies = mixing.mixed_rows(df).toPandas()
    copies["words"] = copies.text.str.split().str.len()
    for source, part in out.groupby("source"):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 0.02 * part.target.iloc[0]
        assert abs(copies[copies.source == source].words.sum() - part.target.iloc[0]) <= 0.02 * part.target.iloc[0] + part["size"].max()
    times = copies.groupby(["text", "source"]).size()
    known = {(r[1], r[3]): 0 for r in rows}
    for r in rows:
        known[r[1], r[3]] += 1
    assert all(n <= 2 * known[k] for k, n in times.items())


def test_words_of_mixed_rows_reach_the_targets(spark):
    """Documents longer than a block, of which rounding each on its own loses or doubles a whole source."""
    rng = random.Random(12)
    rows = [(i, "w " * int(min(3000, 20 * rng.paretovariate(1.1))), "en", "hot" if i % 3 == 0 else f"s{i % 5}", 0) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(df, keep=("source",)).toPandas()
    targets = out.groupby("source").target.first()
    copies = mixing.mixed_rows(df)
    found = {r["source"]: r["words"] for r in copies.selectExpr("source", "size(split(trim(text), ' ')) AS n").groupBy("source").agg(F.sum("n").alias("words")).collect()}
    assert set(found) == set(targets.index)
    for source, target in targets.items():
        assert abs(found[source] - target) <= 0.02 * target + out[out.source == source]["size"].max(), source
    assert max(r["count"] for r in copies.groupBy("doc_id").count().collect()) <= 2
    again = mixing.mixed_rows(df.repartition(7))
    assert sorted(r["doc_id"] for r in again.collect()) == sorted(r["doc_id"] for r in copies.collect())


def test_mix_edges(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mixed_rows(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b", "en", None, 0), (None, None, "en", None, 0), (1, "a b", "en", None, 0), (1, "a b", "en", None, 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS size", "2 AS shard", "3 AS target")
    assert sorted(r["taken"] for r in mixing.mix(df).collect())[0] == 0
    assert mixing.mix(spark.createDataFrame([(1, None, "en", "a", 0)], SCHEMA).select("*")).first()["taken"] == 0


def checked(out, rows):
    assert sorted(out["size"]) == sorted(len((r[1] or "").encode()) + 8 for r in rows)
    assert sorted(out.text_crc32) == sorted(binascii.crc32((r[1] or "").encode()) for r in rows)
    for _, slots in out.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))


def test_shards_balance_three_sums(spark):
    rng = random.Random(6)
    rows = [(i, ("tok " if i % 2 else "longerword ") * int(rng.paretovariate(1.5) * 20), "en", "a", 0) for i in range(4000)]
    rows += [(10_000 + i, "the same text in a third of all rows", "en", "a", 0) for i in range(2000)]
    out = sharding.shard(spark.createDataFrame(rows, SCHEMA), shards=8).toPandas()
    checked(out, rows)
    assert out.shard.between(0, 7).all()
    by = out.groupby("shard").agg(b=("size", "sum"), t=("n_tokens", "sum"), n=("slot", "count"))
    assert (by.b.max() - by.b.min()) <= 0.02 * by.b.mean()
    assert (by.n.max() - by.n.min()) <= 0.05 * by.n.mean() and (by.t.max() - by.t.min()) <= 0.05 * by.t.mean()


def test_equal_texts_share_a_shard(spark):
    rows = [(i, f"text {i % 400} " * (1 + i % 7 * 0), "en", "a", 0) for i in range(1200)]
    out = sharding.shard(spark.createDataFrame(rows, SCHEMA), shards=4, grain=20).toPandas()
    assert (out.groupby("text_crc32").shard.nunique() == 1).all()


def test_placing_prefers_the_residual(spark):
    demand = np.array([[4, 0, 0], [0, 4, 0], [3, 0, 0], [0, 3, 0], [1, 0, 0], [0, 1, 0]], float)
    to = sharding.place(demand, 2, (1.0, 1.0, 1.0))
    for k in (0, 1):
        assert [demand[to == s, k].sum() for s in (0, 1)] == [4, 4]


def test_shard_edges(spark):
    assert sharding.shard(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = documents(5, 30) + [(None, None, None, None, None), (None, "x", None, None, None), (3, "x", None, None, None), (3, "x", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "9 AS shard", "8 AS slot", "7 AS alone")
    out = sharding.shard(df, keep=("lang",)).toPandas()
    checked(out, rows)
    assert "lang" in out.columns and len(words(rows[0][1])) >= 0
