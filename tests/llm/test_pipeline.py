import random

import pytest
from brute import SCHEMA, linked
from compare import connect, differences
from pyspark.sql import functions as F
from test_mixing_and_sharding import running_sum_law

import corpus_pipeline
from txnmill.llm import decontaminate, jaccard, mixing, quality
from txnmill.llm.queries import ORACLES, QUERIES
from txnmill.session import cut_lineage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = cut_lineage(stage(spark, docs, SF), name)
        out.append((docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_quality_stage_equals_its_verdicts(spark, stages):
    before, after = stages[0]
    judged = quality.judge(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(after) == ids(judged.where("kept")) and after.columns == before.columns
    clean = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").join(judged.where("not base_failed"), "doc_id")
    assert clean.where("not kept").count() <= 0.02 * clean.count()


def test_one_of_each_group_stays(stages):
    before, after = stages[1]
    parts = linked([(r["doc_id"], r["text"]) for r in before.collect()])
    assert ids(after) == sorted({c for _, c in parts.values()})


def test_no_benchmark_passage_stays(spark, stages):
    before, after = stages[2]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = [r["doc_id"] for r in before.collect() if any(t in r["text"] for t in items)]
    assert leaked and not set(leaked) & set(ids(after))
    assert decontaminate.matches(after, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0


def test_mix_and_shards(stages):
    before, after = stages[3]
    out = mixing.mix(before, keep=("source",)).toPandas()
    running_sum_law(out, {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()})
    mixed, placed = stages[4]
    assert placed.count() == mixed.count() and set(mixed.columns) <= set(placed.columns)
    sums = [r["b"] for r in placed.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    # Here one text, or two copies of one, is larger than a shard's share.
    largest = max(r["b"] for r in placed.groupBy("text_crc32").agg(F.sum("size").alias("b")).collect())
    assert len(sums) == 24 and max(sums) <= 1.1 * max(largest, min(sums))
    slots = placed.groupBy("shard").agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.countDistinct("slot").alias("n")).collect()
    assert all(r["lo"] == 0 and r["hi"] + 1 == r["n"] for r in slots)


def test_stages_take_nulls_repeats_and_further_columns(spark, tmp_path):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(900)}" for _ in range(60))
    rows = [(1, text, "en", "a", 3), (1, text, "en", "a", 3), (None, None, None, None, None), (2, "", "en", None, 0), (3, " ".join(f"v{i}" for i in range(50)), None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'k' AS kept", "5 AS size", "'s' AS root")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = cut_lineage(stage(spark, docs, str(tmp_path)), name)
        if name != "shards":
            assert after.columns == docs.columns
            docs = after
    assert ids(docs.distinct()) == [1, 3]


def test_rows_without_ids(spark, tmp_path):
    """A third of the rows has no id. Every stage keeps the clean ones; one copy of each group stays; the leaked go."""
    rng = random.Random(8)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    leak = items.first()["text"]
    words = [f"w{k}" for k in range(3000)]
    clean = [" ".join(rng.choices(words, k=80)) for _ in range(90)]
    near = [" ".join([*clean[k].split()[:78], f"edit{k}", "end"]) for k in range(12)]
    leaked = [" ".join(rng.choices(words, k=40)) + " " + leak + " " + " ".join(rng.choices(words, k=40)) for _ in range(6)]
    texts = clean + near + leaked
    docs = spark.createDataFrame([(None if k % 3 == 0 else k, t, "en", f"s{k % 2}", len(t)) for k, t in enumerate(texts)], SCHEMA)

    one = jaccard.keep_one(docs)
    left = sorted(r["text"] for r in one.collect())
    groups = linked(list(enumerate(texts)))
    members = {}
    for k, (_, root) in groups.items():
        members.setdefault(root, []).append(texts[k])
    assert len(left) == len(members) and all(len(set(m) & set(left)) == 1 for m in members.values())

    after = decontaminate.clean(docs, items)
    assert sorted(r["text"] for r in after.collect()) == sorted(clean + near)
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    assert quality.keep_good(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).where("doc_id is null").count() > 0


def test_equal_rows_leave_one(spark):
    text = " ".join(f"v{i}" for i in range(60))
    docs = spark.createDataFrame([(None, text, "en", "a", 1)] * 5 + [(None, None, "en", "a", 0)] * 2 + [(4, "", "en", "a", 0)], SCHEMA)
    assert sorted(str(r["text"]) for r in jaccard.keep_one(docs).collect()) == sorted([text, "None", "None", ""])


def test_empty_documents(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline"}))
def test_registered_query(spark, name):
    out = QUERIES[name](spark, SF).toArrow()
    assert out.num_rows > 0 or name.startswith("op1_")
    if name in ORACLES:
        assert differences(out, connect(SF).execute(ORACLES[name]).to_arrow_table()) == []


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
