import math

import numpy as np
import pytest

from txnmill import schemas
from txnmill.operators import features, order, preprocess, projection
from txnmill.operators.encoding import TargetEncoder, encoding_table


def test_smoothing_by_hand(spark):
    df = spark.createDataFrame([("A", 0), ("A", 0), ("B", 1)], "category string, is_fraud int")
    got = {r["category"]: r["encoding"] for r in encoding_table(df, "category").collect()}
    assert got == pytest.approx({"A": (0 + 10 / 3) / 12, "B": (1 + 10 / 3) / 11})


def test_unknown_and_null_categories_get_the_global_mean(spark):
    train = spark.createDataFrame([("A", 0), ("A", 1), ("B", 1), (None, 0)], "c string, is_fraud int")
    encoder = TargetEncoder.fit(train, "c")
    assert encoder.global_mean == 0.5
    rows = spark.createDataFrame([(1, "A"), (2, "Z"), (3, None)], "id int, c string")
    out = {r["id"]: r["c_encoded"] for r in encoder.transform(rows).collect()}
    assert out[2] == out[3] == 0.5 and out[1] == pytest.approx((1 + 5) / 12)


def test_encoder_survives_save_and_load(spark, tmp_path):
    train = spark.createDataFrame([("A", 0), ("A", 1), ("B", 1)], "c string, is_fraud int")
    encoder = TargetEncoder.fit(train, "c")
    encoder.save(str(tmp_path / "e"))
    again = TargetEncoder.load(spark, str(tmp_path / "e"), "c")
    assert again.global_mean == encoder.global_mean
    assert sorted(again.transform(train).collect()) == sorted(encoder.transform(train).collect())


def test_edge_transactions(edge):
    out = {r["transaction_id"]: r for r in features.engineer(edge, threshold=math.log1p(40.0)).collect()}
    column = lambda name: [out[f"e{i}"][name] for i in range(1, 5)]
    assert column("hour") == [5, 12, 0, 6]
    assert column("day_of_week") == [6, 0, 1, 4]
    assert column("is_night") == [1, 0, 1, 0]
    assert column("intl_online") == [0, 1, 0, 1]
    assert column("night_high_amount") == [1, 0, 0, 0]
    assert column("log_amount") == pytest.approx(np.log1p([41.0, 39.5, 0.0, 25000.0]))


def test_features_need_their_columns(spark):
    df = spark.createDataFrame([(1.0,)], "amount_inr double")
    assert features.engineer(df, threshold=1.0).columns == ["amount_inr", "log_amount"]


def test_encoder_is_fitted_on_train_only(spark):
    rows = [(i, f"2024-01-01 00:{i:02d}:00", 10.0, "A" if i < 6 else "B", 0, "POS", int(i >= 6)) for i in range(10)]
    df = spark.createDataFrame(rows, "transaction_id long, ts string, amount_inr double, merchant_category string, is_international int, transaction_channel string, is_fraud int")
    df = df.selectExpr("*", "CAST(ts AS timestamp_ntz) AS timestamp")
    out, state = features.engineer_splits(order.with_time_split(df))
    assert state.encoder.global_mean == 0.0
    assert {r[0] for r in out.select("merchant_category_encoded").collect()} == {0.0}
    shared, _ = features.engineer_splits(order.with_time_split(df), per_split=True)
    assert shared.count() == 10


def test_exclusions_and_alignment(spark):
    df = spark.createDataFrame([(1, "u", 2.0, 0)], "transaction_id int, user_id string, amount_inr double, is_fraud int")
    assert projection.feature_columns(df) == ["amount_inr"]
    assert projection.align_columns(df, ["x", "amount_inr"]).collect()[0] == (0, 2.0)
    assert len(schemas.ENRICHED_COLUMNS) == 46 and len(schemas.RAW_COLUMNS) == 31


def test_raw_feed_time_units(spark):
    df = spark.createDataFrame([(90061.9, 5.0, 1)], "Time double, Amount double, Class int")
    row = projection.normalize_schema(df).first()
    assert str(row["timestamp"]) == "2024-01-02 01:01:01" and row["amount_inr"] == 5.0 and row["is_fraud"] == 1
    assert str(projection.normalize_schema(df, unit="ns").first()["timestamp"]) == "2024-01-01 00:00:00"


def test_unseen_categories_become_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    values = preprocess.categories(train, ["t"])
    out = preprocess.indicators(spark.createDataFrame([("z",), (None,), ("a",), ("c",)], "t string"), values, drop_first=True)
    assert out.columns == ["t_b", "t_c"]
    assert [tuple(r) for r in out.collect()] == [(0, 0), (0, 0), (0, 0), (0, 1)]
    with pytest.raises(ValueError):
        preprocess.categories(train, ["t"], max_values=2)


def test_constant_column_is_not_divided_by_zero(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0), (3.0, 9.0)], "a double, b double")
    p = preprocess.robust_parameters(df, ["a", "b"])
    assert p == {"a": (3.0, 1.0), "b": (2.0, 4.0)}
    assert {r["a"] for r in preprocess.robust_scale(df, p).collect()} == {0.0}


def test_input_is_not_changed(edge):
    before = edge.collect()
    features.engineer(edge, threshold=1.0).collect()
    assert edge.collect() == before


def test_one_scan_no_python_in_feature_plan(edge):
    plan = features.engineer(edge, threshold=1.0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
