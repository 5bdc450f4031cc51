import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from txnmill.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Midnight, the last second of a Sunday night hour, noon, a free transaction and a large foreign one online.
EDGE_ROWS = [
    ("e1", "kim", "2024-03-03 05:59:59", 41.0, 0, "POS", "Fuel", 1),
    ("e2", "kim", "2024-03-04 12:00:00", 39.5, 1, "Online", "Books", 0),
    ("e3", "noa", "2024-03-05 00:00:00", 0.0, 1, "POS", "Fuel", 0),
    ("e4", "sam", "2024-03-08 06:00:00", 25000.0, 1, "Online", "Books", 1),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Hand-made transactions: a zero amount, both ends of the night, every combination that matters."""
    rows = spark.createDataFrame(
        EDGE_ROWS,
        "transaction_id string, user_id string, ts string, amount_inr double, is_international int, "
        "transaction_channel string, merchant_category string, is_fraud int",
    )
    return rows.selectExpr("*", "CAST(ts AS timestamp_ntz) AS timestamp").drop("ts")
