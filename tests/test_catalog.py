"""Every registered query runs; every query with an oracle equals it value by value."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import connect, differences

from catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# Fits of several models; their invariants are tested in test_models.py.
SLOW = {"ml6_boosted_trees", "ml7_balanced_logistic", "ml10_retrain_on_both", "ml11_final_evaluation", "ml12_compare_candidates",
        "ml13_feature_importance", "ml9_batch_scoring", "t8_top_importances", "io10_model_save_load", "io12_score_file_to_file", "st1_scoring_stream"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, duck, name):
    ours = QUERIES[name](spark, SF).toArrow()
    assert differences(ours, duck.execute(ORACLES[name]).to_arrow_table()) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_is_imported_without_a_session():
    """The queries are listed before a session exists."""
    code = "import __spark_entry__ as e; assert len(e.queries()) > 200 and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 5
    assert set(e.oracle_sql()) <= set(e.queries())
