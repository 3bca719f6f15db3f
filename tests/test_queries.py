"""Every registered query against its SQL in DuckDB on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as spark_entry  # noqa: E402
from oracle_check import compare, connect  # noqa: E402

import rollfeat.queries  # noqa: E402
from rollfeat.oracle import ORACLE as rollfeat_oracle  # noqa: E402
from rollfeat.plans.presets import build_features  # noqa: E402
from rollfeat.queries import QUERIES as rollfeat_queries  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = rollfeat_queries, rollfeat_oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(rollfeat_queries) - set(ORACLE) == {"train_score", "importance_topk", "train_rounds"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        assert compare(result, duck, ORACLE[name]) == []
    else:
        assert result.count() > 0


@pytest.mark.parametrize("name", ["ingest_two_tables", "features_preset_a_orders", "features_preset_b_orders"])
def test_builds_over_orders_read_a_stored_join(spark, monkeypatch, name):
    """A build reads its rows several times over; each time would join them again."""
    built = []

    def build(staged, *args):
        built.append(staged)
        return build_features(staged, *args)

    monkeypatch.setattr(rollfeat.queries, "build_features", build)
    QUERIES[name](spark, SF_DIR)
    (staged,) = built
    assert "Join" not in staged._jdf.queryExecution().optimizedPlan().toString()


def test_entry(spark):
    assert len(spark_entry.entry(spark).columns) == 27
