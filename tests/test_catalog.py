"""Every registered query with a SQL twin matches DuckDB on sf0.001, and the
driver contract holds."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    compare(df, con, ORACLES[name])


def test_point_lookup_is_pushed_to_the_scan(spark):
    plan = entry.queries()["point_lookup"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id," in plan


def test_oracle_keys_are_queries():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["user_id", "song_id", "play_count"]
    assert entry.entry(spark).schema == df.schema


def test_no_sql_for_model_queries():
    for name in ("fit_logistic", "fit_als", "recommend_top_k", "tune_gbt"):
        assert name in entry.queries() and name not in ORACLES
