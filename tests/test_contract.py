"""Driver contract and the SQL twins, on the smallest data set."""

import os

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck
from termspark.plans.registry import QUERIES as OWN  # the training-data queries have tests of their own

SLOW: set[str] = set()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "concept_id" in df.columns and "is_mapped" in df.columns


def test_every_query_has_a_twin():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(OWN) >= 80
    assert set(OWN) <= set(o)


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_sql_twin(spark, con, small_dir, name):
    if name in SLOW and not os.environ.get("TERMSPARK_SLOW"):
        pytest.skip("slow; set TERMSPARK_SLOW=1")
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), small_dir)
    assert r.get("values_match"), r
