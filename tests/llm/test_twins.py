"""Operator queries against their SQL twins on the smallest tables."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck
from termspark.llm.oracle import ORACLE
from termspark.llm.queries import QUERIES


def test_every_operator_is_registered():
    names = sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql_twin(spark, small_dir, name):
    r = compare(spark, duck(small_dir), name, QUERIES[name], ORACLE[name], small_dir)
    assert r.get("values_match"), r
