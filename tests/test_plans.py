"""Plan checks: no Python UDF in the core plans, no single-partition exchange,
anti joins where claimed, filters and column pruning reaching the Parquet scan."""

import pytest

import __spark_entry__ as E

CORE = ["concept_documents", "frequency_class_all_sources", "value_average", "mapping_pivot",
        "statistic_upsert", "import_valid", "tokens_en", "relation_endpoints", "quality_checks"]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def single_partition_moves_rows(plan: str) -> bool:
    """True if a SinglePartition exchange sits on anything but a partial
    aggregate (a global aggregate's final merge moves one buffer per partition)."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            if "partial_" not in child:
                return True
    return False


@pytest.mark.parametrize("name", CORE)
def test_no_python_and_no_single_partition(spark, small_dir, name):
    p = plan_text(E.queries()[name](spark, small_dir))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert not single_partition_moves_rows(p)


def test_upsert_uses_anti_join(spark, small_dir):
    p = plan_text(E.queries()["statistic_upsert"](spark, small_dir))
    assert "LeftAnti" in p


def test_pushdown_and_pruning(spark, small_dir):
    p = plan_text(E.queries()["tokens_fr"](spark, small_dir))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,fr)]" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in p
    p = plan_text(E.queries()["concept_documents"](spark, small_dir))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in p  # relations
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in p  # values


def test_frequency_classes_use_one_aggregate_for_all_sources(spark, small_dir):
    df = E.queries()["frequency_class_all_sources"](spark, small_dir)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("percentile_approx") == 1


def test_change_feed_tables_are_computed_once(spark, small_dir):
    """Edges, statistics and renamed concepts of a change feed are read from what was written once, and are
    the rows of the views; no build of a micro-batch reads the raw line items or events."""
    from pyspark.sql import functions as F
    from termspark.operators import documents
    from termspark.plans import registry
    from termspark.sources.tables import Tables
    views = Tables(spark, small_dir)
    _, feed, before, after = registry._change_feed(spark, views)
    for t in (before, after):
        read = documents.build(t).inputFiles()
        assert not [f for f in read if "lineitem" in f or "events" in f]
    changed, renamed = registry._renamed(views)
    shown = views.mapper_statistic.filter(F.col("m_statistic_type_id").isin("AVG", "FREQ"))
    for got, want in ((spark.read.parquet(feed), changed), (after.concept, renamed), (after.mapper_statistic, shown),
                      (after.concept_relationship, views.concept_relationship)):
        assert got.schema.names == want.schema.names
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
