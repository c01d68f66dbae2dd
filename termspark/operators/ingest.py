"""Terminology import: project term lists -> validated, de-duplicated staging frame.

All checks run in one plan and yield (good, rejects, report) instead of one job
per check: rows failing the not-null or number checks and rows removed by the
de-duplication are tagged with a reason and kept in the reject frame, so nothing
is dropped silently and nothing is published before every check ran.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REQUIRED_COLUMNS = ("local_concept_name",)
OPTIONAL_COLUMNS = ("local_concept_code", "local_frequency")
ORDER_COLUMN = "src_order"


def missing_columns(columns: Iterable[str], needed: Iterable[str]) -> list[str]:
    """Required-column check on the schema only (no job)."""
    have = set(columns)
    return [c for c in needed if c not in have]


def backfill(df: DataFrame, optional: Iterable[str] = OPTIONAL_COLUMNS) -> DataFrame:
    """Add each missing optional column as a typed null string."""
    for c in optional:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def with_order(df: DataFrame, order_col: str = ORDER_COLUMN) -> DataFrame:
    """Source order for repeatable de-duplication (kept if the reader gave one)."""
    if order_col in df.columns:
        return df
    return df.withColumn(order_col, F.monotonically_increasing_id())


def stage(df: DataFrame, project_type: str, language: str, domain: str, vocabulary: str) -> DataFrame | None:
    """Project term list -> staging layout, or None when a required column is absent."""
    if missing_columns(df.columns, REQUIRED_COLUMNS):
        return None
    df = with_order(backfill(df))
    return df.select(
        F.col("local_concept_name").alias("concept_name"),
        F.col("local_concept_code").alias("concept_code"),
        F.lit(language).alias("m_language_id"),
        F.lit(project_type).alias("m_project_type_id"),
        F.lit(domain).alias("domain_id"),
        F.lit(vocabulary).alias("vocabulary_id"),
        F.lit("FREQ").alias("m_statistic_type_id"),
        F.col("local_frequency").alias("m_value_as_number"),
        F.col(ORDER_COLUMN))


def _first_failure(checks: Sequence[tuple[str, Column]]) -> Column:
    expr = F.lit(None).cast("string")
    for reason, bad in reversed(checks):
        expr = F.when(bad, F.lit(reason)).otherwise(expr)
    return expr


def validate(df: DataFrame, not_null: Sequence[str] = ("concept_name",),
             numeric: Sequence[str] = ("m_value_as_number",),
             unique: Sequence[str] = ("concept_code", "concept_name"),
             order_col: str = ORDER_COLUMN):
    """Return (good, rejects, report).

    * not-null: rows with a null in a required column are rejected;
    * numeric: text that does not cast to a number is rejected (``try_cast``),
      null stays null;
    * unique: among rows equal on ``unique`` (nulls equal) the lowest
      ``order_col`` is kept and the others are rejected as duplicates.  The
      first row per key is found with an aggregate (``min``, partial on the map
      side) and re-joined on key + order, which is unique, so a key shared by a
      huge number of rows is not sent to one task.
    """
    checks = [(f"null:{c}", F.col(c).isNull()) for c in not_null]
    checks += [(f"not_numeric:{c}", F.col(c).isNotNull() & F.col(c).try_cast("double").isNull())
               for c in numeric]
    tagged = df.withColumn("reject_reason", _first_failure(checks))
    passed = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    for c in numeric:
        passed = passed.withColumn(c, F.col(c).try_cast("double"))
    firsts = passed.groupBy(*unique).agg(F.min(order_col).alias("_first"))
    cond = [passed[c].eqNullSafe(firsts[c]) for c in unique] + [passed[order_col] == firsts["_first"]]
    good = passed.join(firsts, cond, "left_semi")
    dups = passed.join(firsts, cond, "left_anti")
    failed = tagged.filter(F.col("reject_reason").isNotNull())
    rejects = failed.unionByName(
        dups.select(*[F.col(c).cast("string") if c in numeric else F.col(c) for c in dups.columns])
        .withColumn("reject_reason", F.lit("duplicate")))
    return good, rejects, report_of(rejects)


def report_of(rejects: DataFrame) -> DataFrame:
    """Rejected rows by reason."""
    return rejects.groupBy(F.col("reject_reason").alias("check")).agg(F.count(F.lit(1)).alias("bad_rows"))


def import_terms(terms: DataFrame, project_type: str, language: str, domain: str, vocabulary: str):
    """stage + validate; None when the term list lacks a required column."""
    staged = stage(terms, project_type, language, domain, vocabulary)
    if staged is None:
        return None
    return validate(staged)
