"""Concept statistics over clinical event tables.

* frequency class 1-4 per (source, concept): count per concept, the 0.75 / 0.5 /
  0.25 percentiles of those counts per source, class by strict ``>``.
  All sources are tagged and unioned so one aggregate (with map-side partial
  counts, which also absorbs hot concepts) and one percentile sketch per source
  serve every table, instead of one job per table.
* average numeric value per concept, per source and weighted over sources.
* statistic upsert keyed by (concept, statistic type).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats_expr import FREQUENCY_QUANTILES, frequency_class_expr
from ..sources.tables import EVENT_SOURCES

VALUE_SOURCES = (("measurement", "measurement_concept_id"), ("observation", "observation_concept_id"))

# Fixed values of the statistics writer (algorithm and user ids of the batch job).
STAT_ALGO_ID = 4
STAT_USER_ID = 10


def _tagged(t, sources: Iterable[tuple[str, str]], keep_zero: bool, extra=()) -> DataFrame:
    frames = []
    for table, column in sources:
        df = t.event_table(table)
        cols = [F.lit(table).alias("source"), F.col(column).cast("long").alias("concept_id")]
        cols += [F.col(c) if c in df.columns else F.lit(None).alias(c) for c in extra]
        df = df.select(*cols)
        cond = F.col("concept_id").isNotNull()
        if not keep_zero:
            cond = cond & (F.col("concept_id") != 0)
        frames.append(df.filter(cond))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def concept_counts(t, sources=EVENT_SOURCES, keep_zero: bool = False) -> DataFrame:
    """(source, concept_id, ct): rows per concept in each source."""
    return (_tagged(t, sources, keep_zero)
            .groupBy("source", "concept_id").agg(F.count(F.lit(1)).alias("ct")))


def frequency_class(t, sources=EVENT_SOURCES, accuracy: int = 10000,
                    keep_zero: bool = False) -> DataFrame:
    """(source, concept_id, ct, m_frequency_value) for every source in one plan."""
    counts = concept_counts(t, sources, keep_zero)
    cuts = counts.groupBy("source").agg(
        F.percentile_approx("ct", FREQUENCY_QUANTILES, accuracy).alias("cuts"))
    # one row per source: the size is bounded by the source list
    return counts.join(F.broadcast(cuts), "source").select(
        "source", "concept_id", "ct",
        frequency_class_expr(F.col("ct"), F.col("cuts")).alias("m_frequency_value"))


def frequency_union(fc: DataFrame) -> DataFrame:
    """UNION DISTINCT of the per-source (concept, class) rows, as the reference writes it."""
    return fc.select("concept_id", "m_frequency_value").distinct()


def frequency_collapsed(fc: DataFrame) -> DataFrame:
    """One class per concept: the highest class any source gives it."""
    return fc.groupBy("concept_id").agg(F.max("m_frequency_value").alias("m_frequency_value"))


def value_sums(t, sources=VALUE_SOURCES, keep_zero: bool = False) -> DataFrame:
    """(source, concept_id, n, total, m_value_avg, value_is_text) per source."""
    tagged = _tagged(t, sources, keep_zero, extra=("value_as_number", "value_as_string"))
    return tagged.groupBy("source", "concept_id").agg(
        F.count("value_as_number").alias("n"),
        F.sum("value_as_number").alias("total"),
        F.avg("value_as_number").alias("m_value_avg"),
        F.max(F.col("value_as_string").isNotNull()).alias("value_is_text"))


def value_average(t, sources=VALUE_SOURCES, keep_zero: bool = False) -> DataFrame:
    """Average value per concept over all value sources, weighted by row count;
    concepts whose values are all null get a null average."""
    per = value_sums(t, sources, keep_zero)
    return per.groupBy("concept_id").agg(
        F.try_divide(F.sum("total"), F.sum("n")).alias("m_value_avg"),
        F.max("value_is_text").alias("value_is_text"))


def statistic_rows(values: DataFrame, value_col: str, type_id: str, as_of) -> DataFrame:
    """New statistic rows in the mapper_statistic layout."""
    return values.select(
        F.col("concept_id").alias("m_concept_id"),
        F.lit(type_id).alias("m_statistic_type_id"),
        F.col(value_col).cast("double").alias("m_value_as_number"),
        F.lit(None).cast("string").alias("m_value_as_string"),
        F.lit(STAT_ALGO_ID).alias("m_algo_id"),
        F.lit(STAT_USER_ID).alias("m_user_id"),
        F.lit(as_of).cast("timestamp_ntz").alias("m_valid_start_datetime"))


def upsert(old: DataFrame, new_rows: DataFrame,
           keys=("m_concept_id", "m_statistic_type_id")) -> DataFrame:
    """Replace rows of ``old`` whose key is in ``new_rows``, insert the others.

    A left-anti join of old on the new keys plus a union: one shuffle on the key,
    no update in place, idempotent when run twice with the same input.
    """
    kept = old.join(new_rows.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new_rows.select(*old.columns))


def refresh_statistics(t, as_of: str, accuracy: int = 10000) -> DataFrame:
    """FREQ and AVG recomputed from the event tables and merged into mapper_statistic."""
    freq = statistic_rows(frequency_collapsed(frequency_class(t, accuracy=accuracy)),
                          "m_frequency_value", "FREQ", as_of)
    avg = statistic_rows(value_average(t), "m_value_avg", "AVG", as_of)
    return upsert(t.mapper_statistic, freq.unionByName(avg))
