"""Concept search documents: one wide row per concept.

The document carries the concept's labels routed by language, its synonyms and
the names of the concepts it maps to (by language), the mapping status, the
number of local concepts mapped onto it and the AVG / FREQ statistics.

Plan shape: every partial frame (synonyms, relations, in-degree, statistics) is
an aggregate keyed by ``concept_id``, so the final left-join chain runs on one
key; the relation table is joined once to the target concepts and one grouped
aggregate produces every relation-derived list and count with conditional
``collect_list`` / ``count_if`` (instead of one join per condition).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan_tools import cut_lineage
from ..sources.tables import LANG_EN, LANG_FR, LOCAL_ID_BASE

# Relationship kinds (compared in lower case).
MAPPING_KINDS = ["maps to", "is a"]
EQUIVALENT_KINDS = ["maps to", "is a", "mapped from"]

LIST_COLUMNS = ["concept_synonym_name_en", "concept_synonym_name_fr", "concept_synonym_name_fr_en",
                "concept_mapped_name_en", "concept_mapped_name_fr", "concept_mapped_name_fr_en"]


def _nonempty(c: Column) -> Column:
    """An empty collected list becomes null (the concept has no such names)."""
    return F.when(F.size(c) > 0, c)


def _as_id_frame(ids, column: str = "concept_id") -> DataFrame | None:
    if ids is None:
        return None
    return ids.select(F.col(ids.columns[0]).cast("long").alias(column)).distinct()


def _restrict(df: DataFrame, key: str, ids: DataFrame | None) -> DataFrame:
    if ids is None:
        return df
    return df.join(ids.withColumnRenamed("concept_id", key), key, "left_semi")


def live_edges(rel: DataFrame) -> DataFrame:
    """Edges in force: no self loop, not ended; relationship kind in lower case."""
    return (rel.filter((F.col("concept_id_1") != F.col("concept_id_2"))
                       & F.col("m_modif_end_datetime").isNull())
            .select("concept_id_1", "concept_id_2", F.lower("relationship_id").alias("rel")))


def synonyms(t, ids: DataFrame | None = None) -> DataFrame:
    """Synonym lists per concept, English and French, the concept's own name left out."""
    c = _restrict(t.concept.select("concept_id", "concept_name"), "concept_id", ids)
    s = t.concept_synonym.join(c, "concept_id").filter(
        F.col("concept_synonym_name") != F.col("concept_name"))
    lang = F.col("language_concept_id")
    return s.groupBy("concept_id").agg(
        _nonempty(F.collect_list(F.when(lang == LANG_EN, F.col("concept_synonym_name")))).alias("concept_synonym_name_en"),
        _nonempty(F.collect_list(F.when(lang == LANG_FR, F.col("concept_synonym_name")))).alias("concept_synonym_name_fr"),
    )


def _edges_with_targets(t, ids: DataFrame | None) -> DataFrame:
    e = _restrict(live_edges(t.concept_relationship), "concept_id_1", ids)
    tgt = t.concept.select(
        F.col("concept_id").alias("concept_id_2"), F.col("concept_name").alias("tname"),
        F.lower("standard_concept").alias("tstd"), F.col("m_language_id").alias("tlang"))
    return e.join(tgt, "concept_id_2")


def _kind_flags():
    rel = F.col("rel")
    is_map = rel.isin(*MAPPING_KINDS)
    std = F.col("tstd").eqNullSafe("s")
    is_eq = rel.isin(*EQUIVALENT_KINDS)
    lang = F.col("tlang")
    return is_map, std, is_eq, lang


def relations(t, ids: DataFrame | None = None, with_lists: bool = True) -> DataFrame:
    """Relation-derived columns per source concept, from one join and one aggregate.

    Lists: standard / non-standard mapped names, other relations, equivalent names
    by language (en takes null or 'EN' languages).  Counts of the first three give
    the mapping status without collecting lists that the document does not show.
    """
    j = _edges_with_targets(t, ids)
    is_map, std, is_eq, lang = _kind_flags()
    name = F.col("tname")
    en = is_eq & (lang.isNull() | (lang == "EN"))
    fr = is_eq & (lang == "FR")
    aggs = [
        F.count_if(is_map & std & name.isNotNull()).alias("n_standard"),
        F.count_if(is_map & ~std & name.isNotNull()).alias("n_non_standard"),
        F.count_if(~is_map & name.isNotNull()).alias("n_relation"),
        _nonempty(F.collect_list(F.when(en, name))).alias("concept_mapped_name_en"),
        _nonempty(F.collect_list(F.when(fr, name))).alias("concept_mapped_name_fr"),
    ]
    if with_lists:
        aggs += [
            F.collect_list(F.when(is_map & std, name)).alias("standard_concept_mapped_name"),
            F.collect_list(F.when(is_map & ~std, name)).alias("non_standard_concept_mapped_name"),
            F.collect_list(F.when(~is_map, name)).alias("concept_relation_name"),
        ]
    return j.groupBy(F.col("concept_id_1").alias("concept_id")).agg(*aggs)


def mapping_status(n_standard: Column, n_non_standard: Column, n_relation: Column) -> Column:
    return (F.when(n_standard > 0, "S").when(n_non_standard > 0, "NS")
            .when(n_relation > 0, "R").otherwise("EMPTY"))


def local_in_degree(t, ids: DataFrame | None = None) -> DataFrame:
    """Number of live edges from local concepts (id >= 2,000,000,000) onto each concept."""
    e = _restrict(live_edges(t.concept_relationship), "concept_id_2", ids)
    return (e.filter(F.col("concept_id_1") >= LOCAL_ID_BASE)
            .groupBy(F.col("concept_id_2").alias("concept_id"))
            .agg(F.count(F.lit(1)).alias("local_map_number")))


def statistics(t, ids: DataFrame | None = None) -> DataFrame:
    """AVG and FREQ statistics as two columns, one scan and one aggregate."""
    st = t.mapper_statistic.filter(F.col("m_statistic_type_id").isin("AVG", "FREQ"))
    st = st.withColumnRenamed("m_concept_id", "concept_id")
    st = _restrict(st, "concept_id", ids)
    typ, val = F.col("m_statistic_type_id"), F.col("m_value_as_number")
    return st.groupBy("concept_id").agg(
        F.max(F.when(typ == "AVG", val)).alias("m_value_avg"),
        F.max(F.when(typ == "FREQ", val)).alias("m_frequency_value"))


def build(t, ids=None, prefix: bool = True) -> DataFrame:
    """One search document per concept.

    ``ids``: optional one-column frame of concept ids; it restricts the output
    only - target names, counts and statistics still come from whole tables.
    ``prefix``: label enumerated fields with the project type (``'OMOP S'``).
    """
    ids = _as_id_frame(ids)
    ids = ids if ids is None else cut_lineage(ids, "ids")  # five joins read it
    concept = _restrict(t.concept, "concept_id", ids)
    rel = relations(t, ids, with_lists=False)
    doc = (concept
           .join(rel, "concept_id", "left")
           .join(synonyms(t, ids), "concept_id", "left")
           .join(local_in_degree(t, ids), "concept_id", "left")
           .join(statistics(t, ids), "concept_id", "left")
           .join(t.mapper_project, "m_project_id", "left"))

    ptype = F.coalesce(F.col("m_project_type_id"), F.lit("OMOP"))

    def pre(c: Column) -> Column:
        return F.concat(ptype, F.lit(" "), c) if prefix else c

    name = F.coalesce(F.col("concept_name"), F.lit("EMPTY"))
    lang = F.col("m_language_id")
    is_en = lang.isNull() | (lang == "EN")
    is_fr = lang == "FR"
    status = mapping_status(*(F.coalesce(F.col(c), F.lit(0))
                              for c in ("n_standard", "n_non_standard", "n_relation")))
    return doc.select(
        F.col("concept_id").cast("string").alias("id"),
        F.col("concept_id"),
        name.alias("concept_name"),
        F.when(is_en, name).alias("concept_name_en"),
        F.when(is_fr, name).alias("concept_name_fr"),
        F.when(is_fr, name).alias("concept_name_fr_en"),
        pre(F.coalesce(F.col("domain_id"), F.lit("EMPTY"))).alias("domain_id"),
        pre(F.coalesce(F.col("vocabulary_id"), F.lit("EMPTY"))).alias("vocabulary_id"),
        pre(F.coalesce(F.col("concept_class_id"), F.lit("EMPTY"))).alias("concept_class_id"),
        pre(F.coalesce(F.col("standard_concept"), F.lit("EMPTY"))).alias("standard_concept"),
        pre(F.coalesce(F.col("invalid_reason"), F.lit("EMPTY"))).alias("invalid_reason"),
        F.coalesce(F.col("concept_code"), F.lit("EMPTY")).alias("concept_code"),
        F.col("concept_synonym_name_en"),
        F.col("concept_synonym_name_fr"),
        F.col("concept_synonym_name_fr").alias("concept_synonym_name_fr_en"),
        F.col("concept_mapped_name_en"),
        F.col("concept_mapped_name_fr"),
        F.col("concept_mapped_name_fr").alias("concept_mapped_name_fr_en"),
        pre(F.coalesce(lang, F.lit("EN"))).alias("m_language_id"),
        F.col("m_frequency_value").cast("int").alias("frequency"),
        pre(status).alias("is_mapped"),
        F.coalesce(F.col("local_map_number"), F.lit(0)).alias("local_map_number"),
        F.col("m_value_avg").alias("value_avg"),
        F.col("m_value_avg").isNotNull().alias("value_is_numeric"),
        ptype.alias("m_project_type_id"),
    )


def joined_lists(df: DataFrame, columns: Iterable[str], sep: str = "|") -> DataFrame:
    """Render array columns as sorted, separator-joined strings (stable for comparison)."""
    cols = set(columns)
    return df.select(*[
        F.array_join(F.array_sort(F.col(c)), sep).alias(c) if c in cols else F.col(c)
        for c in df.columns])
