"""Per-project terminology export: concepts, synonyms, relations, mapping pivot.

One job covers every project: concepts are joined once to the (small,
size-checked) project table and the project type is carried as a column, so a
writer can ``partitionBy("m_project_type_id")`` instead of looping over
projects.  ``project=`` keeps a single project (semi join on the lower-cased
project type).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


CONCEPT_COLUMNS = ["concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_class_id",
                   "standard_concept", "concept_code", "valid_start_date", "valid_end_date",
                   "invalid_reason", "m_language_id", "m_project_id"]

# Defaults of the mapping pivot when a concept has no standard target.
NO_MATCH = "No matching concept"
NO_MATCH_DOMAIN = "Metadata"
NO_MATCH_VOCABULARY = "None"


def projects(t, project: str | None = None) -> DataFrame:
    p = t.mapper_project.select("m_project_id", "m_project_type_id")
    if project is not None:
        p = p.filter(F.lower("m_project_type_id") == F.lower(F.lit(project)))
    return p


def project_concepts(t, project: str | None = None) -> DataFrame:
    """Concepts of each project, with the project type."""
    return t.concept.select(*CONCEPT_COLUMNS).join(projects(t, project), "m_project_id")


def project_synonyms(t, project: str | None = None) -> DataFrame:
    c = project_concepts(t, project).select("concept_id", "m_project_type_id")
    return t.concept_synonym.select("concept_id", "concept_synonym_name", "language_concept_id").join(c, "concept_id")


def project_relations(t, project: str | None = None) -> DataFrame:
    c = project_concepts(t, project).select(F.col("concept_id").alias("concept_id_1"), "m_project_type_id")
    return t.concept_relationship.select(
        "concept_id_1", "concept_id_2", "relationship_id", "valid_start_date", "valid_end_date",
        "invalid_reason").join(c, "concept_id_1")


def latest_mapping(t) -> DataFrame:
    """Live 'maps to' edge with the highest target per source concept.

    An aggregate (max of a (target, edge id) struct) instead of a window: partial
    aggregation keeps a concept with many mappings from landing whole in one task.
    """
    cr = t.concept_relationship.filter(
        (F.lower("relationship_id") == "maps to") & F.col("m_modif_end_datetime").isNull()
        & F.col("invalid_reason").isNull())
    best = cr.groupBy("concept_id_1").agg(
        F.max(F.struct("concept_id_2", "m_concept_relationship_id")).alias("b"))
    return best.select("concept_id_1", F.col("b.concept_id_2").alias("concept_id_2"),
                       F.col("b.m_concept_relationship_id").alias("m_concept_relationship_id"))


def vote_score(t) -> DataFrame:
    """Vote balance (+1 up, -1 otherwise) and vote count per relation, one row each."""
    v = t.mapper_statistic.filter(F.col("m_statistic_type_id") == "VOTE_MAPPING")
    return v.groupBy(F.col("m_concept_id").alias("m_concept_relationship_id")).agg(
        F.sum(F.when(F.col("m_value_as_string") == "UP", 1).otherwise(-1)).alias("vote_value"),
        F.count(F.lit(1)).alias("vote_count"))


def mapping_pivot(t, project: str | None = None, ordered: bool = True) -> DataFrame:
    """Local concept beside its standard target (own values when already standard)."""
    c = project_concepts(t, project)
    cr = latest_mapping(t)
    cs = t.concept.filter(F.col("standard_concept") == "S").select(
        F.col("concept_id").alias("s_id"), F.col("concept_code").alias("s_code"),
        F.col("concept_name").alias("s_name"), F.col("domain_id").alias("s_domain"),
        F.col("vocabulary_id").alias("s_vocabulary"))
    v = vote_score(t)
    j = (c.join(cr, c.concept_id == cr.concept_id_1, "left")
         .join(cs, F.col("concept_id_2") == F.col("s_id"), "left")
         .join(v, "m_concept_relationship_id", "left"))
    is_std = F.col("standard_concept") == "S"

    def pick(own: str, other: str, default):
        return F.when(is_std, F.col(own)).otherwise(F.coalesce(F.col(other), F.lit(default)))

    out = j.select(
        F.col("m_project_type_id"),
        F.col("concept_id").alias("concept_id_l"),
        pick("concept_id", "s_id", 0).alias("concept_id_s"),
        F.col("concept_code").alias("concept_code_l"),
        pick("concept_code", "s_code", NO_MATCH).alias("concept_code_s"),
        F.col("concept_name").alias("concept_name_l"),
        pick("concept_name", "s_name", NO_MATCH).alias("concept_name_s"),
        F.col("domain_id").alias("domain_id_l"),
        pick("domain_id", "s_domain", NO_MATCH_DOMAIN).alias("domain_id_s"),
        F.col("vocabulary_id").alias("vocabulary_id_l"),
        pick("vocabulary_id", "s_vocabulary", NO_MATCH_VOCABULARY).alias("vocabulary_id_s"),
        F.coalesce(F.col("vote_count"), F.lit(0)).alias("vote_count"),
        F.col("vote_value"))
    if ordered:
        out = out.orderBy(F.col("concept_id_s").desc(), F.col("concept_id_l"))
    return out


def relation_endpoints(t, project: str | None = None) -> DataFrame:
    """Each live edge with both end concepts and the project of its source."""
    cr = t.concept_relationship.filter(F.col("m_modif_end_datetime").isNull())
    c1 = t.concept.select(
        F.col("concept_id").alias("local_concept_id"), F.col("concept_name").alias("local_concept_name"),
        F.col("concept_code").alias("local_concept_code"), F.col("domain_id").alias("local_domain_id"),
        F.col("vocabulary_id").alias("local_vocabulary_id"), "m_project_id")
    c2 = t.concept.select("concept_id", "concept_name", "concept_code", "domain_id", "vocabulary_id",
                          "standard_concept")
    j = (cr.join(c1, cr.concept_id_1 == c1.local_concept_id)
         .join(c2, cr.concept_id_2 == c2.concept_id)
         .join(projects(t, project), "m_project_id"))
    return j.select("local_concept_id", "local_concept_name", "local_concept_code", "local_domain_id",
                    "local_vocabulary_id", "relationship_id", "concept_id", "concept_name", "concept_code",
                    "domain_id", "vocabulary_id", "standard_concept", "m_mapping_comment",
                    "m_mapping_rate", "m_project_type_id")
