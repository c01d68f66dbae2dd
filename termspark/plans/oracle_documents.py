"""DuckDB twins of the document queries."""

from __future__ import annotations

from .fixture_sql import with_views


def documents_select(concept: str = "concept", ids: str | None = None) -> str:
    """Document rows as SQL; list columns as sorted '|'-joined strings.

    ``concept`` names the concept view to read, ``ids`` an optional CTE of ids
    that restricts the output rows only.
    """
    id_filter = f"WHERE c.concept_id IN (SELECT concept_id FROM {ids})" if ids else ""
    empty = lambda col: f"coalesce({col}, 'EMPTY')"
    out = {"id": "CAST(c.concept_id AS VARCHAR)", "concept_id": "c.concept_id", "concept_name": empty("c.concept_name"),
           "concept_code": empty("c.concept_code")}
    # a name goes to the fields of its language; French ones also to the field analysed for English queries
    routes = {"en": "coalesce(c.m_language_id, 'EN') = 'EN'", "fr": "c.m_language_id = 'FR'"}
    for suffix, lang in (("en", "en"), ("fr", "fr"), ("fr_en", "fr")):
        out[f"concept_name_{suffix}"] = f"if({routes[lang]}, {empty('c.concept_name')}, NULL)"
        out[f"concept_synonym_name_{suffix}"] = f"syn.syn_{lang}"
        out[f"concept_mapped_name_{suffix}"] = f"rel.map_{lang}"
    # enumerations carry the project in front
    status = "CASE WHEN rel.n_s > 0 THEN 'S' WHEN rel.n_ns > 0 THEN 'NS' WHEN rel.n_r > 0 THEN 'R' ELSE 'EMPTY' END"
    project = "coalesce(p.m_project_type_id, 'OMOP')"
    enums = {f: empty(f"c.{f}") for f in ("domain_id", "vocabulary_id", "concept_class_id", "standard_concept", "invalid_reason")}
    for name, value in {**enums, "m_language_id": "coalesce(c.m_language_id, 'EN')", "is_mapped": status}.items():
        out[name] = f"concat_ws(' ', {project}, {value})"
    out |= {"frequency": "CAST(st.freq AS INTEGER)", "value_avg": "st.avg_v", "value_is_numeric": "st.avg_v IS NOT NULL",
            "local_map_number": "coalesce(lm.n, 0)", "m_project_type_id": project}
    select = ",\n  ".join(f"{expr} AS {name}" for name, expr in out.items())
    return f"""
SELECT {select}
FROM {concept} c
LEFT JOIN (
  SELECT s.concept_id,
    string_agg(s.concept_synonym_name, '|' ORDER BY s.concept_synonym_name) FILTER (WHERE s.language_concept_id = 4180186) AS syn_en,
    string_agg(s.concept_synonym_name, '|' ORDER BY s.concept_synonym_name) FILTER (WHERE s.language_concept_id = 4180190) AS syn_fr
  FROM concept_synonym s JOIN {concept} c2 ON c2.concept_id = s.concept_id
  WHERE s.concept_synonym_name <> c2.concept_name
  GROUP BY s.concept_id) syn ON syn.concept_id = c.concept_id
LEFT JOIN (
  SELECT e.concept_id_1 AS concept_id,
    count(*) FILTER (WHERE e.rel IN ('maps to', 'is a') AND lower(t.standard_concept) = 's' AND t.concept_name IS NOT NULL) AS n_s,
    count(*) FILTER (WHERE e.rel IN ('maps to', 'is a') AND lower(t.standard_concept) IS DISTINCT FROM 's' AND t.concept_name IS NOT NULL) AS n_ns,
    count(*) FILTER (WHERE e.rel NOT IN ('maps to', 'is a') AND t.concept_name IS NOT NULL) AS n_r,
    string_agg(t.concept_name, '|' ORDER BY t.concept_name) FILTER (
      WHERE e.rel IN ('maps to', 'is a', 'mapped from') AND (t.m_language_id IS NULL OR t.m_language_id = 'EN')) AS map_en,
    string_agg(t.concept_name, '|' ORDER BY t.concept_name) FILTER (
      WHERE e.rel IN ('maps to', 'is a', 'mapped from') AND t.m_language_id = 'FR') AS map_fr
  FROM (SELECT concept_id_1, concept_id_2, lower(relationship_id) AS rel FROM concept_relationship
        WHERE concept_id_1 <> concept_id_2 AND m_modif_end_datetime IS NULL) e
  JOIN {concept} t ON t.concept_id = e.concept_id_2
  GROUP BY e.concept_id_1) rel ON rel.concept_id = c.concept_id
LEFT JOIN (
  SELECT concept_id_2 AS concept_id, count(*) AS n FROM concept_relationship
  WHERE concept_id_1 <> concept_id_2 AND m_modif_end_datetime IS NULL AND concept_id_1 >= 2000000000
  GROUP BY concept_id_2) lm ON lm.concept_id = c.concept_id
LEFT JOIN (
  SELECT m_concept_id AS concept_id,
    max(m_value_as_number) FILTER (WHERE m_statistic_type_id = 'AVG') AS avg_v,
    max(m_value_as_number) FILTER (WHERE m_statistic_type_id = 'FREQ') AS freq
  FROM mapper_statistic GROUP BY m_concept_id) st ON st.concept_id = c.concept_id
LEFT JOIN mapper_project p ON p.m_project_id = c.m_project_id
{id_filter}"""


def concept_documents() -> str:
    return with_views(documents_select())


def concept_documents_ids() -> str:
    extra = {"changed_ids": """
      SELECT DISTINCT cr.concept_id_1 AS concept_id FROM concept_relationship cr
      WHERE cr.m_concept_relationship_id IN (
        SELECT m_concept_id FROM mapper_statistic WHERE m_statistic_type_id = 'VOTE_MAPPING')"""}
    return with_views(documents_select(ids="changed_ids"), extra)


_LIVE = """(SELECT concept_id_1, concept_id_2, lower(relationship_id) AS rel FROM concept_relationship
            WHERE concept_id_1 <> concept_id_2 AND m_modif_end_datetime IS NULL)"""


def synonyms_by_language() -> str:
    return with_views("""
SELECT s.concept_id,
  string_agg(s.concept_synonym_name, '|' ORDER BY s.concept_synonym_name) FILTER (WHERE s.language_concept_id = 4180186) AS concept_synonym_name_en,
  string_agg(s.concept_synonym_name, '|' ORDER BY s.concept_synonym_name) FILTER (WHERE s.language_concept_id = 4180190) AS concept_synonym_name_fr
FROM concept_synonym s JOIN concept c ON c.concept_id = s.concept_id
WHERE s.concept_synonym_name <> c.concept_name
GROUP BY s.concept_id""")


def mapped_names() -> str:
    return with_views(f"""
SELECT e.concept_id_1 AS concept_id,
  string_agg(t.concept_name, '|' ORDER BY t.concept_name) FILTER (WHERE e.rel IN ('maps to', 'is a') AND lower(t.standard_concept) = 's') AS standard_concept_mapped_name,
  string_agg(t.concept_name, '|' ORDER BY t.concept_name) FILTER (WHERE e.rel IN ('maps to', 'is a') AND lower(t.standard_concept) IS DISTINCT FROM 's') AS non_standard_concept_mapped_name,
  string_agg(t.concept_name, '|' ORDER BY t.concept_name) FILTER (WHERE e.rel NOT IN ('maps to', 'is a')) AS concept_relation_name,
  string_agg(t.concept_name, '|' ORDER BY t.concept_name) FILTER (WHERE e.rel IN ('maps to', 'is a', 'mapped from') AND (t.m_language_id IS NULL OR t.m_language_id = 'EN')) AS concept_mapped_name_en,
  string_agg(t.concept_name, '|' ORDER BY t.concept_name) FILTER (WHERE e.rel IN ('maps to', 'is a', 'mapped from') AND t.m_language_id = 'FR') AS concept_mapped_name_fr
FROM {_LIVE} e JOIN concept t ON t.concept_id = e.concept_id_2
GROUP BY e.concept_id_1""")


def mapping_status() -> str:
    return with_views(f"""
SELECT c.concept_id,
  CASE WHEN r.n_s > 0 THEN 'S' WHEN r.n_ns > 0 THEN 'NS' WHEN r.n_r > 0 THEN 'R' ELSE 'EMPTY' END AS is_mapped
FROM concept c LEFT JOIN (
  SELECT e.concept_id_1 AS concept_id,
    count(*) FILTER (WHERE e.rel IN ('maps to', 'is a') AND lower(t.standard_concept) = 's') AS n_s,
    count(*) FILTER (WHERE e.rel IN ('maps to', 'is a') AND lower(t.standard_concept) IS DISTINCT FROM 's') AS n_ns,
    count(*) FILTER (WHERE e.rel NOT IN ('maps to', 'is a')) AS n_r
  FROM {_LIVE} e JOIN concept t ON t.concept_id = e.concept_id_2 AND t.concept_name IS NOT NULL
  GROUP BY e.concept_id_1) r ON r.concept_id = c.concept_id""")


def local_in_degree() -> str:
    return with_views(f"""
SELECT concept_id_2 AS concept_id, count(*) AS local_map_number FROM {_LIVE} e
WHERE concept_id_1 >= 2000000000 GROUP BY concept_id_2""")


def statistic_pivot() -> str:
    return with_views("""
SELECT m_concept_id AS concept_id,
  max(m_value_as_number) FILTER (WHERE m_statistic_type_id = 'AVG') AS m_value_avg,
  max(m_value_as_number) FILTER (WHERE m_statistic_type_id = 'FREQ') AS m_frequency_value
FROM mapper_statistic WHERE m_statistic_type_id IN ('AVG', 'FREQ') GROUP BY m_concept_id""")
