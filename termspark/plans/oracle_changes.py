"""DuckDB twins of the import and maintenance queries."""

from __future__ import annotations

from .fixture_sql import with_views
from .oracle_documents import documents_select

_IMPORT = {
    "staged": """
SELECT local_concept_name AS concept_name, local_concept_code AS concept_code, 'FR' AS m_language_id,
       'EUROPE' AS m_project_type_id, 'Observation' AS domain_id, 'LOCAL_TERMS' AS vocabulary_id,
       'FREQ' AS m_statistic_type_id, local_frequency AS m_value_as_number, src_order
FROM project_terms""",
    "tagged": """
SELECT *, CASE WHEN concept_name IS NULL THEN 'null:concept_name'
               WHEN m_value_as_number IS NOT NULL AND TRY_CAST(m_value_as_number AS DOUBLE) IS NULL
               THEN 'not_numeric:m_value_as_number' END AS reject_reason
FROM staged""",
    "passed": """
SELECT concept_name, concept_code, m_language_id, m_project_type_id, domain_id, vocabulary_id,
       m_statistic_type_id, TRY_CAST(m_value_as_number AS DOUBLE) AS m_value_as_number, src_order
FROM tagged WHERE reject_reason IS NULL""",
    "ranked": """
SELECT *, row_number() OVER (PARTITION BY concept_code, concept_name ORDER BY src_order) AS rn FROM passed""",
    "good": "SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1",
    "rejects": """
SELECT * FROM tagged WHERE reject_reason IS NOT NULL
UNION ALL
SELECT concept_name, concept_code, m_language_id, m_project_type_id, domain_id, vocabulary_id,
       m_statistic_type_id, CAST(m_value_as_number AS VARCHAR), src_order, 'duplicate'
FROM ranked WHERE rn > 1""",
}

_INSERT = dict(_IMPORT)
_INSERT.update({
    "startv": "SELECT greatest(max(concept_id), 2000000000) + 1 AS s FROM concept",
    "proj": """SELECT lower(m_project_type_id) AS ptype, min(m_project_id) AS pid FROM mapper_project
               GROUP BY lower(m_project_type_id)""",
    "numbered": """
SELECT g.*, CAST((SELECT s FROM startv) + row_number() OVER (ORDER BY g.src_order) - 1 AS BIGINT) AS concept_id,
       proj.pid
FROM good g LEFT JOIN proj ON lower(g.m_project_type_id) = proj.ptype""",
    "new_concepts": """
SELECT concept_id, concept_name, domain_id, vocabulary_id, domain_id AS concept_class_id,
       CAST(NULL AS VARCHAR) AS standard_concept, COALESCE(concept_code, 'UNKNOWN') AS concept_code,
       DATE '2025-01-01' AS valid_start_date, DATE '2099-01-01' AS valid_end_date,
       CAST(NULL AS VARCHAR) AS invalid_reason, m_language_id,
       CAST(COALESCE(pid, 1) AS INTEGER) AS m_project_id
FROM numbered""",
})


def import_valid() -> str:
    return with_views("SELECT * FROM good", _IMPORT)


def import_rejects() -> str:
    return with_views("SELECT * FROM rejects", _IMPORT)


def import_report() -> str:
    return with_views("SELECT reject_reason AS \"check\", count(*) AS bad_rows FROM rejects GROUP BY reject_reason",
                      _IMPORT)


_GONE = """
SELECT concept_id FROM concept
WHERE vocabulary_id = 'Brand#3' AND domain_id = 'ECONOMY'
  AND m_project_id IN (SELECT m_project_id FROM mapper_project WHERE lower(m_project_type_id) = lower('asia'))"""


def cascade_delete_counts() -> str:
    return with_views("""
SELECT 'concept' AS table_name, count(*) AS rows_after FROM concept WHERE concept_id NOT IN (SELECT concept_id FROM gone)
UNION ALL
SELECT 'mapper_statistic', count(*) FROM mapper_statistic WHERE m_concept_id NOT IN (SELECT concept_id FROM gone)
UNION ALL
SELECT 'concept_synonym', count(*) FROM concept_synonym WHERE concept_id NOT IN (SELECT concept_id FROM gone)
UNION ALL
SELECT 'concept_relationship', count(*) FROM concept_relationship
WHERE concept_id_1 NOT IN (SELECT concept_id FROM gone) AND concept_id_2 NOT IN (SELECT concept_id FROM gone)""",
                      {"gone": _GONE})


def insert_concepts() -> str:
    return with_views("SELECT * FROM new_concepts", _INSERT)


def insert_statistics() -> str:
    return with_views("""
SELECT concept_id AS m_concept_id, m_statistic_type_id, m_value_as_number,
       CAST(NULL AS VARCHAR) AS m_value_as_string, 4 AS m_algo_id, 10 AS m_user_id,
       TIMESTAMP '2025-01-01 00:00:00' AS m_valid_start_datetime
FROM numbered""", _INSERT)


def replace_concepts() -> str:
    ctes = {"gone": _GONE.replace("'Brand#3'", "'LOCAL_TERMS'").replace("'ECONOMY'", "'Observation'")
                        .replace("lower('asia')", "lower('EUROPE')")}
    ctes["kept"] = "SELECT * FROM concept WHERE concept_id NOT IN (SELECT concept_id FROM gone)"
    ins = dict(_INSERT)
    ins["startv"] = "SELECT greatest(max(concept_id), 2000000000) + 1 AS s FROM kept"
    ctes.update(ins)
    return with_views("SELECT * FROM kept UNION ALL SELECT * FROM new_concepts", ctes)


_RENAME = {
    "users": """SELECT DISTINCT user_id + 2000000000 AS concept_id FROM events WHERE event_type = 'signup'""",
    "changed": """
SELECT concept_id FROM users
UNION
SELECT concept_id_2 FROM concept_relationship WHERE concept_id_1 IN (SELECT concept_id FROM users)""",
    "concept_v2": """
SELECT concept_id,
       CASE WHEN concept_id IN (SELECT concept_id FROM changed) THEN concept_name || ' rev' ELSE concept_name END
         AS concept_name,
       domain_id, vocabulary_id, concept_class_id, standard_concept, concept_code, valid_start_date,
       valid_end_date, invalid_reason, m_language_id, m_project_id
FROM concept""",
}


def document_upsert() -> str:
    # Upserting the rebuilt documents of every affected concept must equal a full
    # rebuild over the renamed concept table.
    return with_views(documents_select(concept="concept_v2"), _RENAME)


def scd2_merge() -> str:
    ctes = dict(_RENAME)
    ctes.update(_INSERT)
    ctes["hist"] = """
SELECT concept_id, concept_name, domain_id, vocabulary_id, concept_class_id, standard_concept, concept_code,
       invalid_reason, m_language_id, m_project_id FROM concept"""
    ctes["snap"] = """
SELECT concept_id, concept_name, domain_id, vocabulary_id, concept_class_id, standard_concept, concept_code,
       invalid_reason, m_language_id, m_project_id FROM concept_v2
WHERE invalid_reason IS NULL OR invalid_reason <> 'D'
UNION ALL
SELECT concept_id, concept_name, domain_id, vocabulary_id, concept_class_id, standard_concept, concept_code,
       invalid_reason, m_language_id, m_project_id FROM new_concepts"""
    body = """
SELECT h.*, DATE '2024-01-01' AS valid_start_date,
       CASE WHEN s.concept_id IS NOT NULL AND h.concept_name IS NOT DISTINCT FROM s.concept_name
             AND h.domain_id IS NOT DISTINCT FROM s.domain_id AND h.vocabulary_id IS NOT DISTINCT FROM s.vocabulary_id
             AND h.concept_class_id IS NOT DISTINCT FROM s.concept_class_id
             AND h.standard_concept IS NOT DISTINCT FROM s.standard_concept
             AND h.concept_code IS NOT DISTINCT FROM s.concept_code
             AND h.invalid_reason IS NOT DISTINCT FROM s.invalid_reason
             AND h.m_language_id IS NOT DISTINCT FROM s.m_language_id
             AND h.m_project_id IS NOT DISTINCT FROM s.m_project_id
            THEN DATE '2099-01-01' ELSE DATE '2025-01-01' END AS valid_end_date
FROM hist h LEFT JOIN snap s ON s.concept_id = h.concept_id
UNION ALL
SELECT s.*, DATE '2025-01-01', DATE '2099-01-01'
FROM snap s LEFT JOIN hist h ON s.concept_id = h.concept_id
WHERE h.concept_id IS NULL
   OR NOT (h.concept_name IS NOT DISTINCT FROM s.concept_name
           AND h.domain_id IS NOT DISTINCT FROM s.domain_id AND h.vocabulary_id IS NOT DISTINCT FROM s.vocabulary_id
           AND h.concept_class_id IS NOT DISTINCT FROM s.concept_class_id
           AND h.standard_concept IS NOT DISTINCT FROM s.standard_concept
           AND h.concept_code IS NOT DISTINCT FROM s.concept_code
           AND h.invalid_reason IS NOT DISTINCT FROM s.invalid_reason
           AND h.m_language_id IS NOT DISTINCT FROM s.m_language_id
           AND h.m_project_id IS NOT DISTINCT FROM s.m_project_id)"""
    return with_views(body, ctes)
