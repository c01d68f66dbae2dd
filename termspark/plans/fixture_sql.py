"""The fixture views of ``sources/tables.py`` written as ANSI SQL CTEs (DuckDB twin).

Every oracle query is ``WITH <these views> <query>``; the views read only the
pre-registered driver tables.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["mapper_project"] = """
SELECT r_regionkey + 1 AS m_project_id, r_name AS m_project_type_id FROM region"""

VIEWS["concept"] = """
SELECT s_suppkey + 1 AS concept_id, s_name AS concept_name, 'Supplier' AS domain_id,
       'NATION_' || CAST(s_nationkey AS VARCHAR) AS vocabulary_id, 'Supplier' AS concept_class_id,
       CASE WHEN s_suppkey % 3 < 2 THEN 'S' END AS standard_concept,
       'S' || CAST(s_suppkey AS VARCHAR) AS concept_code,
       DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date,
       CASE WHEN s_suppkey % 10 = 0 THEN 'D' END AS invalid_reason,
       CAST(NULL AS VARCHAR) AS m_language_id, CAST(NULL AS INTEGER) AS m_project_id
FROM supplier
UNION ALL
SELECT p_partkey + 2000000000, p_name, p_type, p_brand, 'Part', CAST(NULL AS VARCHAR),
       'P' || CAST(p_partkey AS VARCHAR), DATE '1970-01-01', DATE '2099-12-31', CAST(NULL AS VARCHAR),
       CASE p_partkey % 3 WHEN 0 THEN 'FR' WHEN 1 THEN 'EN' END,
       CAST(CASE WHEN p_size % 6 <> 0 THEN p_size % 6 END AS INTEGER)
FROM part"""

VIEWS["concept_relationship"] = """
SELECT l_partkey * 1000000 + l_suppkey AS m_concept_relationship_id,
       l_partkey + 2000000000 AS concept_id_1, l_suppkey + 1 AS concept_id_2,
       CASE l_partkey % 5 WHEN 0 THEN 'Maps to' WHEN 1 THEN 'Is a' WHEN 2 THEN 'Mapped from'
            WHEN 3 THEN 'Subsumes'
            ELSE CASE WHEN l_suppkey % 2 = 0 THEN 'Maps to' ELSE 'Subsumes' END END AS relationship_id,
       DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date,
       CAST(NULL AS VARCHAR) AS invalid_reason,
       CASE WHEN (l_partkey + l_suppkey) % 7 = 0 THEN TIMESTAMP '2024-06-01 00:00:00' END AS m_modif_end_datetime,
       CASE WHEN l_suppkey % 2 = 0 THEN 'checked' END AS m_mapping_comment,
       CAST((l_partkey + l_suppkey) % 5 AS INTEGER) AS m_mapping_rate
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) d"""

VIEWS["concept_synonym"] = """
SELECT p_partkey + 2000000000 AS concept_id, p_name || ' ' || p_type AS concept_synonym_name,
       CAST(4180186 AS BIGINT) AS language_concept_id FROM part
UNION ALL
SELECT p_partkey + 2000000000, p_brand || ' ' || p_name, CAST(4180190 AS BIGINT) FROM part WHERE p_partkey % 2 = 0
UNION ALL
SELECT p_partkey + 2000000000, p_name, CAST(4180186 AS BIGINT) FROM part WHERE p_partkey % 5 = 0"""

VIEWS["part_counts"] = """
SELECT l_partkey, avg(l_quantity) AS avg_q, count(*) AS ct FROM lineitem GROUP BY l_partkey"""

VIEWS["mapper_statistic"] = """
SELECT l_partkey + 2000000000 AS m_concept_id, 'AVG' AS m_statistic_type_id, avg_q AS m_value_as_number,
       CAST(NULL AS VARCHAR) AS m_value_as_string, 1 AS m_algo_id, 1 AS m_user_id,
       TIMESTAMP '2024-01-01 00:00:00' AS m_valid_start_datetime
FROM part_counts WHERE l_partkey % 4 <> 0
UNION ALL
SELECT l_partkey + 2000000000, 'FREQ',
       CAST(CASE WHEN ct > q[1] THEN 4 WHEN ct > q[2] THEN 3 WHEN ct > q[3] THEN 2 ELSE 1 END AS DOUBLE),
       CAST(NULL AS VARCHAR), 1, 1, TIMESTAMP '2024-01-01 00:00:00'
FROM part_counts, (SELECT quantile_disc(ct, [0.75, 0.5, 0.25]) AS q FROM part_counts) pq
UNION ALL
SELECT cr.m_concept_relationship_id, 'VOTE_MAPPING', CAST(NULL AS DOUBLE),
       CASE WHEN e.event_type IN ('purchase', 'signup', 'click') THEN 'UP' ELSE 'DOWN' END,
       1, CAST(e.user_id AS INTEGER), e.ts
FROM events e JOIN concept_relationship cr ON cr.concept_id_1 = e.user_id + 2000000000"""

VIEWS["person"] = "SELECT CAST(c_nationkey AS BIGINT) AS gender_concept_id FROM customer"
VIEWS["visit_occurrence"] = "SELECT CAST(o_custkey AS BIGINT) AS visit_concept_id FROM orders"
VIEWS["visit_detail"] = "SELECT CAST(o_custkey % 97 AS BIGINT) AS visit_detail_concept_id FROM orders"
VIEWS["observation"] = """
SELECT CAST(user_id AS BIGINT) AS observation_concept_id, value AS value_as_number,
       props AS value_as_string FROM events"""
VIEWS["measurement"] = """
SELECT CAST(l_partkey AS BIGINT) AS measurement_concept_id, l_quantity AS value_as_number FROM lineitem"""
VIEWS["condition_occurrence"] = "SELECT CAST(l_suppkey AS BIGINT) AS condition_concept_id FROM lineitem"
VIEWS["procedure_occurrence"] = "SELECT CAST(user_id AS BIGINT) AS procedure_concept_id FROM events"
VIEWS["drug_exposure"] = "SELECT CAST(l_partkey % 101 AS BIGINT) AS drug_concept_id FROM lineitem"

VIEWS["domain"] = """
SELECT domain_id, 'domain ' || domain_id AS domain_name, min(concept_id) AS domain_concept_id FROM concept GROUP BY domain_id"""
VIEWS["concept_class"] = """
SELECT concept_class_id, 'concept_class ' || concept_class_id AS concept_class_name, min(concept_id) AS concept_class_concept_id
FROM concept GROUP BY concept_class_id"""
VIEWS["vocabulary"] = """
SELECT vocabulary_id, 'vocabulary ' || vocabulary_id AS vocabulary_name,
       CASE WHEN vocabulary_id LIKE 'NATION%' THEN 'nation' ELSE 'brand' END AS vocabulary_reference,
       CAST(NULL AS VARCHAR) AS vocabulary_version, min(concept_id) AS vocabulary_concept_id FROM concept GROUP BY vocabulary_id"""
VIEWS["relationship"] = """
SELECT relationship_id, lower(relationship_id) AS relationship_name,
       CASE WHEN relationship_id IN ('Is a', 'Subsumes') THEN '1' ELSE '0' END AS is_hierarchical,
       CASE WHEN relationship_id IN ('Is a', 'Subsumes') THEN '1' ELSE '0' END AS defines_ancestry,
       CASE relationship_id WHEN 'Maps to' THEN 'Mapped from' WHEN 'Mapped from' THEN 'Maps to'
            WHEN 'Is a' THEN 'Subsumes' WHEN 'Subsumes' THEN 'Is a' END AS reverse_relationship_id,
       min(concept_id_2) AS relationship_concept_id FROM concept_relationship GROUP BY relationship_id"""
VIEWS["concept_ancestor"] = """
SELECT DISTINCT CASE WHEN relationship_id = 'Is a' THEN concept_id_2 ELSE concept_id_1 END AS ancestor_concept_id,
       CASE WHEN relationship_id = 'Is a' THEN concept_id_1 ELSE concept_id_2 END AS descendant_concept_id,
       1 AS min_levels_of_separation, 1 AS max_levels_of_separation
FROM concept_relationship WHERE relationship_id IN ('Is a', 'Subsumes')"""
VIEWS["drug_strength"] = """
SELECT l_partkey + 2000000000 AS drug_concept_id, l_suppkey + 1 AS ingredient_concept_id,
       CAST(min(l_quantity) AS DECIMAL(38, 10)) AS amount_value, CAST(NULL AS BIGINT) AS amount_unit_concept_id,
       CAST(max(l_quantity) AS DECIMAL(38, 10)) AS numerator_value, CAST(NULL AS BIGINT) AS numerator_unit_concept_id,
       CAST(NULL AS DECIMAL(38, 10)) AS denominator_value, CAST(NULL AS BIGINT) AS denominator_unit_concept_id,
       CAST(count(*) AS INTEGER) AS box_size, DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date,
       CAST(NULL AS VARCHAR) AS invalid_reason
FROM lineitem GROUP BY l_partkey, l_suppkey"""

VIEWS["project_terms"] = """
SELECT CASE WHEN p_partkey % 11 <> 0 THEN p_name END AS local_concept_name,
       p_brand AS local_concept_code,
       CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size AS VARCHAR) ELSE 'bad' END AS local_frequency,
       p_partkey AS src_order
FROM part"""


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` all fixture views (plus ``extra`` CTEs, in order) then ``body``."""
    ctes = dict(VIEWS)
    if extra:
        ctes.update(extra)
    parts = [f"{name} AS ({sql.strip()})" for name, sql in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
