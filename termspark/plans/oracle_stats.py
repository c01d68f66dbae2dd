"""DuckDB twins of the statistics queries."""

from __future__ import annotations

from ..sources.tables import EVENT_SOURCES
from .fixture_sql import with_views

AS_OF = "2025-01-01 00:00:00"


def _events(sources=EVENT_SOURCES) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{tbl}' AS source, {col} AS concept_id FROM {tbl}" for tbl, col in sources)


def _ctes(sources=EVENT_SOURCES) -> dict[str, str]:
    return {
        "ev": _events(sources),
        "cnt": """SELECT source, concept_id, count(*) AS ct FROM ev
                  WHERE concept_id IS NOT NULL AND concept_id <> 0 GROUP BY source, concept_id""",
        "cuts": "SELECT source, quantile_disc(ct, [0.75, 0.5, 0.25]) AS q FROM cnt GROUP BY source",
        "fc": """SELECT c.source, c.concept_id, c.ct,
                   CASE WHEN c.ct > q[1] THEN 4 WHEN c.ct > q[2] THEN 3 WHEN c.ct > q[3] THEN 2 ELSE 1 END
                   AS m_frequency_value
                 FROM cnt c JOIN cuts USING (source)""",
        "vs": """SELECT source, concept_id, count(value_as_number) AS n, sum(value_as_number) AS total,
                   avg(value_as_number) AS m_value_avg, max(value_as_string IS NOT NULL) AS value_is_text
                 FROM (SELECT 'measurement' AS source, measurement_concept_id AS concept_id, value_as_number,
                              CAST(NULL AS VARCHAR) AS value_as_string FROM measurement
                       UNION ALL
                       SELECT 'observation', observation_concept_id, value_as_number, value_as_string
                       FROM observation) v
                 WHERE concept_id IS NOT NULL AND concept_id <> 0
                 GROUP BY source, concept_id""",
        "va": """SELECT concept_id, sum(total) / NULLIF(sum(n), 0) AS m_value_avg,
                   max(value_is_text) AS value_is_text FROM vs GROUP BY concept_id""",
        "fcol": "SELECT concept_id, max(m_frequency_value) AS m_frequency_value FROM fc GROUP BY concept_id",
    }


def frequency_class_one() -> str:
    return with_views("SELECT source, concept_id, ct, m_frequency_value FROM fc",
                      _ctes((("measurement", "measurement_concept_id"),)))


def frequency_class_all() -> str:
    return with_views("SELECT source, concept_id, ct, m_frequency_value FROM fc", _ctes())


def frequency_union() -> str:
    return with_views("SELECT DISTINCT concept_id, m_frequency_value FROM fc", _ctes())


def frequency_collapsed() -> str:
    return with_views("SELECT concept_id, m_frequency_value FROM fcol", _ctes())


def value_average_by_source() -> str:
    return with_views("""SELECT source, concept_id, n, round(m_value_avg, 6) AS m_value_avg, value_is_text
                         FROM vs""", _ctes())


def value_average() -> str:
    return with_views("SELECT concept_id, round(m_value_avg, 6) AS m_value_avg, value_is_text FROM va",
                      _ctes())


def statistic_upsert() -> str:
    extra = _ctes()
    extra["newst"] = f"""
      SELECT concept_id AS m_concept_id, 'FREQ' AS m_statistic_type_id,
             CAST(m_frequency_value AS DOUBLE) AS m_value_as_number, CAST(NULL AS VARCHAR) AS m_value_as_string,
             4 AS m_algo_id, 10 AS m_user_id, TIMESTAMP '{AS_OF}' AS m_valid_start_datetime FROM fcol
      UNION ALL
      SELECT concept_id, 'AVG', m_value_avg, CAST(NULL AS VARCHAR), 4, 10, TIMESTAMP '{AS_OF}' FROM va"""
    body = """
SELECT m_concept_id, m_statistic_type_id, round(m_value_as_number, 6) AS m_value_as_number,
       m_value_as_string, m_algo_id, m_user_id, m_valid_start_datetime
FROM (
  SELECT * FROM mapper_statistic o
  WHERE NOT EXISTS (SELECT 1 FROM newst n
                    WHERE n.m_concept_id = o.m_concept_id AND n.m_statistic_type_id = o.m_statistic_type_id)
  UNION ALL SELECT * FROM newst) u"""
    return with_views(body, extra)
