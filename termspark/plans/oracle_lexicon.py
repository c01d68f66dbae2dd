"""DuckDB twins of the lexicon and quality queries."""

from __future__ import annotations

from .fixture_sql import with_views
from .oracle_text import lit

_CODES = {
    "local_codes": """SELECT p_partkey + 2000000000 AS concept_id, 'K' || CAST(p_partkey % 300 AS VARCHAR) AS concept_code,
                             p_name AS lib FROM part""",
    "standard_codes": """SELECT s_suppkey + 1 AS concept_id, 'K.' || CAST(s_suppkey AS VARCHAR) AS concept_code
                         FROM supplier""",
    "pairs": """SELECT l.concept_id AS concept_id_1, s.concept_id AS concept_id_2
                FROM local_codes l JOIN standard_codes s ON replace(s.concept_code, '.', '') = l.concept_code""",
    "edges2": """SELECT concept_id_1, concept_id_2, 'Maps to' AS relationship_id, DATE '2025-01-01' AS valid_start_date,
                        DATE '2099-01-01' AS valid_end_date FROM pairs
                 UNION ALL
                 SELECT concept_id_2, concept_id_1, 'Mapped from', DATE '2025-01-01', DATE '2099-01-01' FROM pairs""",
}


def synonym_groups() -> str:
    return with_views("""
SELECT p_type AS group_key, array_to_string(list_sort(list_distinct(list(p_name))), ',') AS result
FROM part GROUP BY p_type HAVING count(*) > 1""")


def bilingual_lexicon() -> str:
    return with_views("""
SELECT word, word || ' => ' || string_agg(lemma, ',' ORDER BY rank, lemma) AS rule
FROM (
  SELECT replace(fr.concept_synonym_name, '_', ' ') AS word, replace(en.concept_synonym_name, '_', ' ') AS lemma,
         CASE WHEN en.concept_synonym_name = c.concept_name THEN 2 ELSE 1 END AS rank
  FROM concept_synonym fr
  JOIN concept_synonym en ON en.concept_id = fr.concept_id AND en.language_concept_id = 4180186
  JOIN concept c ON c.concept_id = en.concept_id
  WHERE fr.language_concept_id = 4180190) p
WHERE trim(word) <> ''
GROUP BY word""")


def translate_words(words) -> str:
    values = ", ".join(f"({lit(w)}, {lit(l)}, {r})" for w, l, r in words)
    return with_views(r"""
SELECT doc_id, string_agg(' ' || COALESCE(lx.lemma, t.red), '' ORDER BY t.pos) AS translation
FROM (
  SELECT doc_id, pos, CASE WHEN length(tok) > 4
                          THEN regexp_replace(regexp_replace(tok, 's$', ''), 'ée?s?$', 'er') ELSE tok END AS red
  FROM (SELECT doc_id, unnest(toks) AS tok, unnest(range(len(toks))) AS pos
        FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]') AS toks
              FROM documents WHERE lang = 'fr') d) u) t
LEFT JOIN (
  SELECT w, lemma FROM (
    SELECT lower(word) AS w, lemma, row_number() OVER (PARTITION BY lower(word) ORDER BY rank, lemma) AS rn
    FROM lex) x WHERE rn = 1) lx ON lower(t.red) = lx.w
GROUP BY doc_id""", {"lex": f"SELECT * FROM (VALUES {values}) v(word, lemma, rank)"})


def translation_batches(sep: str = " ____ ", budget: int = 500) -> str:
    n = len(sep)
    ctes = {
        "lab": f"""SELECT vocabulary_id AS bucket, concept_code AS cd, concept_name AS lib,
                          length(concept_name) + {2 * n} AS w, length(concept_name) + {n} AS r,
                          row_number() OVER (PARTITION BY vocabulary_id ORDER BY concept_name, concept_code) AS rn
                   FROM concept""",
    }
    body = f"""
, rec AS (
  SELECT bucket, rn, CAST(CASE WHEN w >= {budget} THEN 1 ELSE 0 END AS BIGINT) AS batch,
         CASE WHEN w >= {budget} THEN least(r, {budget}) ELSE w END AS c
  FROM lab WHERE rn = 1
  UNION ALL
  SELECT l.bucket, l.rn, CASE WHEN rec.c + l.w >= {budget} THEN rec.batch + 1 ELSE rec.batch END,
         CASE WHEN rec.c + l.w >= {budget} THEN least(l.r, {budget}) ELSE least(rec.c + l.w, {budget}) END
  FROM rec JOIN lab l ON l.bucket = rec.bucket AND l.rn = rec.rn + 1)
SELECT bucket, batch, count(*) AS n,
       string_agg(cd, {lit(sep)} ORDER BY lib, cd) AS group_cd,
       string_agg(lib, {lit(sep)} ORDER BY lib, cd) AS group_lib
FROM rec JOIN lab USING (bucket, rn)
GROUP BY bucket, batch"""
    sql = with_views("SELECT 1", ctes)
    head = sql[: sql.rindex("\nSELECT 1")]
    return head.replace("WITH ", "WITH RECURSIVE ", 1) + body


def code_mapping() -> str:
    return with_views("SELECT concept_id_1, concept_id_2 FROM pairs", _CODES)


def bidirectional_edges() -> str:
    return with_views("SELECT * FROM edges2", _CODES)


def two_hop() -> str:
    return with_views("""
SELECT DISTINCT f.concept_id_1, e.concept_id_2, e.relationship_id
FROM (SELECT DISTINCT concept_id_1, concept_id_2 FROM edges2) f
JOIN concept_relationship e ON e.concept_id_1 = f.concept_id_2 AND e.m_modif_end_datetime IS NULL
WHERE f.concept_id_1 <> e.concept_id_2""", _CODES)


def code_list_concepts() -> str:
    return with_views("""
SELECT lib AS concept_name, 'Condition' AS domain_id, 'CIM10' AS vocabulary_id, 'billing code' AS concept_class_id,
       COALESCE(concept_code, 'UNKNOWN') AS concept_code, DATE '2025-01-01' AS valid_start_date,
       DATE '2099-01-01' AS valid_end_date, 'FR' AS m_language_id
FROM local_codes""", _CODES)


def quality_duplicates() -> str:
    parts = []
    for table, keys in (("concept", "concept_id"),
                        ("concept_synonym", "concept_id, concept_synonym_name, language_concept_id"),
                        ("concept_relationship", "concept_id_1, concept_id_2, relationship_id"),
                        ("vocabulary", "vocabulary_id"), ("domain", "domain_id"), ("concept_class", "concept_class_id"),
                        ("relationship", "relationship_id"), ("concept_ancestor", "ancestor_concept_id, descendant_concept_id"),
                        ("drug_strength", "drug_concept_id, ingredient_concept_id"), ("mapper_project", "m_project_id")):
        parts.append(f"""SELECT 'duplicate_key' AS rule, '{table}' AS table_name,
                                CAST(COALESCE(sum(ct), 0) AS BIGINT) AS bad_rows
                         FROM (SELECT count(*) AS ct FROM {table} GROUP BY {keys} HAVING count(*) > 1) d""")
    return with_views("\nUNION ALL\n".join(parts))


# table: its foreign keys, as "column parent key"
_FOREIGN = {
    "concept": ["domain_id domain domain_id", "vocabulary_id vocabulary vocabulary_id", "concept_class_id concept_class concept_class_id",
                "m_project_id mapper_project m_project_id"],
    "vocabulary": ["vocabulary_concept_id concept concept_id"],
    "domain": ["domain_concept_id concept concept_id"],
    "concept_class": ["concept_class_concept_id concept concept_id"],
    "concept_relationship": ["concept_id_1 concept concept_id", "concept_id_2 concept concept_id", "relationship_id relationship relationship_id"],
    "relationship": ["reverse_relationship_id relationship relationship_id", "relationship_concept_id concept concept_id"],
    "concept_synonym": ["concept_id concept concept_id", "language_concept_id concept concept_id"],
    "concept_ancestor": ["ancestor_concept_id concept concept_id", "descendant_concept_id concept concept_id"],
    "drug_strength": ["drug_concept_id concept concept_id", "ingredient_concept_id concept concept_id", "amount_unit_concept_id concept concept_id",
                      "numerator_unit_concept_id concept concept_id", "denominator_unit_concept_id concept concept_id"],
    "mapper_statistic": ["m_concept_id concept concept_id"],
}
# table: its columns that must not be null
_REQUIRED = {
    "concept": "concept_id concept_name domain_id vocabulary_id concept_class_id concept_code valid_start_date valid_end_date",
    "vocabulary": "vocabulary_id vocabulary_name vocabulary_reference vocabulary_concept_id",
    "domain": "domain_id domain_name domain_concept_id",
    "concept_class": "concept_class_id concept_class_name concept_class_concept_id",
    "concept_relationship": "concept_id_1 concept_id_2 relationship_id valid_start_date valid_end_date",
    "relationship": "relationship_id relationship_name is_hierarchical defines_ancestry reverse_relationship_id relationship_concept_id",
    "concept_synonym": "concept_id concept_synonym_name language_concept_id",
    "concept_ancestor": "ancestor_concept_id descendant_concept_id min_levels_of_separation max_levels_of_separation",
    "drug_strength": "drug_concept_id ingredient_concept_id valid_start_date valid_end_date",
}


def quality_orphans() -> str:
    parts = []
    for table, keys in _FOREIGN.items():
        for column, to, key in map(str.split, keys):
            only = " AND c.m_statistic_type_id IN ('AVG', 'FREQ')" if table == "mapper_statistic" else ""
            parts.append(f"SELECT 'orphan:{column}' AS rule, '{table}' AS table_name, count(*) AS bad_rows FROM {table} c "
                         f"WHERE c.{column} IS NOT NULL{only} AND NOT EXISTS (SELECT 1 FROM {to} p WHERE p.{key} = c.{column})")
    return with_views("\nUNION ALL\n".join(parts))


def quality_checks() -> str:
    parts = []
    for table, cols in _REQUIRED.items():
        for c in cols.split():
            parts.append(f"SELECT 'not_null:{c}' AS rule, '{table}' AS table_name, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS bad_rows FROM {table}")
    for rule, table, bad in (
            ("concept_name_not_empty", "concept", "trim(concept_name) = ''"),
            ("concept_code_not_empty", "concept", "trim(concept_code) = ''"),
            ("standard_concept", "concept", "standard_concept NOT IN ('C', 'S')"),
            *(("invalid_reason", t, "invalid_reason NOT IN ('D', 'U')") for t in ("concept", "concept_relationship", "drug_strength"))):
        parts.append(f"SELECT 'check:{rule}', '{table}', count(*) FILTER (WHERE {bad}) FROM {table}")
    return with_views("\nUNION ALL\n".join(parts))
