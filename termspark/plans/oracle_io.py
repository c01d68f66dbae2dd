"""DuckDB twins of ``registry_io``."""

from __future__ import annotations

from . import oracle_lexicon as ol
from . import oracle_text as ot
from .fixture_sql import with_views
from .oracle_search import _index_ctes

PART_TEXT = """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part"""


def project_csv() -> str:
    return with_views("""
SELECT CAST(c.concept_id AS VARCHAR) AS concept_id, c.concept_name, c.concept_code, p.m_project_type_id
FROM concept c JOIN mapper_project p USING (m_project_id)""")


def import_control_report() -> str:
    return with_views("""
SELECT "check", count(*) AS n FROM (
  SELECT CASE WHEN name IS NULL THEN 'null:concept_name' WHEN bad THEN 'not_numeric:m_value_as_number'
              WHEN rn > 1 THEN 'duplicate' ELSE 'good:' || project END AS "check"
  FROM (SELECT *, row_number() OVER (PARTITION BY project, name, code, name IS NULL OR bad ORDER BY src_order) AS rn
        FROM (SELECT local_concept_name AS name, local_concept_code AS code, src_order,
                     CASE src_order % 2 WHEN 0 THEN 'EUROPE' ELSE 'ASIA' END AS project,
                     src_order % 2 = 0 AND local_frequency = 'bad' AS bad FROM project_terms) a) b) c
GROUP BY "check" """)


# the columns of the vocabulary tables, in file order
_COLUMNS = {
    "concept": "concept_id concept_name domain_id vocabulary_id concept_class_id standard_concept concept_code valid_start_date valid_end_date "
               "invalid_reason",
    "vocabulary": "vocabulary_id vocabulary_name vocabulary_reference vocabulary_version vocabulary_concept_id",
    "domain": "domain_id domain_name domain_concept_id",
    "concept_class": "concept_class_id concept_class_name concept_class_concept_id",
    "concept_relationship": "concept_id_1 concept_id_2 relationship_id valid_start_date valid_end_date invalid_reason",
    "relationship": "relationship_id relationship_name is_hierarchical defines_ancestry reverse_relationship_id relationship_concept_id",
    "concept_synonym": "concept_id concept_synonym_name language_concept_id",
    "concept_ancestor": "ancestor_concept_id descendant_concept_id min_levels_of_separation max_levels_of_separation",
    "drug_strength": "drug_concept_id ingredient_concept_id amount_value amount_unit_concept_id numerator_value numerator_unit_concept_id "
                     "denominator_value denominator_unit_concept_id box_size valid_start_date valid_end_date invalid_reason",
}


def vocabulary_snapshot() -> str:
    parts = []
    for table, cols in _COLUMNS.items():
        shown = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cols.split())
        parts.append(f"SELECT '{table}' AS table_name, {shown} AS content FROM {table}")
    return with_views("\nUNION ALL\n".join(parts))


def synonym_rules() -> str:
    return """
SELECT 'group' AS kind, min(p_name) AS term, CAST(count(DISTINCT p_name) AS VARCHAR) AS value
FROM part GROUP BY p_type HAVING count(*) > 1 AND count(DISTINCT p_name) > 1
UNION ALL SELECT DISTINCT 'rewrite', replace(p_brand, '#', '_'), p_type FROM part"""


def tokens_whitespace() -> str:
    return r"""
SELECT doc_id, CAST(len(w) AS INTEGER) AS n, CAST(len(list_distinct(w)) AS INTEGER) AS n_distinct
FROM (SELECT doc_id, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS w FROM documents) d"""


def tokens_reversed() -> str:
    return "SELECT p_partkey, array_to_string([reverse(x) FOR x IN string_split(p_name, ' ') IF x <> ''], '|') AS value FROM part"


def tokens_delimiter() -> str:
    capital = "array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN string_split(p_name, ' ')], ' ')"
    split = "raw"
    for a, b in ((r"([\p{Ll}])([\p{Lu}])", r"\1 \2"), (r"([\p{L}])([\p{N}])", r"\1 \2"), (r"([\p{N}])([\p{L}])", r"\1 \2")):
        split = f"regexp_replace({split}, '{a}', '{b}', 'g')"
    return rf"""
SELECT p_partkey, array_to_string(list_concat(parts, [x FOR x IN joined IF x <> '' AND NOT list_contains(parts, x)]), '|') AS value
FROM (SELECT p_partkey, regexp_extract_all({split}, '[\p{{L}}\p{{N}}]+') AS parts,
             [array_to_string(regexp_extract_all(w, '[\p{{L}}\p{{N}}]+'), '') FOR w IN string_split(raw, ' ')] AS joined
      FROM (SELECT p_partkey, regexp_replace(p_brand || ' ' || {capital} || 'Lot' || CAST(p_size AS VARCHAR),
                                             '([a-z]) ([A-Z])', '\1\2', 'g') AS raw FROM part) r) d"""


def tokens_payload() -> str:
    return """
SELECT p_partkey, CAST(i - 1 AS INTEGER) AS pos, string_split(t[i], '|')[1] AS token,
       coalesce(TRY_CAST(string_split(t[i], '|')[2] AS DOUBLE), 1.0) AS payload
FROM (SELECT p_partkey, t, unnest(range(1, len(t) + 1)) AS i
      FROM (SELECT p_partkey, [x FOR x IN string_split('size|' || CAST(p_size AS VARCHAR) || ' ' || p_type, ' ') IF x <> ''] AS t FROM part) a) b"""


def match_all() -> str:
    return with_views("""
SELECT p_partkey AS query_id, d.rank, d.concept_id, CAST(1.0 AS DOUBLE) AS score FROM part,
  (SELECT concept_id, CAST(row_number() OVER (ORDER BY concept_id) AS INTEGER) AS rank FROM concept) d WHERE d.rank <= 10""")


_FR = "SELECT concept_id, concept_synonym_name AS t FROM concept_synonym WHERE language_concept_id = 4180190"
_EN = "SELECT concept_id, concept_synonym_name AS t FROM concept_synonym WHERE language_concept_id = 4180186"


def search_by_language() -> str:
    ctes = _index_ctes()
    ctes["q"] = f"""
SELECT f.concept_id AS query_id, e.t AS text_en, f.t AS text_fr FROM ({_FR}) f JOIN ({_EN}) e USING (concept_id)
JOIN concept c USING (concept_id) WHERE e.t <> c.concept_name"""
    parts = []
    for g, col, lang in (("en", "text_en", "en"), ("fr", "text_fr", "fr"), ("fr_en", "text_fr", "fr_en")):
        rows = ot.token_rows_sql("(SELECT * FROM q) qq", "query_id", col, lang)
        parts.append(f"SELECT query_id, '{g}' AS grp, token, count(*) AS qtf FROM ({rows}) t_{g} GROUP BY query_id, token")
    ctes["qt"] = "\nUNION ALL\n".join(parts)
    ctes["hits"] = """
SELECT qt.query_id, ix.concept_id, qt.grp, qt.token, max(ix.bm25) * any_value(qt.qtf) AS ts
FROM qt JOIN ix ON ix.grp = qt.grp AND ix.token = qt.token GROUP BY qt.query_id, ix.concept_id, qt.grp, qt.token"""
    ctes["scored"] = "SELECT query_id, concept_id, sum(ts) AS score FROM hits GROUP BY query_id, concept_id"
    return with_views("""
SELECT query_id, rank, concept_id, round(score, 6) AS score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, concept_id) AS INTEGER) AS rank
  FROM scored) r WHERE rank <= 10""", ctes)


def translate_labels() -> str:
    pattern = r"'[\p{L}\p{N}]+|[^\s\p{L}\p{N}]'"
    reduced = "CASE WHEN length(tok) > 4 THEN regexp_replace(regexp_replace(tok, 's$', ''), 'ée?s?$', 'er') ELSE tok END"
    ctes = {
        "fr_tok": f"""SELECT concept_id, t, i, toks[i] AS tok FROM (SELECT *, unnest(range(1, len(toks) + 1)) AS i FROM (
                        SELECT concept_id, t, regexp_extract_all(t, {pattern}) AS toks FROM ({_FR}) f) a) b""",
        "fr_red": f"SELECT concept_id, t, i, {reduced} AS red FROM fr_tok",
        "en_tok": rf"SELECT concept_id, unnest(regexp_extract_all(t, '[\p{{L}}\p{{N}}]+')) AS lemma FROM ({_EN}) e",
        "fr_word": r"SELECT DISTINCT concept_id, t, lower(red) AS word FROM fr_red WHERE regexp_matches(red, '[\p{L}\p{N}]')",
        "counted": "SELECT word, lower(lemma) AS lemma, count(*) AS n FROM fr_word JOIN en_tok USING (concept_id) GROUP BY ALL",
        "best": """SELECT word, lemma FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, lemma) AS rn
                   FROM counted) x WHERE rn = 1""",
    }
    return with_views("""
SELECT concept_id, string_agg(' ' || coalesce(b.lemma, r.red), '' ORDER BY r.i) AS concept_synonym_name,
       CAST(4180186 AS BIGINT) AS language_concept_id
FROM fr_red r LEFT JOIN best b ON lower(r.red) = b.word GROUP BY concept_id""", ctes)


def twins() -> dict[str, str]:
    return {
        "csv_round_trip": PART_TEXT,
        "text_round_trip": "SELECT p_name AS value FROM part",
        "table_copy": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
        "bulk_append": """SELECT 'c' AS kind, c_custkey AS k, c_nationkey AS nation FROM customer
                          UNION ALL SELECT 's', s_suppkey, s_nationkey FROM supplier""",
        "project_csv": project_csv(),
        "import_control_report": import_control_report(),
        "tab_pairs": ol.synonym_groups(),
        "code_list_csv": ol.code_list_concepts(),
        "vocabulary_snapshot": vocabulary_snapshot(),
        "align_schema": "SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS p_note, CAST(p_size AS BIGINT) AS p_size FROM part",
        "synonym_rules": synonym_rules(),
        "tokens_lower": "SELECT p_partkey, lower(p_type) AS value FROM part",
        "tokens_whitespace": tokens_whitespace(),
        "tokens_reversed": tokens_reversed(),
        "tokens_delimiter": tokens_delimiter(),
        "tokens_payload": tokens_payload(),
        "match_all": match_all(),
        "search_by_language": search_by_language(),
        "translate_labels": translate_labels(),
    }
