"""DuckDB twins of the text chains (same fixed patterns and lists as functions/text.py)."""

from __future__ import annotations

from ..functions import text as tx
from .fixture_sql import with_views


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(words) -> str:
    return "(" + ", ".join(lit(w) for w in words) + ")"


def normalize(expr: str, lang: str) -> str:
    e = f"lower({expr})"
    if lang == "en":
        e = f"regexp_replace({e}, {lit(tx.APOSTROPHES + 's([^\\p{L}\\p{N}]|$)')}, '\\1', 'g')"
    if lang in ("fr", "fr_en"):
        alt = "|".join(tx.ELISION_FR)
        e = f"regexp_replace({e}, {lit('(^|[^\\p{L}\\p{N}])(' + alt + ')' + tx.APOSTROPHES)}, '\\1', 'g')"
    e = f"regexp_replace({e}, {lit(tx.ASCII_PUNCT)}, ' ', 'g')"
    if lang in ("fr", "fr_en"):
        e = f"translate({e}, {lit(tx.FOLD_FROM)}, {lit(tx.FOLD_TO)})"
        for k, v in tx.LIGATURES.items():
            e = f"replace({e}, {lit(k)}, {lit(v)})"
    return e


def words(expr: str) -> str:
    return f"regexp_extract_all({expr}, {lit(tx.WORD)})"


def stem_en(t: str) -> str:
    return (f"CASE WHEN length({t}) <= 3 THEN {t} "
            f"WHEN regexp_matches({t}, '[^ae]ies$') THEN regexp_replace({t}, 'ies$', 'y') "
            f"WHEN regexp_matches({t}, '[^aeo]es$') THEN regexp_replace({t}, 'es$', 'e') "
            f"WHEN regexp_matches({t}, '[^us]s$') THEN regexp_replace({t}, 's$', '') "
            f"ELSE {t} END")


def stem_fr_steps() -> list[str]:
    """Three successive rewrites of column ``t`` (each step reads the previous one)."""
    return [
        "CASE WHEN length(t) > 5 AND suffix(t, 'aux') THEN regexp_replace(t, 'aux$', 'al') ELSE t END",
        "CASE WHEN length(t) > 3 AND regexp_matches(t, '[sx]$') THEN regexp_replace(t, '[sx]$', '') ELSE t END",
        "CASE WHEN length(t) > 3 AND suffix(t, 'e') THEN regexp_replace(t, 'e$', '') ELSE t END",
    ]


def token_rows_sql(source: str, id_col: str, text_col: str, lang: str, stem: bool = True) -> str:
    """SELECT id, pos, token over ``source`` (a table or subquery with alias)."""
    stop = tx.stop_list(lang)
    inner = f"""
SELECT {id_col}, CAST(unnest(range(len(toks))) AS INTEGER) AS pos, unnest(toks) AS t
FROM (SELECT {id_col}, {words(normalize(text_col, lang))} AS toks FROM {source}) d"""
    q = f"SELECT {id_col}, pos, t FROM ({inner}) r"
    if stop:
        q += f" WHERE t NOT IN {sql_list(stop)}"
    if stem and lang == "en":
        q = f"SELECT {id_col}, pos, {stem_en('t')} AS t FROM ({q}) s"
    elif stem and lang in ("fr", "fr_en"):
        for i, step in enumerate(stem_fr_steps()):
            q = f"SELECT {id_col}, pos, {step} AS t FROM ({q}) s{i}"
    return f"SELECT {id_col}, pos, t AS token FROM ({q}) fin"


def tokens(lang: str) -> str:
    src = f"(SELECT doc_id, text FROM documents WHERE lang = {lit(lang)}) docs"
    return with_views(token_rows_sql(src, "doc_id", "text", lang))


def path_hierarchy() -> str:
    return with_views(r"""
SELECT page_id, CAST(level AS INTEGER) AS level, prefix FROM (
  SELECT page_id, unnest(range(1, len(parts) + 1)) AS level,
         unnest(list_transform(range(1, len(parts) + 1), lambda i: '/' || array_to_string(parts[1:i], '/'))) AS prefix
  FROM (SELECT page_id,
               list_filter(string_split(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'),
                           lambda x: x <> '') AS parts
        FROM pages) p) q""")
