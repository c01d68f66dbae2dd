"""DuckDB twins of the retrieval queries (index, scoring, ranking, facets)."""

from __future__ import annotations

from ..operators.search import GROUP_FIELDS, GROUP_LANG
from . import oracle_text as ot
from .fixture_sql import with_views
from .oracle_changes import _IMPORT, _RENAME
from .oracle_documents import documents_select

_SINGLE = {"concept_name_en", "concept_name_fr", "concept_name_fr_en"}


def _field_values() -> str:
    parts = []
    for fields in GROUP_FIELDS.values():
        for f in fields:
            if f in _SINGLE:
                parts.append(f"SELECT concept_id, '{f}' AS field, 0 AS value_idx, {f} AS value FROM docs "
                             f"WHERE {f} IS NOT NULL")
            else:
                parts.append(f"SELECT concept_id, '{f}' AS field, CAST(unnest(range(len(l))) AS INTEGER) AS value_idx, "
                             f"unnest(l) AS value FROM (SELECT concept_id, string_split({f}, '|') AS l FROM docs "
                             f"WHERE {f} IS NOT NULL) x")
    return "\nUNION ALL\n".join(parts)


def _postings() -> str:
    parts = []
    for g, fields in GROUP_FIELDS.items():
        flist = ", ".join(f"'{f}'" for f in fields)
        src = f"(SELECT * FROM fv WHERE field IN ({flist})) s_{g}"
        rows = ot.token_rows_sql(src, "concept_id, field, value_idx", "value", GROUP_LANG[g])
        parts.append(f"SELECT '{g}' AS grp, concept_id, field, value_idx, pos, token FROM ({rows}) t_{g}")
    return "\nUNION ALL\n".join(parts)


def _index_ctes() -> dict[str, str]:
    return {
        "docs": documents_select(),
        "fv": _field_values(),
        "tp": _postings(),
        "tf": "SELECT concept_id, grp, field, token, count(*) AS tf FROM tp GROUP BY concept_id, grp, field, token",
        "dl": "SELECT concept_id, field, sum(tf) AS dl FROM tf GROUP BY concept_id, field",
        "dfq": "SELECT field, token, count(*) AS df FROM tf GROUP BY field, token",
        "fs": "SELECT field, count(*) AS n_docs, sum(dl) AS sum_dl FROM dl GROUP BY field",
        "ix": """
SELECT tf.grp, tf.field, tf.token, tf.concept_id, tf.tf, dl.dl, dfq.df, fs.n_docs,
       fs.sum_dl / fs.n_docs AS avgdl,
       ln(1 + (fs.n_docs - dfq.df + 0.5) / (dfq.df + 0.5)) * tf.tf
         / (tf.tf + 1.2 * (1 - 0.75 + 0.75 * dl.dl / (fs.sum_dl / fs.n_docs))) AS bm25
FROM tf JOIN dl ON dl.concept_id = tf.concept_id AND dl.field = tf.field
JOIN dfq ON dfq.field = tf.field AND dfq.token = tf.token
JOIN fs ON fs.field = tf.field""",
    }


def _weight_sql(weights: dict[str, float]) -> str:
    if not weights:
        return "1.0"
    base = "regexp_replace(ix.field, '_(en|fr|fr_en)$', '')"
    cases = " ".join(f"WHEN {base} = '{b}' THEN {float(w)}" for b, w in weights.items())
    return f"CASE {cases} ELSE 1.0 END"


def _query_ctes(weights: dict[str, float], boost: str | None, doc_filter: str | None,
                labels: str | None = None) -> dict[str, str]:
    ctes = dict(_IMPORT)
    ctes.update(_index_ctes())
    ctes["q"] = labels or "SELECT src_order AS query_id, concept_name AS text, m_value_as_number AS qv FROM good"
    ctes["qtexts"] = "SELECT DISTINCT text FROM q"
    qparts = []
    for g in GROUP_FIELDS:
        rows = ot.token_rows_sql("(SELECT text FROM qtexts) qq", "text", "text", GROUP_LANG[g])
        qparts.append(f"SELECT text, '{g}' AS grp, token FROM ({rows}) q_{g}")
    ctes["qtok"] = "\nUNION ALL\n".join(qparts)
    ctes["qt"] = "SELECT text, grp, token, count(*) AS qtf FROM qtok GROUP BY text, grp, token"
    ctes["hits"] = f"""
SELECT qt.text, ix.concept_id, qt.grp, qt.token, max(ix.bm25 * {_weight_sql(weights)}) * any_value(qt.qtf) AS ts
FROM qt JOIN ix ON ix.grp = qt.grp AND ix.token = qt.token
GROUP BY qt.text, ix.concept_id, qt.grp, qt.token"""
    ctes["tscore"] = "SELECT text, concept_id, sum(ts) AS score FROM hits GROUP BY text, concept_id"
    vb = "(1 - abs(COALESCE(d.value_avg, 0) - q.qv))"
    fb = "pow(COALESCE(CAST(d.frequency AS DOUBLE), 0) - q.qv, 2)"
    factor = {None: "1", "value": vb, "frequency": fb, "numerics": f"({vb} + {fb})"}[boost]
    where = f"WHERE {doc_filter}" if doc_filter else ""
    if boost is None and doc_filter is None:
        ctes["scored"] = "SELECT q.query_id, t.concept_id, t.score FROM q JOIN tscore t ON t.text = q.text"
    else:
        ctes["scored"] = f"""
SELECT q.query_id, t.concept_id, t.score * {factor} AS score
FROM q JOIN tscore t ON t.text = q.text JOIN docs d ON d.concept_id = t.concept_id {where}"""
    ctes["qranked"] = """
SELECT query_id, concept_id, score,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, concept_id) AS INTEGER) AS rank
FROM scored"""
    return ctes


def search(weights=None, boost=None, doc_filter=None, k=10, page=1) -> str:
    lo, hi = (page - 1) * k + 1, page * k
    return with_views(f"""
SELECT query_id, rank, concept_id, round(score, 6) AS score FROM qranked WHERE rank BETWEEN {lo} AND {hi}""",
                      _query_ctes(weights or {}, boost, doc_filter))


def postings() -> str:
    ctes = _index_ctes()
    return with_views("SELECT concept_id, field, token, tf, dl, df, round(bm25, 9) AS bm25 FROM ix", ctes)


def search_label_filters() -> str:
    named = "d.concept_id IN (SELECT concept_id FROM tp WHERE field = 'concept_name_en' AND token IN ('plate', 'blue'))"
    return search(doc_filter=f"""CASE q.query_id % 4
  WHEN 0 THEN true
  WHEN 1 THEN d.standard_concept IN ('OMOP S', 'ASIA EMPTY') AND d.invalid_reason IS DISTINCT FROM 'OMOP D'
  WHEN 2 THEN coalesce(d.frequency BETWEEN 2 AND 3, false) OR coalesce(d.value_avg >= 30, false)
  ELSE {named} AND (d.is_mapped IS DISTINCT FROM 'ASIA S' OR NOT coalesce(d.frequency <= 1, false)) END""")


def index_refresh() -> str:
    """The postings of an index built anew over the renamed concepts."""
    ctes = dict(_RENAME)
    ctes.update(_index_ctes())
    ctes["docs"] = documents_select(concept="concept_v2")
    return with_views("SELECT concept_id, field, token, tf, dl, df, round(bm25, 9) AS bm25 FROM ix", ctes)


def hit_counts() -> str:
    return with_views("SELECT query_id, count(*) AS num_found FROM scored GROUP BY query_id",
                      _query_ctes({}, None, None))


def facets(fields=("standard_concept", "is_mapped"), n=10) -> str:
    ctes = _query_ctes({}, None, None)
    ctes["fvals"] = "\nUNION ALL\n".join(
        f"SELECT concept_id, '{f}' AS field, CAST({f} AS VARCHAR) AS value FROM docs WHERE {f} IS NOT NULL"
        for f in fields)
    ctes["fcount"] = """
SELECT s.query_id, v.field, v.value, count(*) AS count FROM scored s JOIN fvals v ON v.concept_id = s.concept_id
GROUP BY s.query_id, v.field, v.value"""
    return with_views(f"""
SELECT query_id, field, value, count FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, field ORDER BY count DESC, value) AS r FROM fcount
  WHERE count >= 1) x WHERE r <= {n}""", ctes)


_PHRASE_LABELS = """
SELECT s.concept_id AS query_id, s.concept_synonym_name AS text, CAST(NULL AS DOUBLE) AS qv
FROM concept_synonym s JOIN concept c ON c.concept_id = s.concept_id
WHERE s.language_concept_id = 4180186 AND s.concept_synonym_name <> c.concept_name"""


def search_phrase(weights=None, pweights=None, slop=2, k=10) -> str:
    pweights = pweights or {"concept_name": 6.0, "concept_synonym_name": 3.0, "concept_mapped_name": 3.0}
    ctes = _query_ctes(weights or {}, None, None, labels=_PHRASE_LABELS)
    qparts = []
    for g in GROUP_FIELDS:
        rows = ot.token_rows_sql("(SELECT text FROM qtexts) qq", "text", "text", GROUP_LANG[g])
        qparts.append(f"SELECT text, '{g}' AS grp, pos, token FROM ({rows}) qp_{g}")
    ctes["qpos"] = "\nUNION ALL\n".join(qparts)
    ctes["qsh"] = """
SELECT * FROM (
  SELECT text, grp, row_number() OVER w AS sh, token AS t0, lead(token, 1) OVER w AS t1, lead(token, 2) OVER w AS t2
  FROM qpos WINDOW w AS (PARTITION BY text, grp ORDER BY pos)) x WHERE t2 IS NOT NULL"""
    ctes["pm"] = f"""
SELECT q.text, q.grp, q.sh, a.concept_id, a.field, q.t0, q.t1, q.t2,
       greatest(a.pos, b.pos - 1, c.pos - 2) - least(a.pos, b.pos - 1, c.pos - 2) AS len
FROM qsh q
JOIN tp a ON a.grp = q.grp AND a.token = q.t0
JOIN tp b ON b.grp = q.grp AND b.token = q.t1 AND b.concept_id = a.concept_id AND b.field = a.field
         AND b.value_idx = a.value_idx
JOIN tp c ON c.grp = q.grp AND c.token = q.t2 AND c.concept_id = a.concept_id AND c.field = a.field
         AND c.value_idx = a.value_idx
WHERE greatest(a.pos, b.pos - 1, c.pos - 2) - least(a.pos, b.pos - 1, c.pos - 2) <= {slop}
  AND a.pos <> b.pos AND a.pos <> c.pos AND b.pos <> c.pos"""
    ctes["pf"] = """
SELECT text, grp, sh, concept_id, field, sum(CAST(1 AS DOUBLE) / (1 + len)) AS freq,
       any_value(t0) AS t0, any_value(t1) AS t1, any_value(t2) AS t2
FROM pm GROUP BY text, grp, sh, concept_id, field"""
    base = "regexp_replace(pf.field, '_(en|fr|fr_en)$', '')"
    wcase = "CASE " + " ".join(f"WHEN {base} = '{b}' THEN {float(w)}" for b, w in pweights.items()) + " ELSE 1.0 END"
    idf = "ln(1 + (fs.n_docs - {d}.df + 0.5) / ({d}.df + 0.5))"
    ctes["pscore_sh"] = f"""
SELECT pf.text, pf.grp, pf.sh, pf.concept_id,
       max({wcase} * ({idf.format(d='d0')} + {idf.format(d='d1')} + {idf.format(d='d2')}) * pf.freq
           / (pf.freq + 1.2 * (1 - 0.75 + 0.75 * dl.dl / (fs.sum_dl / fs.n_docs)))) AS ps
FROM pf JOIN dl ON dl.concept_id = pf.concept_id AND dl.field = pf.field
JOIN fs ON fs.field = pf.field
JOIN dfq d0 ON d0.field = pf.field AND d0.token = pf.t0
JOIN dfq d1 ON d1.field = pf.field AND d1.token = pf.t1
JOIN dfq d2 ON d2.field = pf.field AND d2.token = pf.t2
GROUP BY pf.text, pf.grp, pf.sh, pf.concept_id"""
    ctes["pscore"] = "SELECT text, concept_id, sum(ps) AS pscore FROM pscore_sh GROUP BY text, concept_id"
    ctes["scored"] = """
SELECT q.query_id, t.concept_id, t.score + COALESCE(p.pscore, 0) AS score
FROM q JOIN tscore t ON t.text = q.text LEFT JOIN pscore p ON p.text = t.text AND p.concept_id = t.concept_id"""
    order = [n for n in ctes if n not in ("scored", "qranked")] + ["scored", "qranked"]
    ctes = {name: ctes[name] for name in order}
    return with_views(f"""
SELECT query_id, rank, concept_id, round(score, 6) AS score FROM qranked WHERE rank BETWEEN 1 AND {k}""", ctes)


def highlight(k=10, snippets=10) -> str:
    ctes = _query_ctes({}, None, None)
    grp_case = "CASE " + " ".join(
        "WHEN field IN (" + ", ".join(f"'{f}'" for f in fields) + f") THEN '{g}'"
        for g, fields in GROUP_FIELDS.items()) + " END"
    ctes["top"] = f"SELECT query_id, rank, concept_id FROM qranked WHERE rank BETWEEN 1 AND {k}"
    ctes["hitq"] = "SELECT t.query_id, t.rank, t.concept_id, q.text FROM top t JOIN q ON q.query_id = t.query_id"
    ctes["runs"] = f"""
SELECT concept_id, field, value_idx, grp, CAST(unnest(range(len(r))) AS INTEGER) AS rpos, unnest(r) AS run
FROM (SELECT concept_id, field, value_idx, {grp_case} AS grp,
             regexp_extract_all(value, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+') AS r
      FROM fv WHERE concept_id IN (SELECT concept_id FROM top)) x"""
    parts = []
    for g in GROUP_FIELDS:
        rows = ot.token_rows_sql(f"(SELECT * FROM runs WHERE grp = '{g}') r_{g}",
                                 "concept_id, field, value_idx, rpos", "run", GROUP_LANG[g])
        parts.append(f"SELECT concept_id, field, value_idx, rpos, token FROM ({rows}) a_{g}")
    ctes["an"] = "\nUNION ALL\n".join(parts)
    ctes["qts"] = "SELECT DISTINCT text, grp, token FROM qtok"
    ctes["hl_tagged"] = """
SELECT h.query_id, h.rank, h.concept_id, r.field, r.value_idx, r.rpos, r.run, (m.token IS NOT NULL) AS hitw
FROM hitq h JOIN runs r ON r.concept_id = h.concept_id
LEFT JOIN an a ON a.concept_id = r.concept_id AND a.field = r.field AND a.value_idx = r.value_idx AND a.rpos = r.rpos
LEFT JOIN qts m ON m.text = h.text AND m.grp = r.grp AND m.token = a.token"""
    ctes["pv"] = """
SELECT query_id, rank, concept_id, field, value_idx,
       string_agg(CASE WHEN hitw THEN '<em>' || run || '</em>' ELSE run END, '' ORDER BY rpos) AS snippet,
       count(*) FILTER (WHERE hitw) AS hits
FROM hl_tagged GROUP BY query_id, rank, concept_id, field, value_idx"""
    return with_views(f"""
SELECT query_id, rank, concept_id, field, snippet FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, concept_id, field ORDER BY hits DESC, value_idx) AS n FROM pv WHERE hits > 0) x
WHERE n <= {snippets}""", ctes)


def _expand_sql(labels: str, lang: str, members: str | None = None, rewrites: str | None = None) -> dict[str, str]:
    """CTEs: labels (query_id, text); members (group_key, member); rewrites (term,
    replacement) -> exp (query_id, token)."""
    c = {"lbl": labels}
    parts = []
    if members:
        c["gm"] = f"SELECT row_number() OVER () AS mid, * FROM ({members}) m0"
        m_rows = ot.token_rows_sql("(SELECT mid, member FROM gm) a", "mid", "member", lang)
        c["gmt"] = f"SELECT mid, list(token ORDER BY pos) AS tt FROM ({m_rows}) x GROUP BY mid"
        c["gtok"] = "SELECT DISTINCT gm.group_key, unnest(gmt.tt) AS token FROM gm JOIN gmt USING (mid)"
        parts.append("""SELECT DISTINCT array_to_string(gmt.tt, ' ') AS term_key, len(gmt.tt) AS n, gm.group_key,
                               CAST(NULL AS VARCHAR[]) AS repl FROM gm JOIN gmt USING (mid)""")
    if rewrites:
        c["rr"] = f"SELECT row_number() OVER () AS rid, * FROM ({rewrites}) r0"
        t_rows = ot.token_rows_sql("(SELECT rid, term FROM rr) a", "rid", "term", lang)
        r_rows = ot.token_rows_sql("(SELECT rid, replacement FROM rr) b", "rid", "replacement", lang)
        c["rt"] = f"SELECT rid, list(token ORDER BY pos) AS tt FROM ({t_rows}) x GROUP BY rid"
        c["rp"] = f"SELECT rid, list(token ORDER BY pos) AS repl FROM ({r_rows}) y GROUP BY rid"
        parts.append("""SELECT array_to_string(rt.tt, ' ') AS term_key, len(rt.tt) AS n, CAST(NULL AS VARCHAR) AS group_key,
                               COALESCE(rp.repl, CAST([] AS VARCHAR[])) AS repl
                        FROM rr JOIN rt USING (rid) LEFT JOIN rp USING (rid)""")
    c["ar"] = "\nUNION ALL\n".join(parts)
    q_rows = ot.token_rows_sql("(SELECT query_id, text FROM lbl WHERE text IS NOT NULL) l", "query_id", "text", lang)
    c["qseq"] = f"SELECT query_id, list(token ORDER BY pos) AS toks FROM ({q_rows}) z GROUP BY query_id"
    c["grams"] = """
SELECT q.query_id, u.i AS start, t.n, array_to_string(q.toks[u.i:u.i + t.n - 1], ' ') AS term_key
FROM qseq q, LATERAL range(1, least((SELECT max(n) FROM ar), len(q.toks)) + 1) AS t(n),
     LATERAL range(1, len(q.toks) - t.n + 2) AS u(i)"""
    c["hit"] = """SELECT g.query_id, g.start, g.n, ar.repl, ar.group_key FROM grams g JOIN ar ON ar.term_key = g.term_key"""
    extra = "SELECT query_id, unnest(repl) AS token FROM hit WHERE repl IS NOT NULL"
    if members:
        extra += """ UNION ALL SELECT h.query_id, gt.token FROM (SELECT DISTINCT query_id, group_key FROM hit
                     WHERE group_key IS NOT NULL) h JOIN gtok gt ON gt.group_key = h.group_key"""
    c["extra"] = extra
    c["replaced"] = "SELECT DISTINCT query_id, unnest(range(start, start + n)) AS idx FROM hit WHERE repl IS NOT NULL"
    c["orig"] = "SELECT query_id, unnest(range(1, len(toks) + 1)) AS idx, unnest(toks) AS token FROM qseq"
    c["exp"] = """
SELECT DISTINCT query_id, token FROM (
  SELECT o.query_id, o.token FROM orig o
  WHERE NOT EXISTS (SELECT 1 FROM replaced r WHERE r.query_id = o.query_id AND r.idx = o.idx)
  UNION ALL SELECT query_id, token FROM extra) e"""
    return c


def synonym_expand() -> str:
    ctes = dict(_IMPORT)
    ctes.update(_expand_sql(
        "SELECT src_order AS query_id, concept_name AS text FROM good", "en",
        members="""SELECT DISTINCT p_type AS group_key, p_name AS member FROM part
                   WHERE p_type IN (SELECT p_type FROM part GROUP BY p_type HAVING count(*) > 1)"""))
    return with_views("SELECT query_id, token FROM exp", ctes)


def crosslingual_expand() -> str:
    fr = "SELECT concept_id, concept_synonym_name FROM concept_synonym WHERE language_concept_id = 4180190"
    en = """SELECT s.concept_id, s.concept_synonym_name FROM concept_synonym s JOIN concept c ON c.concept_id = s.concept_id
            WHERE s.language_concept_id = 4180186 AND s.concept_synonym_name <> c.concept_name"""
    ctes = _expand_sql(
        f"SELECT concept_id AS query_id, concept_synonym_name AS text FROM ({fr}) f", "fr_en",
        rewrites=f"""SELECT f.concept_synonym_name AS term, e.concept_synonym_name AS replacement
                     FROM ({fr}) f JOIN ({en}) e ON e.concept_id = f.concept_id""")
    return with_views("SELECT query_id, token FROM exp", ctes)


def search_expanded(k=10) -> str:
    ctes = dict(_IMPORT)
    ctes.update(_index_ctes())
    ex = _expand_sql(
        "SELECT text AS query_id, text FROM (SELECT DISTINCT concept_name AS text FROM good) d", "en",
        members="""SELECT DISTINCT p_type AS group_key, p_name AS member FROM part
                   WHERE p_type IN (SELECT p_type FROM part GROUP BY p_type HAVING count(*) > 1)""")
    ctes.update(ex)
    ctes["xhits"] = """
SELECT e.query_id AS text, ix.concept_id, e.token, max(ix.bm25) AS ts
FROM exp e JOIN ix ON ix.grp = 'en' AND ix.token = e.token
GROUP BY e.query_id, ix.concept_id, e.token"""
    ctes["xscore"] = "SELECT text, concept_id, sum(ts) AS score FROM xhits GROUP BY text, concept_id"
    ctes["xranked"] = """
SELECT text, concept_id, score,
       CAST(row_number() OVER (PARTITION BY text ORDER BY round(score, 6) DESC, concept_id) AS INTEGER) AS rank
FROM xscore"""
    return with_views(f"""
SELECT g.src_order AS query_id, r.rank, r.concept_id, round(r.score, 6) AS score
FROM good g JOIN xranked r ON r.text = g.concept_name WHERE r.rank BETWEEN 1 AND {k}""", ctes)
