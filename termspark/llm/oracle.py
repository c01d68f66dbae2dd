"""DuckDB twins of the operator queries that SQL can express."""

_SPACE = r"\x20\x09-\x0D"

CHAT = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id),
d AS (SELECT conv_id, [length(x.role) || ':' || x.role || x.text FOR x IN turns] AS parts,
             ['<|' || x.role || '|>' || chr(10) || x.text || chr(10) || '<|end|>' || chr(10) FOR x IN turns] AS shown FROM c),
w AS (SELECT parts, min(conv_id) AS conv_id, count(*) AS snapshots FROM d GROUP BY parts),
p AS (SELECT DISTINCT parts[1:k] AS parts FROM (SELECT parts, unnest(range(1, len(parts))) AS k FROM w))
SELECT w.conv_id, len(w.parts)::BIGINT AS n_turns, w.snapshots, array_to_string(d.shown, '') AS text
FROM w JOIN d USING (conv_id) WHERE w.parts NOT IN (SELECT parts FROM p)
"""

SHA256 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM d JOIN g USING (text)
"""

_RATES = {"word_chars": (3, 0, True), "n_symbols": (16, 2, False), "n_dup_lines": (16, 2, False), "n_repeat_words": (32, 12, False)}


def _quality() -> str:
    rates = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, ({m} * 10000) // greatest(n_words, 1) AS x FROM b WHERE NOT base_failed" for m in _RATES)

    def level(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""{name} AS (SELECT {by}measure, max(docs) AS docs, min(CASE WHEN 100 * upto >= 10 * docs THEN top END) AS lo,
  min(CASE WHEN 100 * upto >= 90 * docs THEN top END) AS hi FROM (
    SELECT {by}measure, top, sum(n) OVER (PARTITION BY {by}measure ORDER BY top) AS upto, sum(n) OVER (PARTITION BY {by}measure) AS docs
    FROM (SELECT {by}measure, top, sum(n) AS n FROM s GROUP BY {by}measure, top)) GROUP BY {by}measure)"""

    halves = "CASE p.measure " + " ".join(f"WHEN '{m}' THEN {k}" for m, (k, *_) in _RATES.items()) + " END"

    def tongue(c: str) -> str:
        return f"(CASE WHEN l2.docs >= 100 THEN l2.{c} ELSE t.{c} END)"

    def own(c: str) -> str:
        return f"(CASE WHEN p.docs >= 100 THEN p.{c} ELSE {tongue(c)} END)"

    tests = []
    for m, (_, stray, both) in _RATES.items():
        x = f"(({m} * 10000) // greatest(n_words, 1))"
        tests.append(f"(4 * {x} <= hi_{m} OR {m} <= {stray})" + (f" AND 3 * {x} >= 2 * lo_{m}" if both else ""))
    wide = ", ".join(f"max(CASE WHEN measure = '{m}' THEN {c} END) AS {c}_{m}" for m in _RATES for c in ("lo", "hi"))
    return f"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') AS w FROM documents),
i AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w),
g AS (SELECT doc_id, i, w[i:i + 2] AS g FROM i),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^{_SPACE}]')] AS l FROM w),
m AS (SELECT w.doc_id, w.lang, w.source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
   (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
   FROM w JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
e AS ({rates}),
s AS (SELECT lang, source, measure, (((x >> k) + 1) << k) - 1 AS top, count(*) AS n
      FROM (SELECT *, greatest(length(bin(x)) - 4, 0) AS k FROM e) GROUP BY 1, 2, 3, 4),
{level('p', 'lang, source')}, {level('l2', 'lang')}, {level('t', '')},
q AS (SELECT p.lang, p.source, p.measure, least({own('lo')}, {tongue('lo')}) AS lo,
        least(greatest(2 * {own('hi')}, {tongue('hi')}), 4 * {tongue('hi')}) * {halves} AS hi
      FROM p JOIN l2 ON p.lang IS NOT DISTINCT FROM l2.lang AND p.measure = l2.measure JOIN t ON p.measure = t.measure),
z AS (SELECT lang, source, {wide} FROM q GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({' AND '.join(tests)}, true) AS kept
FROM b LEFT JOIN z ON b.lang IS NOT DISTINCT FROM z.lang AND b.source IS NOT DISTINCT FROM z.source
"""


NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS same, list_dot_product(a.q, v.q)::BIGINT AS score
      FROM v AS a JOIN v ON a.vec_id % 50 = 0 AND v.vec_id <> a.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 3
"""

ORACLE = {"op2_exact_dedup": SHA256, "op3_chat_format": CHAT, "op9_quality_rules": _quality(), "op11_hard_negatives": NEGATIVES}
