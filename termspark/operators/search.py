"""Concept retrieval as a batch job: a table of labels matched against concept documents.

Index side (SR1): documents -> one row per (concept, field, token) with its BM25
weight.  Query side: labels are analysed with the chain of each field group,
joined to the index on (group, token), scored per field (x field weight), the
best field per term is kept (dismax, tie 0), terms and groups are summed, an
optional boost multiplies, an optional filter restricts the documents, and the
top k per label are kept with a window ``row_number() <= k`` (planned as a
per-partition group limit before the shuffle).

No candidate cap: rankings by text alone read only the postings that can still reach
rank k (``topk``: exact score bounds); boosted rankings, counts and facets score every
document that shares a token.  Identical label texts are scored once and joined back.
BM25 (k1 1.2, b 0.75): idf = ln(1 + (N - df + 0.5)/(df + 0.5)),
weight = idf * tf / (tf + k1 * (1 - b + b * dl / avgdl)), N and avgdl per field.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import text as tx
from ..functions.plan_tools import analysis_partitions, cut_lineage
from . import topk

K1 = 1.2
B = 0.75

# Field groups of the concept documents (query alias -> fields).
GROUP_FIELDS = {
    "en": ["concept_name_en", "concept_synonym_name_en", "concept_mapped_name_en"],
    "fr": ["concept_name_fr", "concept_synonym_name_fr", "concept_mapped_name_fr"],
    "fr_en": ["concept_name_fr_en", "concept_synonym_name_fr_en", "concept_mapped_name_fr_en"],
}
# analysis chain of each group (fr_en indexes with the French chain)
GROUP_LANG = {"en": "en", "fr": "fr", "fr_en": "fr_en"}

# Per-field weights of the ranking set-ups.
WEIGHTS_FLAT: dict[str, float] = {}
WEIGHTS_NAME2 = {"concept_name": 2.0, "concept_synonym_name": 1.0, "concept_mapped_name": 1.0}

WEIGHTS_5_3 = {"concept_name": 5.0, "concept_synonym_name": 3.0}

SCORE_DIGITS = topk.DIGITS


def field_group(field: str) -> str:
    for g, fields in GROUP_FIELDS.items():
        if field in fields:
            return g
    raise KeyError(field)


def field_base(field: str) -> str:
    """'concept_synonym_name_fr_en' -> 'concept_synonym_name'."""
    for suffix in ("_fr_en", "_en", "_fr"):
        if field.endswith(suffix):
            return field[: -len(suffix)]
    return field


# ------------------------------------------------------------------ index
def field_values(docs: DataFrame, fields: Iterable[str]) -> DataFrame:
    """(concept_id, field, value_idx, value): one row per value of each field."""
    parts = []
    for f in fields:
        is_array = isinstance(docs.schema[f].dataType, ArrayType)
        vals = F.col(f) if is_array else F.array(F.col(f))
        parts.append(F.struct(F.lit(f).alias("field"), vals.alias("vals")))
    fv = docs.select("concept_id", F.explode(F.array(*parts)).alias("fv"))
    fv = fv.select("concept_id", F.col("fv.field").alias("field"),
                   F.posexplode(F.col("fv.vals")).alias("value_idx", "value"))
    return fv.filter(F.col("value").isNotNull())


def token_postings(docs: DataFrame, groups: Iterable[str] = tuple(GROUP_FIELDS),
                   protected: Iterable[str] = ()) -> DataFrame:
    """(concept_id, group, field, value_idx, pos, token): positional postings,
    every field analysed in one pass with its group's chain."""
    groups = list(groups)
    fields = [f for g in groups for f in GROUP_FIELDS[g]]
    fv = field_values(docs, fields)
    grp = None
    for g in groups:
        cond = F.col("field").isin(GROUP_FIELDS[g])
        grp = F.when(cond, F.lit(g)) if grp is None else grp.when(cond, F.lit(g))
    # a real shuffle (not merged by AQE) so the regex work runs on every core;
    # the term-frequency aggregate downstream reuses this partitioning
    fv = fv.withColumn("group", grp).repartition(analysis_partitions(fv), "concept_id", "field")
    return tx.token_rows_by(fv, "value", "group", groups, keep=["concept_id", "field", "value_idx"],
                            protected=protected)


def token_places(docs: DataFrame, groups: Iterable[str] = tuple(GROUP_FIELDS), protected: Iterable[str] = ()) -> DataFrame:
    """(concept_id, group, field, token, places, dl): all places (value_idx, pos) of a token in
    a concept's field, in order, in one row.  Values are dealt out by (concept_id, field)
    before they are analysed; grouping and field lengths need no further shuffle."""
    rows = token_postings(docs, groups, protected)
    by_token = rows.groupBy("concept_id", "group", "field", "token").agg(
        F.array_sort(F.collect_list(F.struct("value_idx", "pos"))).alias("places"))
    return with_lengths(by_token)


def positional_postings(docs: DataFrame, groups: Iterable[str] = tuple(GROUP_FIELDS),
                        protected: Iterable[str] = ()) -> DataFrame:
    """Token places, analysed once and written once (the index and the phrase matcher
    both read them)."""
    return cut_lineage(token_places(docs, groups, protected), "positions")


def index(docs: DataFrame, groups: Iterable[str] = tuple(GROUP_FIELDS), protected: Iterable[str] = (),
          k1: float = K1, b: float = B, positions: DataFrame | None = None) -> DataFrame:
    """(group, field, token, concept_id, tf, dl, df, n_docs, avgdl, bm25).

    Term frequency and field length come with the token places, written once (they feed
    three consumers); document frequency from a (field, token) aggregate with map-side
    partial counts (a very common token does not land whole in one task); per-field
    totals are one row per field (broadcast, bounded by the field list).
    """
    tf = positions if positions is not None else positional_postings(docs, groups, protected)
    tf = tf.select("concept_id", "group", "field", "token", F.size("places").cast("long").alias("tf"), "dl")
    dfreq = cut_lineage(tf.groupBy("field", "token").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    if dfreq.count() <= topk.BROADCAST_TERMS:
        dfreq = F.broadcast(dfreq)
    fstats = (tf.groupBy("field", "concept_id").agg(F.max("dl").alias("dl"))
              .groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("dl").alias("sum_dl")))
    return with_bm25(tf, dfreq, fstats, k1, b)


def with_lengths(rows: DataFrame) -> DataFrame:
    """Token rows (``tf`` or all ``places``) with the token count of their concept's field."""
    count = F.col("tf") if "tf" in rows.columns else F.size("places").cast("long")
    return rows.withColumn("dl", F.sum(count).over(Window.partitionBy("concept_id", "field")))


def with_bm25(tf: DataFrame, dfreq: DataFrame, fstats: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """Index rows from token rows, document frequencies by (field, token) and totals by field (one row a field)."""
    j = tf.join(dfreq, ["field", "token"]).join(F.broadcast(fstats), "field")
    avgdl = F.col("sum_dl") / F.col("n_docs")
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + k1 * (1 - b + b * F.col("dl") / avgdl)
    return j.select("group", "field", "token", "concept_id", "tf", "dl", "df", "n_docs",
                    avgdl.alias("avgdl"), (idf * F.col("tf") / norm).alias("bm25"))


# ------------------------------------------------------------------ query
def query_tokens(qtexts: DataFrame, key: str, groups: Mapping[str, str], protected: Iterable[str] = (),
                 expansions: DataFrame | None = None) -> DataFrame:
    """(key, group, token, qtf) for each group whose text column is set, all
    groups analysed in one pass.

    ``expansions`` (token, extra_token) adds query-time synonyms: each matched
    token also brings its expansions (counted once per occurrence)."""
    per_group = F.array(*[F.struct(F.lit(g).alias("group"), F.col(c).alias("qtext")) for g, c in groups.items()])
    q = (qtexts.select(key, F.explode(per_group).alias("gq"))
         .select(key, F.col("gq.group").alias("group"), F.col("gq.qtext").alias("qtext"))
         .filter(F.col("qtext").isNotNull()))
    rows = tx.token_rows_by(q, "qtext", "group", list(groups), keep=[key], protected=protected)
    rows = rows.select(key, "group", "token")
    if expansions is not None:
        extra = rows.join(expansions, "token").select(key, "group", F.col("extra_token").alias("token"))
        rows = rows.unionByName(extra)
    return rows.groupBy(key, "group", "token").agg(F.count(F.lit(1)).alias("qtf"))


def text_scores(qtexts: DataFrame, key: str, idx: DataFrame, groups: Mapping[str, str],
                weights: Mapping[str, float] | None = None, protected: Iterable[str] = (),
                expansions: DataFrame | None = None) -> DataFrame:
    """(key, concept_id, score): dismax over the fields of a group, summed over
    query terms (times their count) and over groups."""
    qt = query_tokens(qtexts, key, groups, protected, expansions)
    return topk.all_scores(qt, key, topk.fold(idx, groups, weights, qt, all_hits=True))


# ------------------------------------------------------------------ boosts
def value_boost(v: Column) -> Column:
    """1 - |value_avg - v|; a document without value_avg counts as 0."""
    return 1 - F.abs(F.coalesce(F.col("value_avg"), F.lit(0.0)) - v)


def frequency_boost(f: Column) -> Column:
    """(frequency - f)^2; a document without frequency counts as 0."""
    return F.pow(F.coalesce(F.col("frequency").cast("double"), F.lit(0.0)) - f, 2)


def boost_expr(kind: str | None, v: Column, f: Column) -> Column | None:
    if kind is None:
        return None
    if kind == "value":
        return value_boost(v)
    if kind == "frequency":
        return frequency_boost(f)
    if kind == "numerics":
        return value_boost(v) + frequency_boost(f)
    raise ValueError(kind)


# ---------------------------------------------------------------- filters
def f_enum(field: str, values: Iterable) -> Column:
    return F.col(field).isin(list(values))


def f_num(field: str, lo=None, hi=None) -> Column:
    c = F.lit(True)
    if lo is not None:
        c = c & (F.col(field) >= lo)
    if hi is not None:
        c = c & (F.col(field) <= hi)
    return c


def f_text(field: str, word: str, lang: str = "en") -> Column:
    """The analysed field contains the analysed word."""
    w = tx.token_array(F.lit(word), lang)
    return F.arrays_overlap(tx.token_array(F.col(field), lang), w)


# ------------------------------------------------------------------- rank
def label_keys(queries: DataFrame, groups: Mapping[str, str], boost: str | None = None, value_col: str = "",
               frequency_col: str = "") -> tuple[DataFrame, list[str]]:
    """Each label with its scoring key ``_qk``: the texts (``_tk``) and boost inputs
    that decide its ranking.  Labels with equal keys rank identically, so each key
    is ranked once, and each distinct text is matched against the index once."""
    text_cols = sorted(set(groups.values()))
    tk = F.struct(*[F.coalesce(F.col(c), F.lit("\u0000")).alias(c) for c in text_cols])
    fields = [tk.alias("_tk")]
    if boost is not None:
        for src, name in ((value_col, "_q_v"), (frequency_col, "_q_f")):
            v = F.col(src).cast("double") if src in queries.columns else F.lit(None).cast("double")
            fields.append(F.coalesce(v, F.lit(0.0)).alias(name))  # a missing number counts as 0
    return queries.withColumn("_qk", F.struct(*fields)), text_cols


def numbered(labeled: DataFrame, text_cols: list[str], id_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scoring keys and label texts by number, so that hits carry numbers and no texts:
    labels (id, _qk), keys (_qk, _ti, boost inputs), texts (_ti, text columns)."""
    keys = cut_lineage(labeled.select(F.col("_qk").alias("_key")).distinct().withColumn("_qk", F.monotonically_increasing_id()), "keys")
    texts = cut_lineage(keys.select("_key._tk").distinct().withColumn("_ti", F.monotonically_increasing_id()), "texts")
    labels = labeled.select(id_col, F.col("_qk").alias("_key")).join(keys, "_key").select(id_col, "_qk")
    keys = keys.select("_qk", "_key.*").join(texts, "_tk").drop("_tk")
    return labels, keys, texts.select("_ti", *[F.when(F.col(f"_tk.{c}") != "\u0000", F.col(f"_tk.{c}")).alias(c) for c in text_cols])


#: a boosted ranking takes its thresholds from one concept in so many
PROBE = 32


def boosted(hits: DataFrame, keys: DataFrame, docs: DataFrame, boost: str, best: int | None = None) -> DataFrame:
    """(_qk, concept_id, score): text hits (_ti, concept_id, score) times the boost of each key.

    Documents come to the hits, which are dealt out by concept, and keys, few and counted, to
    both, so what is multiplied by the keys stays where it is.  With ``best``, the
    so-many-th score that a share of the concepts gives a key is a threshold, exact for all:
    only scores that reach it are ranked."""
    hits = hits.join(docs.select("concept_id", "value_avg", "frequency"), "concept_id")
    keys = cut_lineage(keys, "boost-keys")
    few = keys.count() <= topk.BROADCAST_TERMS

    def of(rows: DataFrame, by: DataFrame) -> DataFrame:
        score = F.col("score") * boost_expr(boost, F.col("_q_v"), F.col("_q_f"))
        return rows.join(F.broadcast(by) if few else by, "_ti").withColumn("score", score)

    if best is None:
        return of(hits, keys)
    some = of(hits.filter(F.pmod(F.xxhash64("concept_id"), F.lit(PROBE)) == 0), keys)
    nth = Window.partitionBy("_qk").orderBy(F.col("score").desc())
    floor = some.select("_qk", "score").withColumn("_n", F.row_number().over(nth)).filter(F.col("_n") == best).select("_qk", F.col("score").alias("_floor"))
    keys = cut_lineage(keys.join(floor, "_qk", "left"), "boost-floors")
    return of(hits, keys).filter(F.col("_floor").isNull() | (F.col("score") >= F.col("_floor") - topk.ROOM))


def key_scores(keys: DataFrame, texts: DataFrame, idx: DataFrame, docs: DataFrame | None, groups: Mapping[str, str],
               weights: Mapping[str, float] | None = None, boost: str | None = None,
               doc_filter: Column | None = None, protected: Iterable[str] = (),
               expansions: DataFrame | None = None, best: int | None = None) -> DataFrame:
    """(_qk, concept_id, score) for distinct scoring keys: every hit, or with ``best`` those
    that can be among so many first ones (a boosted ranking needs every hit)."""
    if docs is None and (doc_filter is not None or boost is not None):
        raise ValueError("docs are needed for filters and boosts")
    if doc_filter is not None:
        idx = idx.join(docs.filter(doc_filter).select("concept_id"), "concept_id", "left_semi")
    qt = query_tokens(texts, "_ti", groups, protected, expansions)
    bounded = best is not None and boost is None
    postings = topk.fold(idx, groups, weights, qt, all_hits=not bounded)
    if bounded:
        hits = topk.best(qt, "_ti", postings, best)
    else:
        hits = topk.all_scores(qt, "_ti", postings)
    if boost is None:
        hits = keys.join(hits, "_ti")
    else:
        hits = boosted(hits, keys, docs, boost, best)
    return hits.select("_qk", "concept_id", "score")


def scores(queries: DataFrame, idx: DataFrame, docs: DataFrame | None = None, *, id_col: str = "query_id",
           groups: Mapping[str, str] | None = None, weights: Mapping[str, float] | None = None,
           boost: str | None = None, value_col: str = "value_avg", frequency_col: str = "frequency",
           doc_filter: Column | None = None, protected: Iterable[str] = (),
           expansions: DataFrame | None = None, by_key: bool = False, best: int | None = None):
    """All hits: (query_id, concept_id, score).  With ``by_key`` returns
    (label map (query_id, _qk), hits per scoring key (_qk, concept_id, score)); with
    ``best`` only the hits that can be among so many first ones."""
    groups = dict(groups or {g: "text" for g in GROUP_FIELDS})
    labeled, text_cols = label_keys(queries, groups, boost, value_col, frequency_col)
    label_map, keys, texts = numbered(labeled, text_cols, id_col)
    hits = key_scores(keys, texts, idx, docs, groups, weights, boost, doc_filter, protected, expansions, best)
    if by_key:
        return label_map, hits
    return label_map.join(hits, "_qk").select(id_col, "concept_id", "score")


def top_k(hits: DataFrame, k: int = 10, page: int = 1, id_col: str = "query_id",
          digits: int = SCORE_DIGITS) -> DataFrame:
    """Rank by score (rounded to ``digits`` so float noise does not break ties)
    then concept id; keep ranks of page ``page`` of size ``k``."""
    # the rounded score is a column, not an order expression: a sort evaluates
    # order expressions inside every comparison, and rounding is not cheap
    w = Window.partitionBy(id_col).orderBy(F.col("_rs").desc(), F.col("concept_id"))
    lo, hi = (page - 1) * k + 1, page * k
    ranked = hits.withColumn("_rs", F.round("score", digits)).withColumn("rank", F.row_number().over(w))
    return ranked.filter((F.col("rank") >= lo) & (F.col("rank") <= hi)).drop("_rs")


def rank(queries: DataFrame, idx: DataFrame, docs: DataFrame | None = None, *, k: int = 10, page: int = 1,
         id_col: str = "query_id", fields: Iterable[str] = (), **kw) -> DataFrame:
    """Top-k concepts per label: (query_id, rank, concept_id, score [, fields]).

    Ranked once per scoring key; the k rows are then attached to every label
    with that key."""
    label_map, hits = scores(queries, idx, docs, id_col=id_col, by_key=True, best=k * page, **kw)
    out = label_map.join(top_k(hits, k, page, "_qk"), "_qk")
    fields = list(fields)
    if fields:
        out = out.join(docs.select("concept_id", *fields), "concept_id")
    return out.select(id_col, "rank", "concept_id", "score", *fields)


def hit_counts(queries: DataFrame, idx: DataFrame, docs: DataFrame | None = None, *,
               id_col: str = "query_id", **kw) -> DataFrame:
    """Total hits per label (numFound), counted once per scoring key."""
    label_map, hits = scores(queries, idx, docs, id_col=id_col, by_key=True, **kw)
    counts = hits.groupBy("_qk").agg(F.count(F.lit(1)).alias("num_found"))
    return label_map.join(counts, "_qk").select(id_col, "num_found")


def facets(queries: DataFrame, idx: DataFrame, docs: DataFrame, fields: Iterable[str], n: int = 10,
           min_count: int = 1, id_col: str = "query_id", **kw) -> DataFrame:
    """Top-n values of each facet field over each label's hits (count desc, value),
    counted once per scoring key."""
    label_map, hits = scores(queries, idx, docs, id_col=id_col, by_key=True, **kw)
    f = facet_counts(hits, docs, fields, n, min_count, "_qk")
    return label_map.join(f, "_qk").select(id_col, "field", "value", "count")


def facet_counts(hits: DataFrame, docs: DataFrame, fields: Iterable[str], n: int = 10, min_count: int = 1,
                 id_col: str = "query_id") -> DataFrame:
    """Top-n values of each facet field over the hits of each ``id_col`` (count desc, value)."""
    fields = list(fields)
    stacked = docs.select("concept_id", F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("fv"))
    stacked = stacked.select("concept_id", "fv.field", "fv.value").filter(F.col("value").isNotNull())
    counts = (hits.select(id_col, "concept_id").join(stacked, "concept_id")
              .groupBy(id_col, "field", "value").agg(F.count(F.lit(1)).alias("count"))
              .filter(F.col("count") >= min_count))
    w = Window.partitionBy(id_col, "field").orderBy(F.col("count").desc(), F.col("value"))
    return counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def match_all(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "query_id") -> DataFrame:
    """No-query fallback: every document matches with score 1.0; ranks by id.

    The k first documents are found once (a global top-k, k rows) and attached
    to each empty label as one k-element array (a scalar subquery), no join."""
    first = (docs.select("concept_id").orderBy("concept_id").limit(k)
             .agg(F.array_sort(F.collect_list("concept_id")).alias("ids")).scalar())
    return queries.select(id_col, F.posexplode(first).alias("rank", "concept_id")).select(
        id_col, (F.col("rank") + 1).alias("rank"), "concept_id", F.lit(1.0).alias("score"))


# ------------------------------------------------------------ phrase boost
# Phrase fields and weights of the reference's keyword search (pf3, slop 2).
PHRASE_WEIGHTS = {"concept_name": 6.0, "concept_synonym_name": 3.0, "concept_mapped_name": 3.0}
PHRASE_SLOP = 2


def query_shingles(qtexts: DataFrame, key: str, groups: Mapping[str, str], size: int = 3,
                   protected: Iterable[str] = ()) -> DataFrame:
    """(key, group, sh, t0..t{size-1}): consecutive analysed query terms."""
    per_group = F.array(*[F.struct(F.lit(g).alias("group"), F.col(c).alias("qtext")) for g, c in groups.items()])
    q = (qtexts.select(key, F.explode(per_group).alias("gq"))
         .select(key, F.col("gq.group").alias("group"), F.col("gq.qtext").alias("qtext"))
         .filter(F.col("qtext").isNotNull()))
    rows = tx.token_rows_by(q, "qtext", "group", list(groups), keep=[key], protected=protected)
    w = Window.partitionBy(key, "group").orderBy("pos")
    rows = rows.withColumn("sh", F.row_number().over(w))
    for i in range(1, size):
        rows = rows.withColumn(f"t{i}", F.lead("token", i).over(w))
    return rows.filter(F.col(f"t{size - 1}").isNotNull()).select(
        key, "group", "sh", F.col("token").alias("t0"), *[f"t{i}" for i in range(1, size)])


def phrase_lists(positions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Positional lists, written once: (concept_id, group, field, toks, dl), where ``toks``
    maps each token of a concept's field to its places (value_idx, pos) in order; and the
    tokens (group, field, token, df, n_docs, avgdl)."""
    lists = cut_lineage(positions.groupBy("concept_id", "group", "field").agg(
        F.map_from_entries(F.collect_list(F.struct("token", "places"))).alias("toks"),
        F.max("dl").alias("dl")), "positional-lists")
    fields = lists.groupBy("group", "field").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl"))
    terms = lists.select("group", "field", F.explode(F.map_keys("toks")).alias("token")).groupBy("group", "field", "token").agg(
        F.count(F.lit(1)).alias("df"))
    return lists, cut_lineage(terms.join(F.broadcast(fields), ["group", "field"]), "phrase-tokens")  # one row a field


def _phrase_frequency(places: list[Column], slop: int) -> Column:
    """Sum of 1 / (1 + length) over one place of each term in the same value, all places
    different, whose length (spread of pos - i) is at most ``slop``: places that cannot
    fit those chosen before are left out at once."""
    def choose(i: int, chosen: list[Column]) -> Column:
        def fits(x: Column) -> Column:
            rel = [c["pos"] - j for j, c in enumerate([*chosen, x])]
            length = F.greatest(*rel) - F.least(*rel)
            apart = [c["pos"] != x["pos"] for c in chosen]
            return (x["value_idx"] == chosen[0]["value_idx"]) & (length <= slop) & reduce(lambda p, q: p & q, apart)

        def worth(x: Column) -> Column:
            if i + 1 < len(places):
                return choose(i + 1, [*chosen, x])
            rel = [c["pos"] - j for j, c in enumerate([*chosen, x])]
            return F.lit(1.0) / (1 + F.greatest(*rel) - F.least(*rel))
        found = F.filter(places[i], fits) if chosen else places[i]
        return F.aggregate(found, F.lit(0.0), lambda acc, x: acc + worth(x))
    return choose(0, [])


def phrase_scores(qtexts: DataFrame, key: str, lists: DataFrame, terms: DataFrame, groups: Mapping[str, str],
                  weights: Mapping[str, float] = PHRASE_WEIGHTS, slop: int = PHRASE_SLOP, size: int = 3,
                  k1: float = K1, b: float = B, protected: Iterable[str] = ()) -> DataFrame:
    """(key, concept_id, pscore): sloppy phrase matches of the query's term
    shingles.  A match is one position of each term in the same field value with
    match length (spread of pos_i - i) <= slop; its frequency counts 1/(1 + length);
    the phrase is scored like a term (BM25 with the summed idf of its terms),
    weighted per field, best field per shingle, summed over shingles.

    ``lists`` and ``terms`` come from ``phrase_lists``.  Shingles, few and counted, go to the lists by
    their rarest term; the lists of the other terms are in the same row, so postings are
    not shuffled and nothing is multiplied before all terms are there."""
    sh = query_shingles(qtexts, key, groups, size, protected)
    names = [f"t{i}" for i in range(size)]
    spread_ = terms.groupBy("group", "token").agg(F.sum("df").alias("found"))
    each = sh.select("group", *names).distinct()
    rarest = each.select("group", *names, F.explode(F.array(*[F.col(c) for c in names])).alias("token")).join(
        spread_, ["group", "token"]).groupBy("group", *names).agg(F.min(F.struct("found", "token")).alias("m"), F.countDistinct("token").alias("known"))
    known = F.size(F.array_distinct(F.array(*[F.col(c) for c in names])))
    rarest = cut_lineage(rarest.filter(F.col("known") == known).select("group", *names, F.col("m.token").alias("token"))
                         .withColumn("sid", F.monotonically_increasing_id()), "shingles")
    few = rarest.count() <= topk.BROADCAST_TERMS
    rows = lists.filter(F.col("group").isin(list(groups))).select("concept_id", "group", "field", "dl", "toks", F.explode(F.map_keys("toks")).alias("token"))
    rows, sides = rows.alias("r"), (F.broadcast(rarest) if few else rarest).alias("s")
    here = [F.map_contains_key("r.toks", F.col(f"s.{c}")) for c in names]
    on = (F.col("r.group") == F.col("s.group")) & (F.col("r.token") == F.col("s.token")) & reduce(lambda p, q: p & q, here)
    found = rows.join(sides, on).select("s.sid", "r.concept_id", "r.group", "r.field", "r.dl", *[f"s.{c}" for c in names],
                                        _phrase_frequency([F.element_at(F.col("r.toks"), F.col(f"s.{c}")) for c in names], slop).alias("freq"))
    s = found.filter("freq > 0")
    idf_t = terms.select("group", "field", "token", "n_docs", "avgdl",
                         F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    for i, c in enumerate(names):
        own = idf_t.select("group", "field", F.col("token").alias(c), F.col("idf").alias(f"idf{i}"), *(["avgdl"] if i == 0 else []))
        s = s.join(own, ["group", "field", c])
    idf = sum((F.col(f"idf{i}") for i in range(1, size)), F.col("idf0"))
    norm = F.col("freq") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl"))
    s = s.withColumn("field_base", F.regexp_replace("field", "_(en|fr|fr_en)$", ""))
    s = s.withColumn("ps", topk.weight(weights) * idf * F.col("freq") / norm)
    per_sh = s.groupBy("sid", "concept_id").agg(F.max("ps").alias("ps"))
    asked = sh.join(rarest.select("group", *names, "sid"), ["group", *names]).select(key, "sid")
    return asked.join(per_sh, "sid").groupBy(key, "concept_id").agg(F.sum("ps").alias("pscore"))


def rank_with_phrases(queries: DataFrame, idx: DataFrame, lists: DataFrame, terms: DataFrame, *, k: int = 10, page: int = 1,
                      id_col: str = "query_id", groups: Mapping[str, str] | None = None,
                      weights: Mapping[str, float] | None = None,
                      phrase_weights: Mapping[str, float] = PHRASE_WEIGHTS, slop: int = PHRASE_SLOP) -> DataFrame:
    """Top-k with term score + phrase boost (documents matching only through a
    phrase are term matches too, so the term hits are the candidate set)."""
    groups = dict(groups or {g: "text" for g in GROUP_FIELDS})
    labeled, text_cols = label_keys(queries, groups)
    label_map, keys, texts = numbered(labeled, text_cols, id_col)
    qt = cut_lineage(query_tokens(texts, "_ti", groups), "label-tokens")
    postings = cut_lineage(topk.fold(idx, groups, weights, qt), "folded")
    ps = cut_lineage(phrase_scores(texts, "_ti", lists, terms, groups, phrase_weights, slop), "phrase-hits")
    # a phrase only adds: without one, a concept is ranked only if it is among the best by its
    # terms; concepts with one, which are few, get all their terms looked up
    adds = min([0.0, *phrase_weights.values()]) >= 0
    plain = topk.best(qt, "_ti", postings, k * page) if adds else topk.all_scores(qt, "_ti", postings)
    plain = plain.join(ps, ["_ti", "concept_id"], "left_anti")
    ts = (ps.select("_ti", "concept_id").join(qt, "_ti").join(postings, ["group", "token", "concept_id"])
          .groupBy("_ti", "concept_id").agg(F.sum(F.col("fs") * F.col("qtf")).alias("score")))
    both = ps.join(ts, ["_ti", "concept_id"]).select("_ti", "concept_id", (F.col("score") + F.col("pscore")).alias("score"))
    both = both.unionByName(plain)
    hits = keys.join(both, "_ti").select("_qk", "concept_id", "score")
    out = label_map.join(top_k(hits, k, page, "_qk"), "_qk")
    return out.select(id_col, "rank", "concept_id", "score")


# ------------------------------------------------------------- highlighting
RUN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"
HL_PRE, HL_POST = "<em>", "</em>"
HL_SNIPPETS = 10


def highlight(top: DataFrame, queries: DataFrame, docs: DataFrame, *, id_col: str = "query_id",
              groups: Mapping[str, str] | None = None, snippets: int = HL_SNIPPETS,
              protected: Iterable[str] = ()) -> DataFrame:
    """Matched words of the top hits marked in their field values.

    Only the values of the top-k rows are touched, once per distinct label text.  Each
    value is split into word and separator runs; a word whose token (its field's chain)
    is one of the label's query tokens of the same group is wrapped in <em></em>, and
    the runs are put together again, so the text is kept exactly.
    Returns (query_id, rank, concept_id, field, snippet); fields without a match
    give no row (matched fields only), at most ``snippets`` values per field, those with
    the most marked words first, then by their place."""
    groups = dict(groups or {g: "text" for g in GROUP_FIELDS})
    labeled, text_cols = label_keys(queries, groups)
    hits = top.select(id_col, "rank", "concept_id").join(labeled.select(id_col, F.col("_qk._tk").alias("_tk")), id_col)
    pairs = hits.select("_tk", "concept_id").distinct()
    qtexts = hits.select("_tk").distinct().select(
        "_tk", *[F.when(F.col(f"_tk.{c}") != "\u0000", F.col(f"_tk.{c}")).alias(c) for c in text_cols])
    wanted = query_tokens(qtexts, "_tk", groups, protected).groupBy("_tk", "group").agg(F.collect_set("token").alias("wanted"))
    fields = [f for g in groups for f in GROUP_FIELDS[g]]
    vals = field_values(docs.join(hits.select("concept_id").distinct(), "concept_id", "left_semi"), fields)
    grp = None
    for g in groups:
        cond = F.col("field").isin(GROUP_FIELDS[g])
        grp = F.when(cond, F.lit(g)) if grp is None else grp.when(cond, F.lit(g))
    rows = pairs.join(vals.withColumn("group", grp), "concept_id").join(wanted, ["_tk", "group"])
    rows = rows.repartition(analysis_partitions(rows))

    def marks(lang: str) -> Column:
        return F.transform(F.regexp_extract_all("value", F.lit(RUN), 0), lambda r: F.struct(
            r.alias("run"), F.arrays_overlap(tx.token_array(r, lang, protected), F.col("wanted")).alias("m")))

    parts = None
    for g in groups:
        own = marks(GROUP_LANG[g])
        parts = F.when(F.col("group") == g, own) if parts is None else parts.when(F.col("group") == g, own)
    rows = rows.select("_tk", "concept_id", "field", "value_idx", parts.alias("parts"))
    marked = rows.withColumn("hits", F.size(F.filter("parts", lambda x: x["m"]))).filter("hits > 0")
    w = Window.partitionBy("_tk", "concept_id", "field").orderBy(F.col("hits").desc(), F.col("value_idx"))
    best = marked.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= snippets)
    snip = best.select("_tk", "concept_id", "field", F.array_join(F.transform("parts", lambda x: F.when(
        x["m"], F.concat(F.lit(HL_PRE), x["run"], F.lit(HL_POST))).otherwise(x["run"])), "").alias("snippet"))
    return hits.join(snip, ["_tk", "concept_id"]).select(id_col, "rank", "concept_id", "field", "snippet")


# ------------------------------------------------------ synonym expansion
def _analysed(df: DataFrame, col: str, lang: str, protected: Iterable[str]) -> Column:
    return tx.token_array(F.col(col), lang, protected)


def expand_tokens(qtexts: DataFrame, key: str, text_col: str, lang: str, groups: DataFrame | None = None,
                  rewrites: DataFrame | None = None, protected: Iterable[str] = ()) -> DataFrame:
    """(key, token) after query-time synonym expansion (multi-word aware: the
    query is not split on spaces before matching).

    ``groups`` (group_key, member): a query n-gram equal to a member (after
    analysis) adds the tokens of every member of its group - joined per group,
    never as member pairs.  ``rewrites`` (term, replacement): the matched words
    are replaced by the replacement's tokens (``term => replacement``)."""
    # rules by term: a term brings the set of its rules' tokens, so matches are joined to as many
    # rows as there are tokens, not to every rule of the term.  All sides grow with the rules or
    # the texts: none is broadcast
    by_term = []
    if groups is not None:
        g = groups.select("group_key", _analysed(groups, "member", lang, protected).alias("tt")).filter(F.size("tt") > 0)
        group_terms = g.select(F.array_join("tt", " ").alias("term_key"), F.size("tt").alias("n"), "group_key").distinct()
        group_tokens = g.select("group_key", F.explode("tt").alias("token")).distinct()
        by_term.append(group_terms.select("n"))
    if rewrites is not None:
        r = rewrites.select(_analysed(rewrites, "term", lang, protected).alias("tt"),
                            _analysed(rewrites, "replacement", lang, protected).alias("repl")).filter((F.size("tt") > 0) & F.col("repl").isNotNull())
        r = r.select(F.array_join("tt", " ").alias("term_key"), F.size("tt").alias("n"), "repl").distinct()
        rewrite_terms = r.select("term_key", "n").distinct()
        rewrite_tokens = r.select("term_key", F.explode("repl").alias("token")).distinct()
        by_term.append(rewrite_terms.select("n"))
    max_n = reduce(DataFrame.unionByName, by_term).agg(F.max("n")).first()[0] or 1  # one number: the longest rule term
    rows = tx.token_rows(qtexts.filter(F.col(text_col).isNotNull()), text_col, lang, keep=[key], protected=protected)
    seq = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("s"))
    seq = seq.select(key, F.transform("s", lambda x: x["token"]).alias("toks"))

    def grams_of(n):
        return F.transform(F.sequence(F.lit(1), F.size("toks") - n + 1),
                           lambda i: F.struct(i.alias("start"), n.alias("n"),
                                              F.array_join(F.slice("toks", i, n), " ").alias("term_key")))

    lengths = F.sequence(F.lit(1), F.least(F.lit(int(max_n)), F.size("toks")))
    grams = (seq.filter(F.size("toks") > 0)
             .select(key, F.explode(F.flatten(F.transform(lengths, grams_of))).alias("g"))
             .select(key, "g.start", "g.n", "g.term_key"))
    out = seq.select(key, F.posexplode("toks").alias("idx", "token")).withColumn("idx", F.col("idx") + 1)
    if rewrites is not None:
        hit = grams.join(rewrite_terms.select("term_key").hint("merge"), "term_key")
        replaced = hit.select(key, F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("idx"))
        out = out.join(replaced.hint("merge"), [key, "idx"], "left_anti")
    out = out.select(key, "token")
    if rewrites is not None:
        out = out.unionByName(hit.select(key, "term_key").distinct().join(rewrite_tokens.hint("merge"), "term_key").select(key, "token"))
    if groups is not None:
        gh = grams.join(group_terms.drop("n").hint("merge"), "term_key").select(key, "group_key").distinct()
        out = out.unionByName(gh.join(group_tokens.hint("merge"), "group_key").select(key, "token"))
    return out.distinct()


def rank_expanded(queries: DataFrame, idx: DataFrame, *, lang_group: str = "en", groups: DataFrame | None = None,
                  rewrites: DataFrame | None = None, k: int = 10, page: int = 1, id_col: str = "query_id",
                  text_col: str = "text", protected: Iterable[str] = ()) -> DataFrame:
    """Top-k per label after query-time synonym expansion in one field group.

    Each distinct label text is expanded (group / rewrite rules) and scored once
    (dismax over the group's fields, each expanded token counted once), then
    ranked and attached to every label with that text."""
    texts = cut_lineage(queries.select(text_col).filter(F.col(text_col).isNotNull()).distinct()
                        .withColumn("_ti", F.monotonically_increasing_id()), "texts")
    toks = expand_tokens(texts, "_ti", text_col, GROUP_LANG[lang_group], groups=groups, rewrites=rewrites, protected=protected)
    qt = toks.select("_ti", F.lit(lang_group).alias("group"), "token", F.lit(1).cast("long").alias("qtf"))
    hits = topk.best(qt, "_ti", topk.fold(idx, [lang_group], terms=qt), k * page)
    top = top_k(hits, k, page, "_ti").join(texts, "_ti")
    return queries.select(id_col, text_col).join(top, text_col).select(id_col, "rank", "concept_id", "score")
