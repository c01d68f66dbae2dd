"""Scoring of labels against the index: all hits, or exactly the k best by score bounds.

Postings are folded once per call: per (group, token, concept) the best weighted field
score (dismax, tie 0).  They are then dealt out by concept, and the labels' tokens, which
are few and counted, are broadcast to them, so all contributions to one (label, concept)
meet in one partition: hits are summed where they arise and never shuffled.  More tokens
than ``BROADCAST_TERMS`` are joined by a shuffle instead.

Kinds.  Concepts that have the same asked tokens with the same scores cannot be told apart by
any label: they are scored as one row, and only the k first of them by id can be ranked.

Bounds.  A token's *top* is its best folded score, its *kth* its k-th best.  For a label,
tokens are ordered by what they can add at most (times their count in the label).

1. The concepts with a label's first token get their whole score where they stand, from the
   scores of all their tokens in the same row.  Their k-th best, or the best *kth* of the
   tokens, is a threshold that no k-th best score can lie below.
2. A token is *essential* if it and all tokens behind it together can reach the threshold.
   A concept without an essential token cannot, so only postings of essential tokens are
   read: a token that nearly every concept has costs a label nothing as soon as it has a
   better one.  A concept is scored with the first token of the label that it has.
3. Only scores that reach the threshold leave the task, and of those k a label: nothing
   that grows with labels times concepts is shuffled, sorted or written.

All comparisons leave room for the rounding of the final ranking, so ties at rank k stay and
the ranking is that of all hits.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.plan_tools import analysis_partitions, cut_lineage

#: label tokens up to so many (about 30 bytes each) are broadcast
BROADCAST_TERMS = 1_000_000
#: up to so many contributions are all summed up: finding bounds would cost more (the result is the same)
ALL_HITS = 20_000_000
#: contributions that one partition sums up or sorts
HITS_PER_PARTITION = 2_000_000
#: scores are ranked by six decimals
DIGITS = 6
ROOM = 2e-6


def weight(weights: Mapping[str, float]) -> Column:
    """Weight of a field by its ``field_base``; 1 for fields that are not named."""
    expr = F.lit(1.0)
    for base, w in weights.items():
        expr = F.when(F.col("field_base") == base, F.lit(float(w))).otherwise(expr)
    return expr


def fold(idx: DataFrame, groups: Iterable[str], weights: Mapping[str, float] | None = None, terms: DataFrame | None = None,
         all_hits: bool = False) -> DataFrame:
    """(group, token, concept_id, fs): the best weighted field score, dealt out by concept;
    with ``terms`` (group, token, ...), few enough, postings of other tokens stay where they are.
    Dealt out in as many partitions as the postings need, or (``all_hits``) their contributions to ``terms``."""
    ix = idx.filter(F.col("group").isin(list(groups))).withColumn("field_base", F.regexp_replace("field", "_(en|fr|fr_en)$", ""))
    ix = ix.select("group", "token", "concept_id", (F.col("bm25") * weight(weights or {})).alias("fs"))
    parts = analysis_partitions(ix)
    if terms is not None:
        asked = cut_lineage(terms.groupBy("group", "token").agg(F.count(F.lit(1)).alias("labels")), "asked-tokens")
        few = asked.count() <= BROADCAST_TERMS
        met = ix.join(F.broadcast(asked) if few else asked, ["group", "token"])
        parts = partitions(parts, met.agg(F.sum("labels" if all_hits else F.lit(1))).first()[0])
        if few:
            ix = ix.join(F.broadcast(asked), ["group", "token"], "left_semi")
    return (ix.repartition(parts, "concept_id")
            .groupBy("group", "token", "concept_id").agg(F.max("fs").alias("fs")))


def partitions(least: int, hits: int | None) -> int:
    """Partitions for so many rows that a task sorts or sums up."""
    return max(least, -(-(hits or 0) // HITS_PER_PARTITION))


def _sums(postings: DataFrame, terms: DataFrame, on: list[str], key: str, few: bool, extra: Iterable[Column] = ()) -> DataFrame:
    """(key, concept_id, score, ...): sums over ``terms`` (key, qtf, ...) where they arise."""
    hits = postings.join(F.broadcast(terms) if few else terms, on)
    return hits.groupBy(key, "concept_id").agg(F.sum(F.col("fs") * F.col("qtf")).alias("score"), *extra)


def all_scores(terms: DataFrame, key: str, postings: DataFrame) -> DataFrame:
    """(key, concept_id, score) of every concept that shares a token with a label."""
    terms = cut_lineage(terms, "label-tokens")
    return _sums(postings, terms, ["group", "token"], key, terms.count() <= BROADCAST_TERMS)


def kinds(postings: DataFrame, asked: DataFrame, k: int, few: bool) -> DataFrame:
    """(pid, toks, ids): concepts that the ``asked`` tokens (group, token, tid) cannot tell
    apart, as one row: ``toks`` maps those of them that the concepts have to their scores,
    ``ids`` are the ``k`` first concepts, ``pid`` the first."""
    rows = postings.join(F.broadcast(asked) if few else asked, ["group", "token"]).select("concept_id", "tid", "fs")
    rows = rows.groupBy("concept_id").agg(F.array_sort(F.collect_list(F.struct("tid", "fs"))).alias("toks"))
    order = Window.partitionBy("toks").orderBy("concept_id")
    rows = rows.withColumn("nr", F.row_number().over(order)).filter(F.col("nr") <= k).groupBy("toks").agg(
        F.array_sort(F.collect_list(F.struct("nr", "concept_id"))).alias("ids"))
    return rows.select(F.col("ids")[0]["concept_id"].alias("pid"), F.map_from_entries("toks").alias("toks"),
                       F.transform("ids", lambda x: x["concept_id"]).alias("ids"))


def token_bounds(postings: DataFrame, k: int) -> DataFrame:
    """(tid, df, top, kth) by token; kth is 0 with fewer than k postings."""
    best_first = Window.partitionBy("tid").orderBy(F.col("fs").desc())
    kth = (postings.withColumn("nr", F.row_number().over(best_first)).filter(F.col("nr") <= k)
           .groupBy("tid").agg(F.coalesce(F.min(F.when(F.col("nr") == k, F.col("fs"))), F.lit(0.0)).alias("kth")))
    whole = postings.groupBy("tid").agg(F.count(F.lit(1)).alias("df"), F.max("fs").alias("top"))
    return cut_lineage(whole.join(kth, "tid"), "token-bounds")


def label_terms(terms: DataFrame, key: str, bounds: DataFrame) -> DataFrame:
    """Each label's tokens by what they can add: (key, tid, df, nr, onwards, floor, want):
    ``onwards`` is the most that the token and those behind it can add, ``floor`` the first
    threshold, ``want`` all tokens (nr, tid, qtf) of the label in this order."""
    t = terms.join(bounds, "tid").select(
        key, "tid", "qtf", "df", (F.col("qtf") * F.col("top")).alias("most"), (F.col("qtf") * F.col("kth")).alias("least"))
    label = Window.partitionBy(key)
    order = label.orderBy(F.col("most").desc(), "tid")
    t = t.select(key, "tid", "qtf", "df", F.row_number().over(order).alias("nr"),
                 F.sum("most").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("onwards"),
                 F.max("least").over(label).alias("floor"))
    want = F.array_sort(F.collect_list(F.struct("nr", "tid", "qtf")).over(label)).alias("want")
    return t.select(key, "tid", "df", "nr", "onwards", "floor", want)


def _dealt(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Kinds dealt out, in as many partitions as the hits of ``terms`` need."""
    hits = terms.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    return rows.repartition(partitions(analysis_partitions(rows), hits), "pid")


def _first(rows: DataFrame, key: str, k: int) -> DataFrame:
    """The first k kinds of each label, in the order of the final ranking, numbered ``n``."""
    rows = rows.withColumn("_rs", F.round("score", DIGITS))
    order = Window.partitionBy(key).orderBy(F.col("_rs").desc(), "pid")
    return rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).drop("_rs")


def _reaching(found: DataFrame, own: DataFrame, key: str, k: int) -> DataFrame:
    """(key, pid, score, n): the first k kinds of each label among those that have a token of
    ``own``, none before it, and reach the label's floor."""
    many = own.agg(F.coalesce(F.sum(F.size("want")), F.lit(0))).first()[0]
    own = own.select(key, "tid", "floor", "want", F.slice("want", 1, F.col("nr") - 1).alias("before"))
    own = F.broadcast(own) if many <= BROADCAST_TERMS else own
    rows = found.select("pid", "toks", F.explode(F.map_keys("toks")).alias("tid")).join(own, "tid")
    rows = rows.filter(~F.exists("before", lambda x: F.map_contains_key("toks", x["tid"])))
    score = F.aggregate("want", F.lit(0.0), lambda acc, x: acc + x["qtf"] * F.coalesce(F.try_element_at("toks", x["tid"]), F.lit(0.0)))
    rows = rows.select(key, "pid", "floor", score.alias("score")).filter(F.col("score") >= F.col("floor") - ROOM)
    return _first(rows.drop("floor"), key, k)


def best(terms: DataFrame, key: str, postings: DataFrame, k: int, all_hits: int | None = None) -> DataFrame:
    """(key, concept_id, score): for every label all concepts that can be among its k best,
    with their exact scores.  ``terms``: (key, group, token, qtf).  Up to ``all_hits``
    (``ALL_HITS``) contributions are all summed up."""
    all_hits = ALL_HITS if all_hits is None else all_hits
    terms = cut_lineage(terms, "label-tokens")
    asked = cut_lineage(terms.select("group", "token").distinct().withColumn("tid", F.monotonically_increasing_id()), "asked")
    terms = cut_lineage(terms.join(asked, ["group", "token"]).select(key, "tid", "qtf"), "label-terms")
    found = cut_lineage(kinds(postings, asked, k, asked.count() <= BROADCAST_TERMS), "kinds")
    flat = found.select("pid", F.explode("toks").alias("tid", "fs"))
    bounds = token_bounds(flat, k)
    hits = terms.join(bounds, "tid").agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    if hits <= all_hits:
        dealt = flat.repartition(partitions(analysis_partitions(flat), hits), "pid")
        rows = dealt.join(F.broadcast(terms) if terms.count() <= BROADCAST_TERMS else terms, "tid")
        first = _first(rows.groupBy(key, "pid").agg(F.sum(F.col("fs") * F.col("qtf")).alias("score")), key, k)
    else:
        own = cut_lineage(label_terms(terms, key, bounds), "label-bounds")
        start = own.filter("nr = 1")
        early = cut_lineage(_reaching(_dealt(found, start), start, key, k), "early")
        reached = early.filter(F.col("n") == k).select(key, F.col("score").alias("reached"))
        rest = own.filter("nr > 1").join(reached, key, "left")
        rest = rest.withColumn("floor", F.greatest("floor", F.coalesce("reached", F.lit(0.0))))
        rest = cut_lineage(rest.filter(F.col("onwards") >= F.col("floor") - ROOM), "essential")
        late = _reaching(_dealt(found, rest), rest, key, k)
        first = _first(early.unionByName(late).drop("n"), key, k)
    first = first.withColumnRenamed("pid", "_pid").join(found.select("pid", "ids"), F.col("_pid").eqNullSafe(F.col("pid")))
    return first.select(key, F.explode("ids").alias("concept_id"), "score")
