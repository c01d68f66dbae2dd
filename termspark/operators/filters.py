"""Filters as data: each label brings its own filter, all are evaluated in one job.

A filter is a set of clauses that must all hold; a clause holds if one of its literals
does.  Literals are rows:

    filter_id, clause, negated, kind, field, value, lo, hi

    kind 'enum'   the document's field equals ``value``
    kind 'num'    the field lies between ``lo`` and ``hi`` (null: no limit)
    kind 'text'   the analysed field contains every token of the analysed ``value``

Documents meet literals by joins on (field, value) or (field, token), and by field for
ranges.  Only matches are kept; that a negated literal holds for a document is counted from
its clause, not listed: a clause without a match for a document holds if it has a negated
literal.  So the complement of a literal is never written out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.plan_tools import analysis_partitions, cut_lineage
from . import search, topk

LITERALS = "filter_id long, clause int, negated boolean, kind string, field string, value string, lo double, hi double"
NO_FILTER = -1


def _stacked(docs: DataFrame, fields: list[str], kind: str) -> DataFrame:
    """(concept_id, field, x) of the given columns; arrays give a row for each element."""
    parts = []
    for f in fields:
        array = docs.schema[f].dataType.typeName() == "array"
        own = docs.select("concept_id", (F.explode(f) if array else F.col(f)).alias("x"))
        parts.append(own.select("concept_id", F.lit(f).alias("field"), F.col("x").cast(kind).alias("x")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("x").isNotNull())


def matches(docs: DataFrame, idx: DataFrame, literals: DataFrame) -> DataFrame:
    """(lit, concept_id): which literals (numbered ``lit``) hold for which documents, before negation."""
    fields: dict[str, list[str]] = {}
    for r in literals.select("kind", "field").distinct().orderBy("kind", "field").collect():  # at most the columns of docs
        fields.setdefault(r.kind, []).append(r.field)
    found = []
    if "enum" in fields:
        own = literals.filter("kind = 'enum'").select("lit", "field", F.col("value").alias("x"))
        found.append(_stacked(docs, fields["enum"], "string").join(own, ["field", "x"]).select("lit", "concept_id").distinct())
    if "num" in fields:
        own = literals.filter("kind = 'num'").select("lit", "field", "lo", "hi")
        rows = _stacked(docs, fields["num"], "double").join(own, "field")
        inside = (F.col("lo").isNull() | (F.col("x") >= F.col("lo"))) & (F.col("hi").isNull() | (F.col("x") <= F.col("hi")))
        found.append(rows.filter(inside).select("lit", "concept_id").distinct())
    if "text" in fields:
        asked = None
        for f in fields["text"]:
            lang = search.GROUP_LANG[search.field_group(f)]
            own = literals.filter((F.col("kind") == "text") & (F.col("field") == f)).select(
                "lit", "field", F.array_distinct(tx.token_array(F.col("value"), lang)).alias("toks"))
            asked = own if asked is None else asked.unionByName(own)
        each = asked.select("lit", "field", F.size("toks").alias("n"), F.explode("toks").alias("token"))
        rows = idx.select("field", "token", "concept_id").join(each, ["field", "token"])
        found.append(rows.groupBy("lit", "concept_id").agg(F.count(F.lit(1)).alias("have"), F.max("n").alias("n"))
                     .filter("have = n").select("lit", "concept_id"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def passing(hits: DataFrame, docs: DataFrame, idx: DataFrame, literals: DataFrame) -> DataFrame:
    """The rows of ``hits`` (filter_id, concept_id, ...) whose document passes the filter;
    a filter without literals lets every document pass."""
    literals = cut_lineage(literals.withColumn("lit", F.monotonically_increasing_id()), "literals")
    clauses = literals.groupBy("filter_id", "clause").agg(F.sum(F.col("negated").cast("int")).alias("negs"))
    filters = clauses.groupBy("filter_id").agg(F.count(F.lit(1)).alias("clauses"), F.sum((F.col("negs") > 0).cast("int")).alias("open"))
    # clauses that a document has a match in: do they hold, and would they without it?
    met = (matches(docs, idx, literals).join(literals.select("lit", "filter_id", "clause", "negated"), "lit")
           .groupBy("filter_id", "clause", "concept_id")
           .agg(F.max((~F.col("negated")).cast("int")).alias("plain"), F.sum(F.col("negated").cast("int")).alias("hit"))
           .join(clauses, ["filter_id", "clause"]))
    met = met.groupBy("filter_id", "concept_id").agg(
        F.sum(((F.col("plain") > 0) | (F.col("hit") < F.col("negs"))).cast("int")).alias("held"),
        F.sum((F.col("negs") > 0).cast("int")).alias("opened"))
    held = F.coalesce("held", F.lit(0)) + F.col("open") - F.coalesce("opened", F.lit(0))
    own = hits.join(filters, "filter_id", "left").join(met, ["filter_id", "concept_id"], "left")
    return own.filter(F.col("clauses").isNull() | (held == F.col("clauses"))).select(*hits.columns)


def rank_filtered(queries: DataFrame, idx: DataFrame, docs: DataFrame, literals: DataFrame, *, k: int = 10, page: int = 1,
                  id_col: str = "query_id", filter_col: str = "filter_id", groups: Mapping[str, str] | None = None,
                  weights: Mapping[str, float] | None = None) -> DataFrame:
    """Top-k concepts per label among those that pass the label's own filter: (query_id,
    rank, concept_id, score).  A null filter, or one without literals, lets all pass.
    Ranked once for each pair of text and filter."""
    groups = dict(groups or {g: "text" for g in search.GROUP_FIELDS})
    labeled, text_cols = search.label_keys(queries, groups)
    own = F.coalesce(F.col(filter_col).cast("long"), F.lit(NO_FILTER)).alias("filter_id")
    labeled = labeled.withColumn("_qk", F.struct(F.col("_qk._tk").alias("_tk"), own))
    label_map, keys, texts = search.numbered(labeled, text_cols, id_col)
    qt = search.query_tokens(texts, "_ti", groups)
    hits = cut_lineage(topk.all_scores(qt, "_ti", topk.fold(idx, groups, weights, qt, all_hits=True)), "text-hits")
    # a text's hits come once for each of its filters and are joined, filtered and ranked where
    # they are dealt to: in as many partitions as there are such rows, not as their bytes
    keys = cut_lineage(keys, "filter-keys")
    few = keys.count() <= topk.BROADCAST_TERMS
    times = keys.groupBy("_ti").agg(F.count(F.lit(1)).alias("times"))
    rows = hits.groupBy("_ti").agg(F.count(F.lit(1)).alias("n")).join(times, "_ti").agg(F.sum(F.col("n") * F.col("times"))).first()[0]
    hits = hits.join(F.broadcast(keys) if few else keys.hint("merge"), "_ti").select("_qk", "filter_id", "concept_id", "score")
    hits = hits.repartition(topk.partitions(analysis_partitions(hits), rows), "filter_id", "concept_id")
    top = search.top_k(passing(hits, docs, idx, literals).drop("filter_id"), k, page, "_qk")
    return label_map.join(top, "_qk").select(id_col, "rank", "concept_id", "score")
