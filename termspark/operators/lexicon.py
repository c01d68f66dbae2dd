"""Lexicon work: synonym groups, bilingual lexicon, word-by-word translation,
code mapping (both directions), two-hop enrichment, code-list load, text batching.
"""

from __future__ import annotations

import datetime as _dt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan_tools import cut_lineage

OPEN_END = _dt.date(2099, 1, 1)

# Separator and character budget of translation batches.
BATCH_SEP = " ____ "
BATCH_BUDGET = 500

# Word pattern of the translation tokenizer (words, or single
# punctuation marks as their own tokens).
TRANSLATE_TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


# ---------------------------------------------------------------- groups (A10)
def group_members(df: DataFrame, group_col: str = "_c0", variant_col: str = "_c1") -> DataFrame:
    """(group_key, member) rows: the distinct variants of groups with more than one row."""
    many = df.groupBy(F.col(group_col).alias("group_key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = df.select(F.col(group_col).alias("group_key"), F.col(variant_col).alias("member")).filter("member is not null")
    return rows.distinct().join(many.select("group_key"), "group_key", "left_semi")


def groups(df: DataFrame, group_col: str = "_c0", variant_col: str = "_c1", sep: str = ",") -> DataFrame:
    """Synonym groups: distinct variants of each group joined by ``sep``, for
    groups with more than one row."""
    return (df.groupBy(F.col(group_col).alias("group_key"))
            .agg(F.concat_ws(sep, F.array_sort(F.collect_set(variant_col))).alias("result"),
                 F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1).drop("n"))


# ------------------------------------------------------------ bilingual (L2)
def bilingual(pairs: DataFrame, src: str = "fr", dst: str = "en", rank: str = "rank") -> DataFrame:
    """Word -> ranked target list; underscores become spaces, blank words are dropped.
    Returns (word, lemmas array, rule 'word => a,b')."""
    p = pairs.select(F.regexp_replace(src, "_", " ").alias("word"),
                     F.regexp_replace(dst, "_", " ").alias("lemma"), F.col(rank).alias("rank"))
    p = p.filter(F.trim("word") != "")
    g = p.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("rank", "lemma"))).alias("l"))
    g = g.select("word", F.transform("l", lambda x: x["lemma"]).alias("lemmas"))
    return g.withColumn("rule", F.concat(F.col("word"), F.lit(" => "), F.array_join("lemmas", ",")))


def expansions_from_rules(rules: DataFrame) -> DataFrame:
    """Rule frame (term, replacement) -> (token, extra_token) rows for query expansion."""
    return rules.select(F.col("term").alias("token"), F.col("replacement").alias("extra_token")).distinct()


# ----------------------------------------------------------- translation (L3)
# Minimal length and the two ending rules of the word reduction.
def reduce_word(w: Column) -> Column:
    """Words longer than 4 characters: trailing 's' removed, then 'é', 'ée', 'és',
    'ées' at the end become 'er'."""
    cut = F.regexp_replace(F.regexp_replace(w, "s$", ""), "ée?s?$", "er")
    return F.when(F.length(w) > 4, cut).otherwise(w)


def translate(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame,
              word: str = "word", lemma: str = "lemma", rank: str = "rank") -> DataFrame:
    """Word-by-word translation: tokens are reduced, looked up (first lemma by
    rank, matched without case), kept as reduced when absent, and concatenated in
    order, each preceded by a space.  Returns (id, translation)."""
    first = (lexicon.groupBy(F.lower(word).alias("_w"))
             .agg(F.min_by(lemma, F.struct(rank, lemma)).alias("_lemma")))
    toks = df.select(id_col, F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(TRANSLATE_TOKEN), 0))
                     .alias("pos", "tok"))
    toks = toks.withColumn("red", reduce_word(F.col("tok")))
    j = toks.join(first, F.lower(F.col("red")) == F.col("_w"), "left")
    out = F.coalesce(F.col("_lemma"), F.col("red"))
    per = j.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", out.alias("w")))).alias("ws"))
    return per.select(id_col, F.concat_ws("", F.transform("ws", lambda x: F.concat(F.lit(" "), x["w"])))
                      .alias("translation"))


def word_lexicon(pairs: DataFrame, src: str, dst: str) -> DataFrame:
    """(word, lemma, rank) from parallel texts: for each reduced word of ``src`` the words
    of ``dst`` in the same pairs, the most frequent first, then by name."""
    left = pairs.select(dst, F.array_distinct(F.transform(F.regexp_extract_all(src, F.lit(r"[\p{L}\p{N}]+"), 0),
                                                          lambda x: F.lower(reduce_word(x)))).alias("ws"))
    both = left.select(F.explode("ws").alias("word"), dst).select(
        "word", F.explode(F.regexp_extract_all(dst, F.lit(r"[\p{L}\p{N}]+"), 0)).alias("lemma"))
    counted = both.groupBy("word", F.lower("lemma").alias("lemma")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("word", "lemma", (-F.col("n")).alias("rank"))


def as_synonyms(translated: DataFrame, id_col: str = "concept_id", language_concept_id: int = 4180186) -> DataFrame:
    """Translations stored as synonyms of the concept (English by default)."""
    return translated.select(F.col(id_col).alias("concept_id"),
                             F.col("translation").alias("concept_synonym_name"),
                             F.lit(language_concept_id).cast("long").alias("language_concept_id"))


# ---------------------------------------------------------- code mapping (L6)
def map_codes(local: DataFrame, standard: DataFrame) -> DataFrame:
    """(concept_id_1 local, concept_id_2 standard) where the standard code with its
    dots removed equals the local code."""
    s = standard.select(F.col("concept_id").alias("concept_id_2"),
                        F.replace(F.col("concept_code"), F.lit("."), F.lit("")).alias("_code"))
    l = local.select(F.col("concept_id").alias("concept_id_1"), F.col("concept_code").alias("_code"))
    return l.join(s, "_code").select("concept_id_1", "concept_id_2")


def both_directions(pairs: DataFrame, as_of: _dt.date, forward: str = "Maps to",
                    backward: str = "Mapped from") -> DataFrame:
    """Each pair as a forward edge and its reverse, columns named explicitly."""
    cols = lambda a, b, kind: [F.col(a).alias("concept_id_1"), F.col(b).alias("concept_id_2"),
                               F.lit(kind).alias("relationship_id"), F.lit(as_of).alias("valid_start_date"),
                               F.lit(OPEN_END).alias("valid_end_date")]
    return (pairs.select(*cols("concept_id_1", "concept_id_2", forward))
            .unionByName(pairs.select(*cols("concept_id_2", "concept_id_1", backward))))


# -------------------------------------------------------------- two hop (L7)
def two_hop(first: DataFrame, edges: DataFrame) -> DataFrame:
    """a -> b (first hop) and b -> c (existing edge) give a -> c with the kind of
    the second hop; distinct, a != c."""
    f = first.select(F.col("concept_id_1").alias("a"), F.col("concept_id_2").alias("b")).distinct()
    e = edges.select(F.col("concept_id_1").alias("b"), F.col("concept_id_2").alias("c"), "relationship_id")
    j = f.join(e, "b").filter(F.col("a") != F.col("c"))
    return j.select(F.col("a").alias("concept_id_1"), F.col("c").alias("concept_id_2"), "relationship_id").distinct()


# -------------------------------------------------------- code list load (L8)
def code_list_concepts(codes: DataFrame, as_of: _dt.date, domain: str = "Condition", vocabulary: str = "CIM10",
                       concept_class: str = "billing code", language: str = "FR") -> DataFrame:
    """(cd, lib) code list -> concept rows (code 'UNKNOWN' when missing)."""
    return codes.select(
        F.col("lib").alias("concept_name"), F.lit(domain).alias("domain_id"),
        F.lit(vocabulary).alias("vocabulary_id"), F.lit(concept_class).alias("concept_class_id"),
        F.coalesce(F.col("cd"), F.lit("UNKNOWN")).alias("concept_code"),
        F.lit(as_of).alias("valid_start_date"), F.lit(OPEN_END).alias("valid_end_date"),
        F.lit(language).alias("m_language_id"))


# -------------------------------------------------------------- batches (L5)
def next_resets(w: np.ndarray, r: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of ``w``, and for every row the row of the next reset after a reset
    there (the row count if none follows)."""
    upto = np.cumsum(w)
    after = np.searchsorted(upto, budget - np.minimum(r, budget) + upto, side="left")
    return upto, np.maximum(after, np.arange(1, len(w) + 1))


def chunk_summary(w: np.ndarray, r: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Transition of one chunk for every carried count 0..budget: (end count, resets).

    Step: c += w_i; if c >= budget: resets += 1, c = r_i; counts stop at ``budget``.
    A start state only adds prefix sums up to its first reset; from there the path is
    the chain of next resets, whose length and last row come by doubling."""
    states, n = np.arange(budget + 1), len(w)
    upto, hop = next_resets(w, r, budget)
    first = np.searchsorted(upto, budget - states, side="left")
    hop = np.append(hop, n)
    many, last = np.append(np.ones(n, dtype=np.int64), 0), np.arange(n + 1)
    while (hop < n).any():
        go = hop < n
        many[go] += many[hop[go]]
        last[go] = last[hop[go]]
        hop = hop[hop]
    total = int(upto[-1]) if n else 0
    tail = np.append(np.minimum(np.minimum(r, budget) + total - upto, budget), 0)
    end = np.where(first < n, tail[last[first]], np.minimum(states + total, budget))
    return end.astype(np.int64), many[first].astype(np.int64)


CHUNK_ROWS = 50_000


def batches(labels: DataFrame, bucket: str, order: list[str], lib: str = "lib", cd: str = "cd",
            sep: str = BATCH_SEP, budget: int = BATCH_BUDGET, partitions: int | None = None,
            chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Next-fit packing of labels into request texts, per bucket, in ``order``.

    Count rule (kept as the reference counts): nchar = length(lib) + len(sep);
    each label adds nchar + len(sep); when the running count reaches ``budget`` a
    new batch starts and the count restarts at that label's nchar.  A null label counts
    as empty; null buckets are one bucket.

    Distributed exact scan: labels are range-partitioned on (bucket, order), numbered and
    written once, and cut into chunks of at most ``chunk_rows`` rows of one bucket.  Each
    chunk is summarised as a transition table over the carried count (0..budget); a fold
    over the tables of a bucket (one row per chunk) gives each chunk its starting count
    and batch number; each chunk is then replayed in parallel.  Returns
    (bucket, batch, n, group_cd, group_lib)."""
    spark = labels.sparkSession
    n_parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                spark.sparkContext.defaultParallelism)
    rows = labels.select(F.col(bucket).alias("bucket"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                         F.col(lib).alias("lib"), F.col(cd).alias("cd"))
    okeys = ["bucket"] + [f"_o{i}" for i in range(len(order))]
    size = F.coalesce(F.length("lib"), F.lit(0)).cast("long")
    # the number holds the partition and the place in it, in sorted order
    ranged = cut_lineage(rows.repartitionByRange(n_parts, *okeys).sortWithinPartitions(*okeys)
                         .withColumn("_nr", F.monotonically_increasing_id())
                         .withColumn("_w", size + 2 * len(sep)).withColumn("_r", size + len(sep)), "batches")
    # chunk: rows of one bucket, one partition and one run of chunk_rows places
    run = F.floor(F.col("_nr") / chunk_rows)
    chunked = ranged.withColumn("_b", F.coalesce(F.concat(F.lit("="), F.col("bucket").cast("string")), F.lit(""))).withColumn(
        "_chunk", F.struct(F.shiftrightunsigned("_nr", 33).alias("p"), run.alias("run")))
    cols = ["_b", "_chunk.p", "_chunk.run", "_nr", "_w", "_r"]

    def summarise(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_nr")
        end, resets = chunk_summary(pdf["_w"].to_numpy(np.int64), pdf["_r"].to_numpy(np.int64), budget)
        return pd.DataFrame([(*key, end.tolist(), resets.tolist())], columns=["_b", "p", "run", "end", "resets"])

    summary = chunked.select(*cols).groupBy("_b", "p", "run").applyInPandas(
        summarise, "_b string, p long, run long, end array<long>, resets array<long>")

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        c, g, out = 0, 0, []
        for row in pdf.sort_values(["p", "run"]).itertuples(index=False):
            out.append((row[0], row[1], row[2], c, g))
            c, g = int(row[3][c]), g + int(row[4][c])
        return pd.DataFrame(out, columns=["_b", "p", "run", "_c0", "_g0"])

    starts = summary.groupBy("_b").applyInPandas(fold, "_b string, p long, run long, _c0 long, _g0 long")

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_nr")
        upto, hop = next_resets(pdf["_w"].to_numpy(np.int64), pdf["_r"].to_numpy(np.int64), budget)
        opens = np.zeros(len(pdf), dtype=np.int64)
        at = int(np.searchsorted(upto, budget - int(pdf["_c0"].iloc[0]), side="left"))
        while at < len(pdf):  # one step per batch
            opens[at] = 1
            at = int(hop[at])
        return pd.DataFrame({"_nr": pdf["_nr"], "batch": int(pdf["_g0"].iloc[0]) + np.cumsum(opens)})

    numbers = (chunked.select(*cols).join(starts, ["_b", "p", "run"]).groupBy("_b", "p", "run")
               .applyInPandas(replay, "_nr long, batch long"))
    ordered = F.array_sort(F.collect_list(F.struct("_nr", "lib", "cd")))
    g = ranged.join(numbers, "_nr").groupBy("bucket", "batch").agg(ordered.alias("items"), F.count(F.lit(1)).alias("n"))
    return g.select("bucket", "batch", "n",
                    F.array_join(F.transform("items", lambda x: x["cd"]), sep).alias("group_cd"),
                    F.array_join(F.transform("items", lambda x: x["lib"]), sep).alias("group_lib"))
