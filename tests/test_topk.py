"""Exact top-k by score bounds against scoring everything."""

import random

import pytest
from pyspark.sql import functions as F

from termspark.operators import search, topk


def frames(spark, seed, concepts=400, labels=60):
    """Postings with rare and common tokens, one token in every concept, ties, and labels with repeated, unknown and
    only common tokens."""
    rng = random.Random(seed)
    tokens = [f"t{i}" for i in range(60)]
    postings = []
    for c in range(concepts):
        postings.append(("en", "everywhere", c, 0.05 + 0.001 * (c % 3)))
        for t in set(rng.choices(tokens, weights=[1 / (i + 1) for i in range(60)], k=8)):
            postings.append(("en", t, c, round(rng.choice([0.5, 1.0, rng.random() * (2 + int(t[1:]) / 10)]), 3)))
        if c % 5 == 0:
            postings.append(("fr", "t1", c, 1.5))
    terms = [(q, "en", t, 1 + (q % 3 == 0)) for q in range(labels) for t in set(rng.choices(tokens, k=1 + q % 6)) | {"everywhere"}]
    terms += [(q, "fr", "t1", 1) for q in range(0, labels, 4)] + [(9000, "en", "everywhere", 1), (9001, "en", "unknown", 1), (9002, "en", "t59", 2)]
    return (spark.createDataFrame(terms, "q long, group string, token string, qtf long"),
            spark.createDataFrame(postings, "group string, token string, concept_id long, fs double"))


def ranked(hits, k):
    return sorted((r.q, r["rank"], r.concept_id, round(r.score, 6)) for r in search.top_k(hits, k, 1, "q").collect())


@pytest.mark.parametrize("seed, k, few", [(1, 10, True), (2, 1, True), (3, 25, False)])
def test_bounds_change_nothing(spark, seed, k, few, monkeypatch):
    if not few:  # the way without a broadcast
        monkeypatch.setattr(topk, "BROADCAST_TERMS", 0)
    monkeypatch.setattr(topk, "HITS_PER_PARTITION", 500)
    terms, postings = frames(spark, seed)
    every = topk.all_scores(terms, "q", postings)
    some = topk.best(terms, "q", postings, k, all_hits=0)
    assert ranked(some, k) == ranked(every, k)
    assert ranked(topk.best(terms, "q", postings, k), k) == ranked(every, k)


def test_bounds_spare_most_hits(spark):
    """A token that every concept has costs next to nothing."""
    terms, postings = frames(spark, 5, concepts=1500)
    terms = terms.where("q < 9000")
    scored, every = topk.best(terms, "q", postings, 10, all_hits=0).count(), topk.all_scores(terms, "q", postings).count()
    assert every >= 60 * 1500 and scored < every / 10


def test_hits_are_summed_where_they_arise(spark):
    """No exchange between the join of labels and postings and the sums."""
    terms, postings = frames(spark, 1)
    idx = postings.select("group", F.lit("concept_name_en").alias("field"), "token", "concept_id", F.col("fs").alias("bm25"))
    plan = topk.all_scores(terms, "q", topk.fold(idx, ["en", "fr"]))._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "BroadcastHashJoin" in line or "Exchange hashpartitioning" in line]
    assert "BroadcastHashJoin" in lines[0] and sum("Exchange hashpartitioning" in line for line in lines) == 1
    assert "hashpartitioning(concept_id" in plan


def test_concepts_that_labels_cannot_tell_apart_are_scored_once(spark, monkeypatch):
    """Many concepts with the same tokens, all of them common: what is scored and kept does not grow with them."""
    monkeypatch.setattr(topk, "HITS_PER_PARTITION", 500)
    seen = []
    real = topk._dealt
    monkeypatch.setattr(topk, "_dealt", lambda rows, terms: (seen.append(rows.count()), real(rows, terms))[1])
    terms = spark.createDataFrame([(q, "en", f"t{t}", 1) for q in range(8) for t in (q, q + 1, 9)], "q long, group string, token string, qtf long")
    for n in (300, 1200):
        postings = spark.createDataFrame([("en", t, c, 1.0 + c % 2) for c in range(n) for t in (f"t{c % 9}", "t9", f"own{c}")],
                                         "group string, token string, concept_id long, fs double")
        some = topk.best(terms, "q", postings, 10, all_hits=0)
        assert ranked(some, 10) == ranked(topk.all_scores(terms, "q", postings), 10)
        assert some.count() <= 8 * 10 * 10
    assert max(seen) <= 18


def test_other_tokens_are_added_without_a_shuffle(spark):
    """Hits meet the label's other tokens in their own row: the join with them is no exchange of hits."""
    terms, postings = frames(spark, 5)
    plan = topk.best(terms, "q", postings, 10, all_hits=0)._jdf.queryExecution().executedPlan().toString()
    assert "more" not in plan and "aggregate(want" in plan


def test_postings_are_dealt_out_by_their_number(spark, monkeypatch):
    """A task sums up a bounded number of hits, and gets a bounded number of postings, on tables of any size."""
    rows = [("en", "concept_name_en", t, c, 1.0) for c in range(100) for t in ("a", "b")]
    idx = spark.createDataFrame(rows, "group string, field string, token string, concept_id long, bm25 double")
    terms = spark.createDataFrame([(q, "en", "a", 1) for q in range(5)], "q long, group string, token string, qtf long")
    monkeypatch.setattr(topk, "HITS_PER_PARTITION", 2)
    assert topk.fold(idx, ["en"], terms=terms).rdd.getNumPartitions() == 50
    postings = topk.fold(idx, ["en"], terms=terms, all_hits=True)
    assert postings.rdd.getNumPartitions() == 250
    assert topk.all_scores(terms, "q", postings).count() == 500
