"""Retrieval: BM25 against a hand computation, dismax, weights, boosts, paging, facets."""

import math

from pyspark.sql import functions as F

from termspark.operators import search

DOC = ("concept_id long, concept_name_en string, concept_synonym_name_en array<string>, "
       "concept_mapped_name_en array<string>, concept_name_fr string, concept_synonym_name_fr array<string>, "
       "concept_mapped_name_fr array<string>, concept_name_fr_en string, concept_synonym_name_fr_en array<string>, "
       "concept_mapped_name_fr_en array<string>, value_avg double, frequency int, is_mapped string")


def docs(spark):
    rows = [(1, "heart attack", ["cardiac arrest"], None, None, None, None, None, None, None, 5.0, 2, "OMOP S"),
            (2, "heart", None, ["heart disease"], None, None, None, None, None, None, None, 4, "OMOP R"),
            (3, "lung", None, None, None, None, None, None, None, None, 1.0, 1, "OMOP S")]
    return spark.createDataFrame(rows, DOC)


def bm25(tf, dl, avgdl, n, df):
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    return idf * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))


def test_index_bm25_by_hand(spark):
    ix = search.index(docs(spark), groups=["en"])
    got = {(r.concept_id, r.field, r.token): r.bm25 for r in ix.collect()}
    # concept_name_en: docs 1 (2 tokens), 2 (1), 3 (1): avgdl 4/3; 'heart' df 2
    assert math.isclose(got[(1, "concept_name_en", "heart")], bm25(1, 2, 4 / 3, 3, 2))
    assert math.isclose(got[(2, "concept_name_en", "heart")], bm25(1, 1, 4 / 3, 3, 2))


def test_rank_dismax_weights_boost_paging(spark):
    d = docs(spark)
    ix = search.index(d, groups=["en"])
    q = spark.createDataFrame([(100, "heart", 5.0, 2.0), (101, "heart", 5.0, 2.0), (102, None, 0.0, 0.0)],
                              "query_id long, text string, value_avg double, frequency double")
    groups = {"en": "text"}
    top = search.rank(q, ix, d, groups=groups, k=10).collect()
    by_q = {}
    for r in top:
        by_q.setdefault(r.query_id, []).append((r.rank, r.concept_id))
    assert sorted(by_q[100]) == sorted(by_q[101]) == [(1, 2), (2, 1)]  # shorter name scores higher; identical labels rank alike
    assert 102 not in by_q
    # weights: name x2 only changes magnitudes here; dismax keeps the best field per term
    s = {r.concept_id: r.score for r in search.scores(q.filter("query_id = 100"), ix, d, groups=groups).collect()}
    assert s[2] > s[1] > 0
    # value boost 1 - |value_avg - 5|: doc 1 (5.0) keeps its score, doc 2 (missing -> 0) gets -4x
    b = {r.concept_id: r.score for r in search.scores(q.filter("query_id = 100"), ix, d, groups=groups,
                                                         boost="value").collect()}
    assert math.isclose(b[1], s[1]) and math.isclose(b[2], -4 * s[2])
    page2 = search.rank(q.filter("query_id = 100"), ix, d, groups=groups, k=1, page=2).collect()
    assert [(r.rank, r.concept_id) for r in page2] == [(2, 1)]
    f = search.facets(q.filter("query_id = 100"), ix, d, ["is_mapped"], groups=groups).collect()
    assert sorted((r["value"], r["count"]) for r in f) == [("OMOP R", 1), ("OMOP S", 1)]
    n = search.hit_counts(q, ix, d, groups=groups).collect()
    assert sorted((r.query_id, r.num_found) for r in n) == [(100, 2), (101, 2)]


def test_filter_and_match_all(spark):
    d = docs(spark)
    ix = search.index(d, groups=["en"])
    q = spark.createDataFrame([(1, "heart")], "query_id long, text string")
    out = search.rank(q, ix, d, groups={"en": "text"}, doc_filter=F.col("is_mapped").endswith(" S")).collect()
    assert [r.concept_id for r in out] == [1]
    ma = search.match_all(d, q, k=2).collect()
    assert [(r.rank, r.concept_id, r.score) for r in ma] == [(1, 1, 1.0), (2, 2, 1.0)]


def test_expand_tokens_group_and_rewrite(spark):
    groups = spark.createDataFrame([("g", "heart attack"), ("g", "myocardial infarction")], "group_key string, member string")
    rewrites = spark.createDataFrame([("MI", "myocardial infarction")], "term string, replacement string")
    q = spark.createDataFrame([(1, "acute heart attack"), (2, "old MI"), (3, "nothing")], "k long, text string")
    got = {}
    for r in search.expand_tokens(q, "k", "text", "en", groups=groups, rewrites=rewrites).collect():
        got.setdefault(r.k, set()).add(r.token)
    assert got[1] == {"acute", "heart", "attack", "myocardial", "infarction"}  # multi-word group member matched
    assert got[2] == {"old", "myocardial", "infarction"}                       # 'mi' rewritten away
    assert got[3] == {"nothing"}


def test_index_follows_its_input(spark, small_dir, tmp_path, monkeypatch):
    """A table replaced in the folder is searched; an unchanged folder is not indexed again."""
    import os
    import shutil
    from termspark.plans import registry
    folder = f"{tmp_path}/data"
    os.makedirs(folder)
    for name in os.listdir(small_dir):  # contents without modes: the test data are read-only
        shutil.copyfile(f"{small_dir}/{name}", f"{folder}/{name}")
    monkeypatch.setattr(registry.documents, "build", lambda t: t.part.select(F.col("p_partkey").alias("concept_id")))
    monkeypatch.setattr(registry.search, "positional_postings", lambda docs: docs)
    monkeypatch.setattr(registry.search, "index", lambda docs, positions: docs)
    monkeypatch.setattr(registry.search, "phrase_lists", lambda positions: positions)
    before = registry.persisted_index(spark, folder)[3]
    assert registry.persisted_index(spark, folder)[3] is before
    more = spark.read.parquet(f"{small_dir}/part.parquet").withColumn("p_partkey", F.col("p_partkey") + 10 ** 6)
    more.write.mode("overwrite").parquet(f"{folder}/part.parquet")
    assert registry.persisted_index(spark, folder)[3].agg(F.min("concept_id")).first()[0] >= 10 ** 6


def test_expansion_does_not_grow_with_the_rules_of_a_term(spark):
    """Many rules of one term and few different tokens: the tokens once, and no side of a join that
    grows with labels or rules is broadcast."""
    rules = spark.range(600).select(F.lit("rouge petit").alias("term"), F.concat_ws(" ", F.lit("small"), (F.col("id") % 3).cast("string")).alias("replacement"))
    labels = spark.range(300).select(F.col("id").alias("k"), F.lit("rouge petit anneau").alias("text"))
    out = search.expand_tokens(labels, "k", "text", "fr_en", rewrites=rules)
    assert {r.token for r in out.where("k = 7").collect()} == {"small", "0", "1", "2", "anneau"} and out.count() == 1500
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_boost_thresholds_change_nothing(spark, monkeypatch):
    """Ranked with thresholds from a share of the concepts as from all; hits below them are not ranked."""
    rows = [(i, "heart attack" if i % 3 else "heart", None, None, None, None, None, None, None, None, None if i % 7 == 0 else float(i % 50), i % 4, "OMOP S")
            for i in range(600)]
    d = spark.createDataFrame(rows, DOC)
    ix = search.index(d, groups=["en"])
    q = spark.createDataFrame([(i, "heart attack" if i % 2 else "heart", float(i), 2.0) for i in range(12)],
                              "query_id long, text string, value_avg double, frequency double")
    for kind in ("value", "frequency", "numerics"):
        every = search.scores(q, ix, d, groups={"en": "text"}, boost=kind)
        some = search.scores(q, ix, d, groups={"en": "text"}, boost=kind, best=10)
        got = sorted((r.query_id, r["rank"], r.concept_id, round(r.score, 6)) for r in search.rank(q, ix, d, groups={"en": "text"}, boost=kind).collect())
        assert got == sorted((r.query_id, r["rank"], r.concept_id, round(r.score, 6)) for r in search.top_k(every, 10).collect())
        assert len(got) == 120 and (kind != "value" or some.count() < every.count() / 2)


def test_phrase_ranking_is_that_of_all_hits(spark):
    """Concepts with and without the phrase, more of both than are ranked."""
    words = ["heart", "attack", "acute", "lung", "old"]
    rows = [(i, " ".join([words[i % 5], words[i // 5 % 5], words[i // 25 % 5], words[i % 3]]), None, None, None, None, None, None, None, None, 1.0, 1, "OMOP S") for i in range(250)]
    d = spark.createDataFrame(rows, DOC)
    positions = search.positional_postings(d, ["en"])
    ix = search.index(d, ["en"], positions=positions)
    lists = search.phrase_lists(positions)
    q = spark.createDataFrame([(1, "acute heart attack"), (2, "old lung heart attack"), (3, "lung")], "query_id long, text string")
    groups = {"en": "text"}
    ts = search.text_scores(q, "query_id", ix, groups)
    ps = search.phrase_scores(q, "query_id", *lists, groups)
    every = ts.join(ps, ["query_id", "concept_id"], "left").selectExpr("query_id", "concept_id", "score + coalesce(pscore, 0) as score")
    want = sorted((r.query_id, r["rank"], r.concept_id, round(r.score, 6)) for r in search.top_k(every, 5).collect())
    got = search.rank_with_phrases(q, ix, *lists, k=5, groups=groups).collect()
    assert sorted((r.query_id, r["rank"], r.concept_id, round(r.score, 6)) for r in got) == want and ps.count() > 10


def test_index_is_built_in_one_shuffle(spark):
    """Token places, counts and field lengths come from one shuffle of the values."""
    plan = search.token_places(docs(spark), ["en"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(concept_id" in plan
