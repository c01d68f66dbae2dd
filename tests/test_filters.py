"""Filters as rows against a plain evaluation of every label and document."""

import random

from pyspark.sql import functions as F

from termspark.operators import filters, search, topk
from test_search import DOC


def test_label_filters(spark):
    rng = random.Random(4)
    names = ["heart attack", "heart failure", "lung disease", "heart"]
    rows = [(i, rng.choice(names), rng.choice([None, ["cardiac arrest", "heart"]]), None, None, None, None, None, None, None,
             rng.choice([None, 1.0, 5.0, 9.0]), rng.choice([None, 1, 2, 3]), rng.choice([None, "OMOP S", "OMOP R"])) for i in range(40)]
    docs = spark.createDataFrame(rows, DOC)
    idx = search.index(docs, groups=["en"])
    made, plain = [], {}
    for f in range(25):
        clauses = []
        for c in range(rng.randint(1, 3)):
            lits = []
            for _ in range(rng.randint(1, 2)):
                neg, kind = rng.random() < 0.4, rng.choice(["enum", "num", "text", "list"])
                if kind == "enum":
                    v = rng.choice(["OMOP S", "OMOP R", "none such"])
                    made.append((f, c, neg, "enum", "is_mapped", v, None, None))
                    lits.append((neg, lambda d, v=v: d[12] == v))
                elif kind == "list":
                    made.append((f, c, neg, "enum", "concept_synonym_name_en", "cardiac arrest", None, None))
                    lits.append((neg, lambda d: "cardiac arrest" in (d[2] or [])))
                elif kind == "num":
                    lo, hi = rng.choice([(None, 2.0), (2.0, None), (1.0, 2.0), (5.0, 1.0)])
                    made.append((f, c, neg, "num", "frequency", None, lo, hi))
                    lits.append((neg, lambda d, lo=lo, hi=hi: d[11] is not None and (lo is None or d[11] >= lo) and (hi is None or d[11] <= hi)))
                else:
                    v = rng.choice(["Attacks", "heart attack", "the lung's"])
                    made.append((f, c, neg, "text", "concept_name_en", v, None, None))
                    want = {"Attacks": {"attack"}, "heart attack": {"heart", "attack"}, "the lung's": {"lung"}}[v]
                    lits.append((neg, lambda d, want=want: want <= set(d[1].split())))
            clauses.append(lits)
        plain[f] = clauses
    queries = spark.createDataFrame([(q, "heart disease", q if q < 25 else None) for q in range(30)], "query_id long, text string, filter_id long")
    literals = spark.createDataFrame(made, filters.LITERALS)
    got = {}
    for r in filters.rank_filtered(queries, idx, docs, literals, k=100, groups={"en": "text"}).collect():
        got.setdefault(r.query_id, {})[r.concept_id] = r.score
    every = got[25]
    assert got[29] == every and len(every) > 20
    for f, clauses in plain.items():
        passes = {d[0] for d in rows if all(any(neg != bool(lit(d)) for neg, lit in lits) for lits in clauses)}
        assert got.get(f, {}) == {i: s for i, s in every.items() if i in passes}, f


def test_hits_are_dealt_out_by_their_number(spark, monkeypatch):
    """Partitions of the hits follow their number, whatever their bytes; the rows stay the same."""
    docs = spark.createDataFrame([(i, "heart attack", *[None] * 9, i % 3, "OMOP S") for i in range(200)], DOC)
    idx = search.index(docs, groups=["en"])
    queries = spark.createDataFrame([(q, "heart attack", q) for q in range(4)], "query_id long, text string, filter_id long")
    literals = spark.createDataFrame([(1, 1, False, "num", "frequency", None, 1.0, 1.0)], filters.LITERALS)
    kw = dict(k=3, groups={"en": "text"})
    plain = sorted(tuple(r) for r in filters.rank_filtered(queries, idx, docs, literals, **kw).collect())
    monkeypatch.setattr(topk, "HITS_PER_PARTITION", 10)
    seen, real = [], filters.passing
    monkeypatch.setattr(filters, "passing", lambda hits, *rest: seen.append(hits.rdd.getNumPartitions()) or real(hits, *rest))
    assert sorted(tuple(r) for r in filters.rank_filtered(queries, idx, docs, literals, **kw).collect()) == plain
    assert seen == [80] and len(plain) == 12  # 200 concepts for each of four filters


def test_single_filter_functions(spark):
    docs = spark.createDataFrame([(1, "a b", 1.0, "x"), (2, "heart attacks", 5.0, None), (3, None, None, "y")], "id int, name string, v double, e string")
    ids = lambda c: [r.id for r in docs.filter(c).orderBy("id").collect()]
    assert ids(search.f_enum("e", ["x", "y"])) == [1, 3]
    assert ids(search.f_num("v", 1, 4)) == [1] and ids(search.f_num("v", lo=2)) == [2] and ids(search.f_num("v")) == [1, 2, 3]
    assert ids(search.f_text("name", "Attack")) == [2]
    assert ids(~F.coalesce(search.f_text("name", "Attack"), F.lit(False))) == [1, 3]
