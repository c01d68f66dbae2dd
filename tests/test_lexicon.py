"""Lexicon operators on inline frames; batching against a plain sequential walk."""

import random

from termspark.operators import lexicon


def brute_batches(labels, sep=" ____ ", budget=500):
    out = {}
    for bucket in sorted({b for b, _, _ in labels}):
        rows = sorted((lib, cd) for b, cd, lib in labels if b == bucket)
        count, group = 0, 0
        for lib, cd in rows:
            nchar = len(lib) + len(sep)
            count += nchar + len(sep)
            if count >= budget:
                group += 1
                count = nchar
            out.setdefault((bucket, group), []).append((lib, cd))
    return {(b, g): (len(v), sep.join(cd for _, cd in v), sep.join(lib for lib, _ in v)) for (b, g), v in out.items()}


def test_batches_match_sequential_walk(spark):
    rnd = random.Random(7)
    labels = [(f"b{rnd.randint(0, 3)}", f"c{i}", "w" * rnd.randint(1, 180)) for i in range(700)]
    labels += [("big", f"L{i}", "x" * 600) for i in range(3)]  # labels over the budget
    df = spark.createDataFrame(labels, "bucket string, cd string, lib string")
    got = {(r.bucket, r.batch): (r.n, r.group_cd, r.group_lib)
           for r in lexicon.batches(df, "bucket", ["lib", "cd"], partitions=9).collect()}
    assert got == brute_batches(labels)


def test_groups_and_bilingual(spark):
    d = spark.createDataFrame([("g1", "b"), ("g1", "a"), ("g1", "a"), ("g2", "z")], "_c0 string, _c1 string")
    assert [(r.group_key, r.result) for r in lexicon.groups(d).collect()] == [("g1", "a,b")]
    pairs = spark.createDataFrame([("pomme_de_terre", "potato", 1), ("pomme_de_terre", "spud", 2), (" ", "x", 1)],
                                  "fr string, en string, rank int")
    out = lexicon.bilingual(pairs).collect()
    assert [(r.word, r.rule) for r in out] == [("pomme de terre", "pomme de terre => potato,spud")]


def test_translate_word_by_word(spark):
    df = spark.createDataFrame([(1, "Les maladies chroniques, fatiguées.")], "id int, t string")
    lex = spark.createDataFrame([("le", "the", 1), ("maladie", "disease", 1), ("maladie", "illness", 2)],
                                "word string, lemma string, rank int")
    out = lexicon.translate(df, "id", "t", lex).first()
    # 'Les' (<= 4 chars) unchanged; 'maladies' -> 'maladie' -> disease; 'fatiguées' -> 'fatiguer'
    assert out.translation == " Les disease chronique , fatiguer ."


def test_code_mapping_both_directions_and_two_hop(spark):
    import datetime as dt
    local = spark.createDataFrame([(10, "A01"), (11, "B2")], "concept_id long, concept_code string")
    std = spark.createDataFrame([(1, "A.01"), (2, "B.2"), (3, "C.3")], "concept_id long, concept_code string")
    pairs = lexicon.map_codes(local, std)
    assert sorted((r.concept_id_1, r.concept_id_2) for r in pairs.collect()) == [(10, 1), (11, 2)]
    edges = lexicon.both_directions(pairs, dt.date(2025, 1, 1))
    assert edges.count() == 4
    rel = spark.createDataFrame([(1, 5, "Is a"), (1, 10, "Mapped from")], "concept_id_1 long, concept_id_2 long, relationship_id string")
    hop = sorted(tuple(r) for r in lexicon.two_hop(edges, rel).collect())
    assert hop == [(10, 5, "Is a")]  # 10 -> 1 -> 5; 10 -> 1 -> 10 dropped (a == c)


def test_batches_null_keys_budgets_and_chunks(spark):
    rnd = random.Random(11)
    labels = [(rnd.choice(["a", "b", None]), f"c{i}", None if i % 41 == 0 else "w" * rnd.randint(1, 400)) for i in range(400)]
    df = spark.createDataFrame(labels, "bucket string, cd string, lib string")
    key = lambda b: "" if b is None else "=" + b
    for budget, parts, chunk in ((300, 3, 10), (500, 7, 50), (1000, 5, 7), (1000, 2, 10_000)):
        got = {(key(r.bucket), r.batch): r.n for r in
               lexicon.batches(df, "bucket", ["cd"], budget=budget, partitions=parts, chunk_rows=chunk).collect()}
        want = {}
        for b in ("a", "b", None):
            count, group = 0, 0
            for _, cd, lib in sorted((x for x in labels if x[0] == b), key=lambda x: x[1]):
                n = len(lib or "") + 6
                count += n + 6
                if count >= budget:
                    group, count = group + 1, n
                want[key(b), group] = want.get((key(b), group), 0) + 1
        assert got == want
        assert sum(got.values()) == len(labels)


def test_chunk_summary_against_steps():
    import numpy as np
    rnd = random.Random(5)
    for budget in (300, 500, 1000):
        size = np.array([rnd.randint(0, 700) for _ in range(60)])
        w, r = size + 12, size + 6
        end, resets = lexicon.chunk_summary(w, r, budget)
        for s in range(budget + 1):
            c, k = s, 0
            for a, b in zip(w, r):
                c += a
                if c >= budget:
                    k, c = k + 1, b
                c = min(c, budget)
            assert (end[s], resets[s]) == (c, k)


def test_group_members_keep_commas(spark):
    d = spark.createDataFrame([("g", "a, b"), ("g", "c"), ("h", "x")], "_c0 string, _c1 string")
    assert sorted(r.member for r in lexicon.group_members(d).collect()) == ["a, b", "c"]
