"""Operators 2, 3, 6, 9 and 10 against plain versions on small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest_llm import BASE, make
from termspark.llm import chat, exact_dedup, mixing, quality_rules, sharding
from termspark.llm.common import staged

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def dedup_plainly(rows):
    groups = defaultdict(list)
    for at, (i, t, *_) in enumerate(rows):
        groups[t or ""].append((-1 << 62 if i is None else i, at))
    kept = {t: max(g)[0] for t, g in groups.items()}
    return sorted((str(i), str(None if kept[t or ""] == -1 << 62 else kept[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t, *_ in rows)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.length(t).cast("string")])
@pytest.mark.parametrize("scan", [True, False])
def test_exact_dedup(spark, odd_rows, tmp_path, digest, scan):
    df = make(spark, odd_rows, tmp_path if scan else None)
    out = exact_dedup.dedup(df, digest=digest, bytes_per_batch=1).collect()
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in out)
    assert got == dedup_plainly(odd_rows)
    assert Counter(r.text_sha256 for r in out if r.kept) == Counter({r.text_sha256 for r in out})
    assert all(r.doc_id == r.keep_id for r in out if r.kept)


def test_exact_dedup_keeps_columns_and_handles_empty(spark, odd_rows, tmp_path):
    df = make(spark, odd_rows, tmp_path)
    out = exact_dedup.distinct(df)
    assert out.columns == df.columns
    assert out.count() == len({t or "" for _, t, *_ in odd_rows})
    assert exact_dedup.dedup(df.limit(0)).count() == 0


def test_chat_collapse(spark):
    turns = {1: ["a", "b"], 2: ["a", "b", "c"], 3: ["a", "b", "c"], 4: ["a"], 5: ["x"], 6: ["ab"], 7: [None, "b"], 8: [""], 9: ["a", "b", "d"]}
    rows = [(c, k, "user" if k % 2 == 0 else "assistant", t, "q") for c, ts in turns.items() for k, t in enumerate(ts)]
    rows += [(None, 0, "user", "nobody", "q"), (10, None, None, "t", "q"), (11, 0, "user", "x", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, id string")
    out = {r.conv_id: r for r in chat.maximal(df).collect()}
    assert set(out) == {2, 5, 6, 7, 9, 10}
    assert (out[2].snapshots, out[5].snapshots, out[9].n_turns) == (2, 2, 3)
    assert out[2].text == "<|user|>\na\n<|end|>\n<|assistant|>\nb\n<|end|>\n<|user|>\nc\n<|end|>\n"
    assert chat.maximal(df.limit(0)).count() == 0


def test_targets_fill_up():
    sizes = {"a": 100, "b": 100, "c": 100, None: 100, "zero": 0}
    w = mixing.default_weights(list(sizes))
    assert w == {"a": 5, "b": 2, "c": 1, "zero": 5, None: 2}
    t = mixing.targets(sizes, w, 1.5, 2)
    assert t["a"] == 200 and t["zero"] == 0
    assert sum(t.values()) == pytest.approx(600) and all(t[s] <= 2 * sizes[s] for s in sizes)
    assert t["b"] == pytest.approx(2 * t["c"]) and t["b"] == t[None]


def test_splitting_tree_is_exact_and_repeatable():
    counts = [1000, 50, 0, 3]
    for shards in (1, 2, 7, 64):
        quotas = mixing.splitting_tree(counts, shards, 1)
        assert [sum(q[i] for q in quotas) for i in range(4)] == counts
        sizes = [sum(q) for q in quotas]
        assert max(sizes) - min(sizes) <= 1
        assert quotas == mixing.splitting_tree(counts, shards, 1)
    draws = [mixing.splitting_tree([60, 40], 2, s)[0][0] for s in range(300)]  # mean 30, variance 6.06
    assert abs(sum(draws) / 300 - 30) < 0.6 and 4.5 < sum((d - 30) ** 2 for d in draws) / 300 < 8


def test_mix(spark, odd_rows, tmp_path):
    rows = odd_rows + [(100 + i, "w " * (1 + i % 37), "en", f"s{i % 4}") for i in range(900)]
    df = make(spark, rows, tmp_path)
    plan = mixing.plan(df, shard_words=2000).collect()
    assert len(plan) == len(rows)
    size = lambda t: len(WORD.findall(t or ""))
    assert Counter((r.doc_id, r["size"]) for r in plan) == Counter((i, size(t)) for i, t, *_ in rows)
    by = defaultdict(list)
    for r in plan:
        by[r.mix_source].append(r)
        assert 0 <= r.copies <= 2 and len(r.shards) == r.copies
    for rs in by.values():
        assert all(r.source_size == sum(x["size"] for x in rs) for r in rs)
        taken = sum(x["size"] * x.copies for x in rs)
        assert abs(taken - rs[0].target) <= max(x["size"] for x in rs) / 2 + 1
        assert rs[0].target <= 2 * rs[0].source_size
    assert sum(rs[0].target for rs in by.values()) == pytest.approx(1.5 * sum(r["size"] for r in plan))
    again = mixing.plan(df.repartition(7), shard_words=2000).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    out = mixing.mix(df, shard_words=2000)
    assert out.columns == df.columns + ["mix_shard_"]
    assert {(r._at, r._copy, r.mix_shard) for r in out.collect()} == {("a", "b", "c")}
    assert sorted(map(str, mixing.mix(df.repartition(5), shard_words=2000).collect())) == sorted(map(str, out.collect()))
    assert out.count() == sum(r.copies for r in plan)
    assert mixing.plan(df.limit(0)).count() == 0


def repeat_words_plainly(w):
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    return len({j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)})


def test_quality_rules(spark, odd_rows):
    clean = [(100 + i, " ".join(f"some{(i * 31 + k * 17) % 997} word{k}" for k in range(40)), "en", f"s{i % 2}") for i in range(260)]
    junk = [(900, " ".join(f"a{k}###$$$%%%" for k in range(90)), "en", "s0"), (901, "x y z " * 60, "en", "s1"),
            (902, "the same line of words here\n" * 3 + BASE, "en", "s0"), (903, " ".join("q" * 60 + str(k) for k in range(70)), "en", "s1")]
    rows = odd_rows + clean + junk
    out = {r.doc_id: r for r in quality_rules.judge(make(spark, rows)).collect() if r.doc_id is not None}
    for i, t, *_ in rows:
        if i is None:
            continue
        w, lines = WORD.findall(t or ""), [x for x in (t or "").split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeat_words_plainly(w))
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    assert all(out[i].kept for i, *_ in clean)
    assert not any(out[i].kept for i in (900, 901, 903))
    assert quality_rules.judge(make(spark, rows).limit(0)).count() == 0


def test_sketches_decide(spark):
    """The same text stays where its rates are usual and goes where they are not; a junk source does not raise
    its own limit beyond twice its language's; no constant does the same."""
    def text(i, symbols):
        return " ".join(f"word{(i * 31 + k * 17) % 997}{'#' * (k < symbols)}" for k in range(60))
    rows = [(k, text(k, 3 + k % 3), "code", f"s{k % 2}") for k in range(220)]                       # symbols everywhere
    rows += [(1000 + k, text(k, 0), "en", "clean") for k in range(240)]                             # symbols nowhere
    rows += [(2000 + k, text(k, 3 + k % 3), "en", "junk") for k in range(25)]                       # usual in code, not here
    rows += [(3000 + k, text(k, 40 if k < 80 else 1), "mixed", "junk") for k in range(105)]        # most of a source is junk
    rows += [(4000 + k, text(k, k % 2), "mixed", f"good{k % 9}") for k in range(1000)]
    rows += [(9000, text(5, 59), "code", "s0"), (9001, text(5, 2), "en", "clean")]
    kept = {r.doc_id: r.kept for r in quality_rules.judge(make(spark, rows)).collect()}
    assert all(kept[k] for k in range(220)) and not kept[9000]
    assert all(kept[1000 + k] for k in range(240)) and not any(kept[2000 + k] for k in range(25))
    assert kept[9001]  # two stray symbols reject nothing
    assert not any(kept[3000 + k] for k in range(80)) and all(kept[4000 + k] for k in range(1000))
    limits = quality_rules.thresholds(quality_rules.sketches(staged(quality_rules.measures(make(spark, rows)), "test"))).collect()
    assert len({r.hi_n_symbols for r in limits}) >= 3


def test_sketch_merges_and_bounds_quantiles(spark):
    df = spark.range(1, 5001).selectExpr("id as n_words", "id % 7 as lang", "'s' as source", "id * 5 as word_chars", "0L as n_symbols",
                                         "0L as n_dup_lines", "0L as n_repeat_words", "id").where("n_words >= 50")
    both = quality_rules.sketches(df)
    halves = quality_rules.sketches(df.where("id % 2 = 0")).unionByName(quality_rules.sketches(df.where("id % 2 = 1")))
    key = ["lang", "source", "measure", "top"]
    merged = halves.groupBy(*key).agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, merged.collect()))


def test_sharding(spark, odd_rows):
    rows = odd_rows + [(1000 + i, f"t{i}" * (i % 5), "en", "a") for i in range(3000)]
    df = make(spark, rows)
    out = sharding.shard(df, [1.0] * 8).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    grown = sharding.shard(df, [1.0] * 9).collect()
    assert {r.doc_id: r.grown_shard for r in out} == {r.doc_id: r.shard for r in grown}
    heavy = Counter(r.shard for r in sharding.shard(df, [1.0, 3.0, 0.0]).collect())
    assert 0.68 < heavy[1] / len(rows) < 0.82 and 2 not in heavy
    assert sharding.shard(df.limit(0), [1.0]).count() == 0
