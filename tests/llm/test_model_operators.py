"""Operators 1, 4, 5, 7 and 8 and the pipeline on small tables: brute force, round trips
and held-out accuracy."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

import corpus_pipeline
from conftest_llm import BASE, LONG, make
from termspark.llm import langid, ngram_join, ordinal_quality, packing, url_filter

TOKENIZER = "byte_bpe_50k.json"


def plain_sets(text, width=5):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    w = [x for x in w.translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if x]
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def plain_join(rows):
    sets = [plain_sets(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (k, *_) in enumerate(rows):
        if k is not None:
            least[find(i)].append(k)
    return sorted((str(k), len(sets[i]), str(min(least[find(i)], default=k))) for i, (k, *_) in enumerate(rows))


def joined(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.join(df).collect())


def test_join_odd_rows(spark, odd_rows):
    assert joined(make(spark, odd_rows)) == plain_join(odd_rows)
    assert joined(make(spark, odd_rows).limit(0)) == []


def near_rows(seed, n=220):
    """Chains and families of near copies of many sizes, at and around the threshold."""
    rng, rows = random.Random(seed), []
    passage = [f"p{k}" for k in range(30)]
    for f in range(n // 10):
        size = rng.choice([3, 5, 6, 7, 8, 12, 20, 40, 90, 200])
        base = [f"f{f}w{rng.randrange(50 if f % 5 else 5)}" for _ in range(size)]
        for _ in range(10):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, size // 12))):
                at = rng.randrange(len(w))
                w[at:at + rng.randrange(2)] = [f"x{rng.randrange(10 ** 6)}"] * rng.randrange(1, 3)
            if rng.random() < 0.2:
                w += passage
            if rng.random() < 0.3:
                base = w  # chains
            rows.append((len(rows), " ".join(w), "en", "a"))
    return rows


@pytest.mark.parametrize("two", [False, True])
def test_join_brute_force(spark, monkeypatch, two):
    """Both ways of the cost-based allocation find every link."""
    if two:
        monkeypatch.setattr(ngram_join, "PAIR_COST", 1e12)
    rows = near_rows(3)
    assert joined(make(spark, rows)) == plain_join(rows)


@pytest.mark.parametrize("two", [False, True])
def test_keys_meet_whenever_sets_link(two):
    rng = np.random.default_rng(5)
    ends = ngram_join.bands()
    schemes = ngram_join.allocate(ends, {k: 10 ** 9 if two else 1 for k in range(60)})
    assert (schemes[12][2] < 10) == two
    for n in [3, 4, 5, 7, 10, 15, 20, 27, 48, 113, 114, 500, 2000]:
        for _ in range(60):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            drop = int(rng.integers(0, n // 4 + 1))
            most = ngram_join.most_apart(n, n)
            add = int(rng.integers(0, most + 1))
            b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if len(a) != len(b) or drop:
                if 100 * both >= 75 * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
                    x, y = (ngram_join.index_keys(s, ends, schemes) for s in (a, b))
                    assert len(np.intersect1d(x, y)), (n, drop, add)
                    assert ngram_join.least_apart(ngram_join.sketch(a), ngram_join.sketch(b)) <= len(np.setxor1d(a, b))


def test_blocks_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    monkeypatch.setattr(ngram_join, "KEYS_PER_ROW", 4)
    rows = near_rows(8, 120)
    assert joined(make(spark, rows)) == plain_join(rows)


def test_parts_grow_with_the_table(spark, monkeypatch):
    """A part keeps its number of keys, however large the table is."""
    ends = ngram_join.bands()
    schemes = ngram_join.allocate(ends, {})
    text = " ".join(f"w{i}" for i in range(504))
    h = ngram_join.shingles(text)
    band = int(np.searchsorted(ends, len(h), side="right")) - 1
    keys = len(ngram_join.index_keys(h, ends, schemes))
    for docs in (10, 10 ** 7, 10 ** 9):
        parts = ngram_join.key_parts(ends, {band: docs}, schemes, 8)
        assert parts >= 8 and docs * keys / parts <= ngram_join.KEYS_PER_PART
    monkeypatch.setattr(ngram_join, "KEYS_PER_PART", 300)
    rows = near_rows(11, 120)
    assert joined(make(spark, rows)) == plain_join(rows)


def test_one_part_is_held_at_a_time():
    """What a part has found is handed on before the next but one batch is asked for."""
    ends = ngram_join.bands()
    schemes = ngram_join.allocate(ends, {})
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(words), " ".join(words[:150] + ["x"] + words[151:])]
    docs = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(texts)], names=["key", "text"])
    sent = pa.Table.from_batches(list(ngram_join._map_side(5, 75, 6, ends, schemes)(iter([docs]))))
    blocks = sent.filter(pc.equal(sent["kind"], 0)).sort_by("part").combine_chunks().to_batches(max_chunksize=1)
    assert len(blocks) == 6
    asked = []

    def feed():
        for b in blocks:
            asked.append(b)
            yield b

    found = ngram_join._reduce_side()(feed())
    first = next(found)
    assert first.num_rows and len(asked) < len(blocks)
    pairs = [first, *found]
    assert {(r["center"], *r["members"]) for b in pairs for r in b.to_pylist()} == {
        tuple(sorted((ngram_join.set_id(ngram_join.shingles(t)) for t in texts), key=lambda x: x % (1 << 64)))}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    out = {r.id: r.root for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, 100: 90, 90: 90, 95: 90}


def test_representatives_keep_one_of_each(spark, odd_rows, tmp_path):
    df = make(spark, odd_rows, tmp_path)
    out = ngram_join.representatives(df)
    assert out.columns == df.columns
    kept = Counter(t for _, t, *_ in [tuple(r) for r in out.collect()])
    assert kept[LONG] == 1 and sum(kept[t] for t in (BASE, BASE.upper(), BASE + " tail")) == 1


# ---- packing

def test_encoder_equals_the_tokenizer(odd_rows):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(P.path(TOKENIZER))
    encode = packing.encoder(P.path(TOKENIZER))
    texts = [t or "" for _, t, *_ in odd_rows] + ["a  b", " x", "x ", "a\n\nb", "a\tb c", "it's <|endoftext|> 12 z", "\n", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "x \n<|endoftext|> y <|endoftext", "a\u00a0b c",
                                                 "don't  \n x\r\ny z", "a \nb", "x\x1cy z", "kana かな 🙂 ok", "we'll \u2028go on"]
    for t in texts:
        assert np.frombuffer(encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_assign_balances_and_fills():
    rng = random.Random(1)
    lengths = [rng.randrange(1, 3000) for _ in range(300)] + [1, 1, 1]
    pieces = packing.assign(lengths)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for d, s, n, q, o in pieces:
        by_doc[d].append((s, n)), by_seq[q].append((o, n))
    for d, n in enumerate(lengths):
        assert sum(x for _, x in by_doc[d]) == n
    full = []
    for q, parts in by_seq.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == 1024 or at & (at - 1) == 0
        full += [sum(n * n for _, n in parts)] if at == 1024 else []
    assert sum(n for *_, n, _, _ in pieces) == sum(lengths)
    assert packing.assign([]) == []


def test_pack_round_trip(spark, odd_rows):
    P = pytest.importorskip("public_tokenizers")
    df = make(spark, odd_rows)
    out = packing.pack(df, P.path(TOKENIZER), block_tokens=5000).collect()
    encode = packing.encoder(P.path(TOKENIZER))
    want = Counter((i, len(encode(t or "")) // 4 + 1) for i, t, *_ in odd_rows)
    got = defaultdict(int)
    for r in out:
        assert len(r.ids) == 4 * r.length
        got[r.doc_id, r.doc_tokens] += r.length
    assert {k: n * k[1] for k, n in want.items()} == dict(got)
    whole = sorted((r.start, r.ids) for r in out if r.doc_id == 4)
    assert b"".join(x for _, x in whole) == encode(LONG) + b"\0\0\0\0"
    spans = defaultdict(list)
    for r in out:
        spans[r.sequence_id].append((r.offset, r.length))
    for parts in spans.values():
        ends = [0] + [o + n for o, n in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and (ends[-1] == 1024 or ends[-1] & (ends[-1] - 1) == 0)
    assert packing.pack(df.limit(0), P.path(TOKENIZER)).count() == 0


# ---- url filter

URLS = [(None, ("", "", None, "allow")), ("no scheme.com/en/", ("", "", None, "allow")), ("http://A.Com/x?y", ("a.com", "/x", "com/", "allow")),
        ("http://a.com", ("a.com", "", None, None)), ("https://example.com/en/1", ("example.com", "/en/1", "example.com/en/", "block")),
        ("https://m.Example.com/en/", ("m.example.com", "/en/", "example.com/en/", "block")),
        ("https://x.www.example.com/en/a#b", ("x.www.example.com", "/en/a", "www.example.com/en/", "allow")),
        ("http://notexample.com/en/", ("notexample.com", "/en/", "com/", "allow")), ("http://a.net/es/1", ("a.net", "/es/1", "net/es/", "block")),
        ("http://a.net/EN", ("a.net", "/EN", None, None)), ("x://net/fr/", ("net", "/fr/", "net/fr/", "block")),
        ("a://b.org?c://d", ("b.org", "", None, None)), ("", ("", "", None, "allow")), ("http:///p", ("", "/p", None, None)),
        ("http://" + "h" * 9000 + ".org/" + "p" * 9000, ("h" * 9000 + ".org", "/" + "p" * 9000, None, None)),
        ("http://free-bets.example.org/en/4", ("free-bets.example.org", "/en/4", None, "block")),
        ("http://library.example.org/books/4", ("library.example.org", "/books/4", None, "allow"))]


def test_url_rules_and_model(spark):
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, (u, _) in enumerate(URLS)], "page_id long, url string, host string, rule string")
    out = {r.page_id: r for r in url_filter.judge(df).collect()}
    for i, (u, (host, path, rule, verdict)) in enumerate(URLS):
        r = out[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert url_filter.judge(df.limit(0)).count() == 0


def test_url_model_on_held_out_rows():
    rows = url_filter.read_labelled()
    hits = 0
    for fold in range(5):
        w, b = url_filter.fit([r for i, r in enumerate(rows) if i % 5 != fold])
        for url, block in rows[fold::5]:
            g = url_filter.grams(*url_filter._split(url))
            hits += (w[g].sum() / np.sqrt(len(g)) + b > 0) == bool(block)
    assert hits / len(rows) > 0.8


# ---- classifiers

def test_language_odd_rows(spark, odd_rows):
    df = make(spark, odd_rows)
    out = langid.identify(df).collect()
    assert len(out) == len(odd_rows)
    for r in out:
        text = next(t for i, t, *_ in odd_rows if i == r.doc_id)
        assert (r.lang_pred == "und") == (text is None or not any(c.isalpha() for c in text))
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    none = make(spark, [(i, t, None, s) for i, t, _, s in odd_rows])
    assert {r.lang_pred for r in langid.identify(none).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def test_only_und_is_rejected(spark, odd_rows):
    """A low score is no reason to drop a text; texts without letters go."""
    model = langid.Model(np.zeros((2, langid.BUCKETS), dtype=np.float32), ["en", "fr"])
    low = np.zeros(langid.BUCKETS + 1, dtype=np.float32)
    low[-1] = -1
    model.top = [low, low]
    df = make(spark, [(i, t, lang, s) for i, t, lang, s in odd_rows if i is not None])
    scored = langid.identify(df, model=model).collect()
    assert max(r.score for r in scored) < 0.2
    stays = Counter(r.doc_id for r in langid.accepted(df, model=model).collect())
    assert stays == Counter(i for i, t, *_ in odd_rows if i is not None and any(c.isalpha() for c in t or ""))


def test_language_held_out_accuracy(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = langid.identify(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred != 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows) and len(rows) > 20


def test_ordinal_recovers_grades():
    rng = random.Random(4)
    rows, grades = [], []
    for _ in range(1500):
        g = rng.choice([0, 1, 2, 2, 2])
        w = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([5, 60, 400]))] + {0: ["awful"], 1: ["dull"], 2: []}[g]
        rows.append(ordinal_quality.features(" ".join(w))), grades.append(g)
    m = ordinal_quality.Ordinal(rows[:1200], np.array(grades[:1200]), 3)
    assert list(m.theta) == sorted(m.theta)
    tails = np.array([m.tails(r) for r in rows[1200:]])
    assert (tails[:, 0] >= tails[:, 1]).all()
    held = np.array(grades[1200:])
    assert ((tails[:, 1] >= 0.5) == (held == 2)).mean() > 0.97
    assert tails.sum(axis=1)[held == 0].mean() < tails.sum(axis=1)[held == 1].mean() < tails.sum(axis=1)[held == 2].mean()


def test_ordinal_odd_rows(spark, odd_rows):
    df = make(spark, odd_rows)
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 1), (6, 0, 0), (6, 0, 0), (None, 1, 0), (8, None, None), (77, 1, 0)], "doc_id long, quality int, toxic int")
    out = ordinal_quality.rate(df, labels).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.tail_prob <= 1 and 0 <= r.expected_grade <= 2 for r in out)
    assert not any(r.kept for r in out if r.doc_id in (1, 2, 13))
    assert ordinal_quality.rate(df, labels.limit(0)).count() == len(odd_rows)
    assert ordinal_quality.rate(df.limit(0), labels).count() == 0


# ---- pipeline

def test_pipeline_small(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = docs
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.staged(stage(spark, kept, small_dir), "test")
        assert kept.columns == docs.columns
        seen.append(Counter(r.doc_id for r in kept.collect()))
    lang, exact, near, mixed = seen
    assert all(any(c.isalpha() for c in rows[i].text) for i in lang)
    assert len(lang) > 0.95 * len(rows)
    best = {}
    for i in lang:
        best[rows[i].text] = max(i, best.get(rows[i].text, i))
    assert set(exact) == set(best.values()) and max(exact.values()) == 1
    want = plain_join([(i, rows[i].text) for i in exact])
    assert set(near) == {int(k) for k, _, c in want if k == c}
    assert set(mixed) <= set(near) and max(mixed.values()) <= 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, small_dir).collect()
    assert {r.doc_id for r in pieces} == set(mixed)
    assert sum(r.length for r in pieces) == sum(
        n * t for n, t in ((mixed[i], next(r.doc_tokens for r in pieces if r.doc_id == i)) for i in mixed))


def family(n, seed=1):
    """Near copies of one text, at and around the threshold."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w), "en", "a"))
    return rows


def test_links_grow_with_a_family_not_with_its_square(spark, monkeypatch):
    tried = {}
    real = ngram_join._verify

    def counting(pairs, *rest):
        tried[n] = tried.get(n, 0) + pairs.count()
        return real(pairs, *rest)
    monkeypatch.setattr(ngram_join, "_verify", counting)
    for n in (800, 1600):
        out = ngram_join.join(make(spark, family(n))).collect()
        groups = Counter(r.component_id for r in out)
        assert groups.most_common(1)[0][1] > 0.9 * n
    assert tried[1600] < 2.6 * tried[800] and tried[1600] < 12 * 1600
