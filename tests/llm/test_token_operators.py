"""Operators 11 to 13 against plain versions: brute force over pairs, the tokenizer
libraries over whole texts, and their counts of every prefix."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest_llm import LONG, make
from termspark.llm import alignment, hard_negatives, token_counts
from termspark.llm.tokens import PART, WIDE_PART, byte_alphabet

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LETTERS = [*"abcthe eingo'srvel   \n\t\r!?.,-=**#012", "'re", "'ll", "don't", " the", "ing", "　", "\xa0", "é", "漢", "😀",
           "<|endoftext|>", "<|end", "\x85", "\x1c", "\n\n", "----", "aaaa", "́", "ſ", "Ⅷ", "▁", "<0x41>", "</s>", "\U00010d40"]


def odd_texts(seed, n, size=25):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, size))) for _ in range(n)]


# ---- operator 11 -----------------------------------------------------------------

def mine_plainly(rows, asked):
    ok = [(i, lab, [int(np.floor(256 * float(x))) for x in v]) for i, lab, v in rows
          if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, lab, v in ok:
        if not asked(i):
            continue
        scored = sorted((-sum(map(int.__mul__, v, w)), j, other) for j, other, w in ok if j != i)
        for p, (score, j, _) in enumerate([s for s in scored if s[2] == lab][:5]):
            hard = [(-s, k) for s, k, other in scored if other != lab and 50 * -score <= 100 * -s <= 95 * -score][:3]
            out += [(i, j, r + 1, k, -score, s) for r, (s, k) in enumerate(hard)]
    return sorted(out)


def vectors(seed, n=260, dims=6):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(4, dims)) + 0.6
    rows = [(i, i % 4, [float(x) for x in (base[i % 4] + rng.normal(size=dims)).astype(np.float32)]) for i in range(n)]
    rows += [(1000 + i, 1 + i % 2, rows[5][2]) for i in range(40)]  # ties
    rows += [rows[7], rows[50], (50, 3, rows[9][2]), (None, 1, rows[3][2]), (2001, None, rows[3][2]), (2002, 1, None), (2003, 1, []),
             (2004, 2, [float("nan")] * dims), (2005, 2, [1.0, None, 1.0]), (2006, 1, [0.5, 0.25]), (2007, 0, [float("inf")]),
             (2050, 1, [0.0] * dims), (2100, 2, [-1.0] * dims)]
    return rows


@pytest.mark.parametrize("round_bytes", [1 << 20, 100])
def test_hard_negatives_equal_brute_force(spark, round_bytes, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS_AT_ONCE", 64)
    monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", 3)
    rows = vectors(3)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, label int, embedding array<float>, id string, place string").repartition(5)
    got = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, round_bytes=round_bytes)
    want = mine_plainly(rows, lambda i: i % 50 == 0)
    assert len(want) > 60 and sorted(map(tuple, got.collect())) == want
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_huge_scores_stay_whole():
    a, b = np.array([[2.0 ** 60, 3.0]]), np.array([[5.0, 7.0], [2.0 ** 62, 0.0]])
    assert hard_negatives.products(a, b).tolist() == [[5 * 2 ** 60 + 21, 2 ** 63 - 1]]
    assert hard_negatives.window(-7, 50, 95) == (-3, -7) and hard_negatives.window(0, 50, 95) == (0, 0)


def test_keys_sort_like_their_fields():
    rng = np.random.default_rng(1)
    cols = [rng.integers(-3, 3, 500) for _ in range(4)]
    keys = hard_negatives.pack(*cols[:3], 1, cols[3])
    assert [x.tolist() for x in hard_negatives.unpack(keys)] == [*(c.tolist() for c in cols[:3]), [1] * 500, cols[3].tolist()]
    by_key = np.argsort(np.array(keys.to_pylist(), dtype=object), kind="stable")
    assert by_key.tolist() == np.lexsort((cols[3], -cols[2], cols[1], cols[0])).tolist()


# ---- operator 12 -----------------------------------------------------------------

def align_plainly(texts):
    lib, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    lib.encode_special_tokens = True
    alphabet = byte_alphabet()
    vocab = {i: bytes(alphabet[c] for c in t) for t, i in json.load(open(A))["model"]["vocab"].items()}

    def spans(tokens):
        at, out = 0, []
        for i, data in tokens:
            out.append((at, at + len(data), i))
            at += len(data)
        return out

    found, counts = [], Counter()
    for text in texts:
        a = [(i, vocab[i]) for i in lib.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode())
             for i in pieces.encode(text)] if text else []
        if not text or not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
            found.append(None)
            continue
        a, b = spans(a), spans(b)
        links = [(i, j) for s, e, i in a for t, f, j in b if s < f and t < e]
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        cuts = list(zip([0, *ends], ends))
        groups = ";".join("|".join(",".join(str(i) for s, _, i in side if lo <= s < hi) for side in (a, b)) for lo, hi in cuts)
        counts.update(links)
        found.append((len(a), len(b), len(ends), links, groups))
    top = Counter()
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    return [(0, 0, 0, 0, 0, 0, "") if x is None else
            (*x[:3], len(x[3]), sum(counts[p] == top[p[1]] for p in x[3]), sum(counts[p] for p in x[3]), x[4]) for x in found]


@pytest.mark.parametrize("slices", [False, True])
def test_alignment_equals_the_libraries(spark, odd_rows, slices, monkeypatch):
    rows = [r for r in odd_rows if r[1] is not LONG] + [(100 + i, t, "en", "s") for i, t in enumerate(odd_texts(5, 150))]
    rows += [(99, "x" * 3000, "en", "s"), (98, " ", "en", "s"), (97, "\n", "en", "s")]
    options = {"slice_pairs": 8, "bucket_pairs": 8} if slices else {}
    if slices:
        rows = rows[:25]
    monkeypatch.setattr(alignment, "SLOTS_PER_BLOCK", 5)
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    monkeypatch.setattr(alignment, "CACHE_PARTS", 3)
    monkeypatch.setattr(alignment, "RUN_PARTS", 7)
    monkeypatch.setattr(alignment, "RUN_CHARS", 50)
    out = alignment.align(make(spark, rows).repartition(4), A, B, **options).collect()
    want = [(str(r[0]), *x) for r, x in zip(rows, align_plainly([r[1] or "" for r in rows]))]
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in out) == sorted(want)
    assert sum(w[1] == 0 for w in want) < len(want) / 2


def test_alignment_of_an_empty_table(spark, odd_rows):
    assert alignment.align(make(spark, odd_rows).limit(0), A, B).count() == 0
    assert alignment.align(make(spark, [(1, None, "en", "a")]), A, B).collect()[0].n_links == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 5000])
def test_pair_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 47, n))
    bucket = (keys & 0xFFFFFFFF) % 7
    built = [(b, *alignment.build(keys[bucket == b])) for b in range(7) if (bucket == b).any()]
    h = alignment.PairHash.of(7, 0, [x[:3] for x in built])
    assert len(h) == len(keys) and sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    stored = np.concatenate([x[3] for x in built]) if built else keys
    assert (stored[h.slots(keys)] == keys).all()
    other = rng.integers(0, 1 << 47, 300)
    at = h.slots(other)
    assert ((at == -1) | (np.append(stored, -1)[at] != other)).all()


# ---- operator 13 -----------------------------------------------------------------

def test_every_prefix_equals_the_library():
    lib, counter = Tokenizer.from_file(A), token_counts.counter(A)
    for text in [*odd_texts(7, 400), "it'll we're 're 'r", "a  <|endoftext|>  b<|endoftext|><|endoftext|>", "=" * 150, "hello   \n\n  world  "]:
        got = np.cumsum(np.frombuffer(counter.texts([text])[0], dtype=np.int8), dtype=int).tolist()
        assert got == [len(lib.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)], text


def test_token_counts(spark, odd_rows):
    lib = Tokenizer.from_file(A)
    rows = odd_rows + [(100 + i, t, "en", "s") for i, t in enumerate(odd_texts(9, 200, 60))]
    df = token_counts.count(make(spark, rows), A, limit=20)
    want = sorted((str(i), len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 20) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect()) == want
    assert token_counts.count(make(spark, odd_rows).limit(0), A).count() == 0


def test_budget_and_truncation_from_the_store(spark, odd_rows):
    lib = Tokenizer.from_file(A)
    texts = {i: t or "" for i, t, *_ in odd_rows if i is not None}
    df = token_counts.count(make(spark, odd_rows).where("doc_id is not null"), A)
    rows = df.select("doc_id", "n_tokens", token_counts.tokens_at(F.col("prefixes"), F.lit(10)).alias("ten"),
                     token_counts.longest_prefix(F.col("prefixes"), F.lit(7)).alias("cut")).collect()

    def tokens(text):
        return len(lib.encode(text, add_special_tokens=False).ids)
    for r in rows:
        t = texts[r.doc_id]
        assert r.ten == tokens(t[:10])
        assert tokens(t[:r.cut]) <= 7 and all(tokens(t[:k]) > 7 for k in range(r.cut + 1, min(len(t), r.cut + 30) + 1))


def test_parts_give_the_text_back():
    for text in odd_texts(11, 300):
        assert "".join(PART.findall(text)) == text == "".join(WIDE_PART.findall(text))
