"""Hierarchical language identification (operator 7).

A text is first given a language family, then one-versus-one linear support vector
machines choose among the languages of that family.  Features are hashed character
one- to three-grams of the whole lower-cased text (everything but letters is one
space), scaled by square root and length.  The models are fitted on the driver on a
sample of at most ``PER_LANGUAGE`` labelled texts of each language, drawn by key hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 11
PER_LANGUAGE = 1000
UNKNOWN = "und"
FAMILIES = {"en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
            "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
            "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "bg": "slavic"}


def features(text: str) -> np.ndarray | None:
    """Unit vector of hashed n-grams; None for a text without letters."""
    low = text.lower()
    code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds, where = np.unique(code, return_inverse=True)
    letter = np.array([chr(c).isalpha() for c in kinds], dtype=bool)
    if not letter.any():
        return None
    c = np.where(letter, kinds, 32).astype(np.uint32)[where]
    c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]]  # one space for each gap
    two = c[:-1] * np.uint32(0x01000193) ^ c[1:]
    three = two[:-1] * np.uint32(0x01000193) ^ c[2:]
    counts = np.zeros(BUCKETS)
    for n, g in enumerate((c, two, three)):
        h = (g + np.uint32(n)) * np.uint32(0x9E3779B1)
        counts += np.bincount(h >> np.uint32(21), minlength=BUCKETS)
    counts = np.sqrt(counts)
    return (counts / np.linalg.norm(counts)).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, epochs: int = 12, l2: float = 1e-4, seed: int = 7) -> np.ndarray:
    """Linear support vector machine (squared hinge, both classes weigh the same) by
    averaged mini-batch descent; the last weight is the intercept.  y is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w, mean, steps, rng = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0, np.random.default_rng(seed)
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 64):
            i = order[lo:lo + 64]
            slack = np.maximum(0, 1 - y[i] * (x[i] @ w))
            w -= 0.5 / (1 + 0.2 * epoch) * (l2 * w - x[i].T @ (share[i] * slack * y[i]) / len(i))
            if 2 * epoch >= epochs:
                mean, steps = mean + w, steps + 1
    return (mean / max(1, steps)).astype(np.float32)


class Model:
    """Families, languages and the weights of both levels."""

    def __init__(self, x: np.ndarray, langs: list[str], families: dict[str, str] = FAMILIES):
        names = np.array(langs, dtype=object)
        self.family_of = {s: families.get(s, s) for s in sorted(set(langs))}
        self.members: dict[str, list[str]] = {}
        for s, f in self.family_of.items():
            self.members.setdefault(f, []).append(s)
        self.families = sorted(self.members)
        own = np.array([self.family_of[s] for s in langs], dtype=object)
        self.top = [svm(x, np.where(own == f, 1.0, -1.0)) for f in self.families] if len(self.families) > 1 else []
        self.pairs = {}
        for group in self.members.values():
            for a, b in combinations(group, 2):
                i = (names == a) | (names == b)
                self.pairs[a, b] = svm(x[i], np.where(names[i] == a, 1.0, -1.0))

    def predict(self, v: np.ndarray) -> tuple[str, float]:
        """Language and score: the family's share of the family odds times the mean
        pairwise probability of the language within it."""
        if not self.families:
            return UNKNOWN, 0.0
        odds = [float(v @ w[:-1] + w[-1]) for w in self.top] or [1.0]
        best = int(np.argmax(odds))
        prob = lambda m: 1 / (1 + np.exp(-4 * m))
        score, group = (prob(odds[best]) if self.top else 1.0), self.members[self.families[best]]
        votes = {s: [0, 0.0] for s in group}
        for a, b in combinations(group, 2):
            w = self.pairs[a, b]
            m = float(v @ w[:-1] + w[-1])
            votes[a if m >= 0 else b][0] += 1
            votes[a][1] += prob(m)
            votes[b][1] += prob(-m)
        lang = max(group, key=lambda s: (votes[s][0], votes[s][1], s))
        return lang, float(score * (votes[lang][1] / (len(group) - 1) if len(group) > 1 else 1.0))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = PER_LANGUAGE, families: dict[str, str] = FAMILIES) -> Model:
    """Model from a bounded sample: for each language the ``per_language`` labelled texts
    with the smallest key hashes, outside the held-out fifth."""
    rows = docs.select(F.col(key).alias("k"), F.col(lang).alias("y"), F.col(text).alias("t"))
    known = rows.where(F.col("y").isNotNull() & F.col("k").isNotNull() & F.col("t").isNotNull() & ~held_out(F.col("k")))
    # only about twice as many rows of a language as asked for are ranked, however many there are
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}  # one row a language
    share = F.lit(1.0)
    for name, n in counts.items():
        share = F.when(F.col("y") == name, min(1.0, 2 * per_language / n)).otherwise(share) if n > 2 * per_language else share
    early = F.shiftrightunsigned(F.xxhash64("k"), 11).cast("double") / float(1 << 53) < share
    first = Window.partitionBy("y").orderBy(F.shiftrightunsigned(F.xxhash64("k"), 11), "k")
    chosen = (known.select("k", "y").where(early).withColumn("nr", F.row_number().over(first)).where(F.col("nr") <= per_language)
              .select("k", "y").distinct())
    vectors = _vectors(known.join(F.broadcast(chosen), ["k", "y"]))  # at most per_language rows a language
    seen: dict[str, int] = {}
    x, y = [], []
    for r in vectors.orderBy("h", "k").toLocalIterator():
        if seen.setdefault(r["y"], 0) < per_language:  # a repeated key brings more rows than asked for
            seen[r["y"]] += 1
            x.append(np.frombuffer(r["v"], dtype=np.float16).astype(np.float32))
            y.append(r["y"])
    return Model(np.array(x, dtype=np.float32).reshape(-1, BUCKETS), y, families)


def _vectors(rows: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            v = [features(t) for t in f["t"]]
            f = f.assign(v=[None if x is None else x.astype(np.float16).tobytes() for x in v])
            yield f[f["v"].notna()][["k", "y", "h", "v"]]
    key = rows.schema["k"].dataType.simpleString()
    return rows.withColumn("h", F.shiftrightunsigned(F.xxhash64("k"), 11)).mapInPandas(run, f"k {key}, y string, h long, v binary")


def predictor(model: Model) -> Callable[[Column], Column]:
    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for t in texts:
                v = features(t) if t else None
                out.append((UNKNOWN, 0.0) if v is None else model.predict(v))
            yield pd.DataFrame(out, columns=["lang", "score"])
    return predict


def accepted(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             model: Model | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that have a language: only ``und`` is
    rejected (null texts and texts without letters), whatever the score of the others."""
    model = model or fit(docs, key, text, lang)

    @F.pandas_udf("boolean")
    def accept(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            vectors = [features(t) if t else None for t in texts]
            yield pd.Series([v is not None and model.predict(v)[0] != UNKNOWN for v in vectors], dtype=bool)
    return docs.where(accept(F.col(text).cast("string")))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: key, held_out, lang_pred, score.

    Null texts and texts without letters are ``und`` with score 0; so is everything when
    no labelled text exists.  A null key is never held out and never learned from.  Of
    languages with equal votes the larger pairwise sum wins, then the later name.
    Repeated rows are predicted alike; an empty table gives no rows; other columns are
    ignored.
    """
    model = model or fit(docs, key, text, lang)
    rows = docs.select(F.col(key).alias("k"), predictor(model)(F.col(text).cast("string")).alias("p"))
    return rows.select(F.col("k").alias(key), held_out(F.col("k")).alias("held_out"),
                       F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
