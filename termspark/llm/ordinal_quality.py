"""Ordinal quality classifier (operator 8).

Graded ratings follow a cumulative-link model: P(grade <= k) = s(theta_k - w.x) with one
weight vector over hashed tokens and ordered thresholds.  Expected grade and tail
probability P(grade >= ``tail``) come from the same numbers.  Grades of the label table:
0 for toxic text, 1 for low quality without, 2 for good and clean text.

Features are the distinct tokens of the whole text (runs of letters, of digits, of other
symbols), the decile of the symbol share, and that of the share of distinct tokens.  Only features found in ``MIN_DOCS`` texts of
the sample whose mean grade lies ``MIN_Z`` standard errors below the overall mean carry
weight: a text is good unless something speaks against it, be it short or long.  Fitted on at most
``MAX_LABELS`` labelled texts, drawn by key hash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LABELS = 8000
MIN_DOCS, MIN_Z = 15, 4.5
TAIL, THRESHOLD = 2, 0.5
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def features(text: str) -> np.ndarray:
    """Distinct 32-bit feature hashes of a text, ascending."""
    tokens = _TOKEN.findall(text.lower())
    symbols = sum(not t[0].isalnum() for t in tokens if len(t) > 1 or t in "#*$%&|<>")
    found = set(tokens)
    found.add(f"\0distinct {10 * len(found) // max(1, len(tokens))} {len(tokens).bit_length() // 2}")
    found.add(f"\0symbols {10 * symbols // max(1, len(tokens))}")
    out = np.fromiter((zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in found), dtype=np.uint32, count=len(found))
    return np.unique(out)


class Ordinal:
    """Cumulative-link logistic regression on sparse 0/1 features."""

    def __init__(self, rows: list[np.ndarray], grades: np.ndarray, levels: int, steps: int = 200, l2: float = 2e-5):
        self.levels = levels
        size = np.array([len(r) for r in rows], dtype=np.int64)
        names, at = np.unique(np.concatenate([np.zeros(0, dtype=np.uint32), *rows]), return_inverse=True)
        doc = np.repeat(np.arange(len(rows)), size)
        found = np.bincount(at, minlength=len(names))
        off = grades - (grades.mean() if len(rows) else 0)
        spread = np.sqrt(np.maximum(found, 1) * max(1e-9, (off ** 2).sum() / max(1, len(rows))))
        seen = (found >= MIN_DOCS) & (np.bincount(at, weights=off[doc], minlength=len(names)) / spread <= -MIN_Z)
        doc, at, self.names = doc[seen[at]], (np.cumsum(seen) - 1)[at[seen[at]]], names[seen]
        width = len(self.names)
        w, theta = np.zeros(width), np.log(np.arange(1, levels) / np.arange(levels - 1, 0, -1))
        mw, vw, mt, vt = np.zeros(width), np.zeros(width), np.zeros(levels - 1), np.zeros(levels - 1)
        s = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        for step in range(1, steps + 1 if len(rows) else 1):
            score = np.bincount(doc, weights=w[at], minlength=len(rows))
            edge = np.concatenate([[-np.inf], theta, [np.inf]])
            hi, lo = s(edge[grades + 1] - score), s(edge[grades] - score)
            p = np.maximum(hi - lo, 1e-9)
            dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
            gw = np.bincount(at, weights=((dhi - dlo) / len(rows))[doc], minlength=width) + l2 * w
            gt = np.array([dlo[grades == k + 1].sum() - dhi[grades == k].sum() for k in range(levels - 1)]) / len(rows)
            for g, m, v, x in ((gw, mw, vw, w), (gt, mt, vt, theta)):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
            theta = np.maximum.accumulate(theta + 1e-6 * np.arange(levels - 1))
        self.w, self.theta = w, theta

    def tails(self, found: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. levels - 1."""
        at = np.searchsorted(self.names, found)
        known = at < len(self.names)
        known[known] = self.names[at[known]] == found[known]
        return 1 - 1 / (1 + np.exp(-np.clip(self.theta - float(self.w[at[known]].sum()), -30, 30)))


def grade() -> Column:
    """0, 1 or 2 from the columns quality and toxic; null where both are null."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        max_labels: int = MAX_LABELS) -> Ordinal:
    """Model from at most ``max_labels`` labelled texts with the smallest key hashes."""
    known = (labels.select(F.col(key).alias("k"), grade().alias("g")).where("k is not null and g is not null")
             .groupBy("k").agg(F.min("g").alias("g")).orderBy(F.xxhash64("k"), "k").limit(max_labels))
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"g": f["g"], "h": f["h"], "v": [features(t).tobytes() for t in f["t"]]})

    sample = (rows.join(F.broadcast(known), "k").withColumn("h", F.xxhash64("k", "t"))  # at most max_labels rows
              .mapInPandas(run, "g int, h long, v binary"))
    got = [(r["g"], np.frombuffer(r["v"], dtype=np.uint32)) for r in sample.orderBy("h", "g").limit(2 * max_labels).toLocalIterator()]
    return Ordinal([v for _, v in got], np.array([g for g, _ in got], dtype=np.int64), 3)


def rate(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
         tail: int = TAIL, threshold: float = THRESHOLD, model: Ordinal | None = None) -> DataFrame:
    """One row per row of ``docs``: key, expected_grade, tail_prob, kept.

    ``kept`` is tail_prob >= threshold.  Null and empty texts have no token and are not
    kept; keys without a text in ``docs`` teach nothing, and of repeated label keys the
    lowest grade counts; without labels every text gets the middle of the scale.  Repeated rows
    are rated alike; an empty table gives no rows; other columns are ignored.
    """
    model = model or fit(docs, labels, key, text)

    @F.pandas_udf("expected double, tail double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = [model.tails(features(t)) if t else np.zeros(model.levels - 1) for t in texts]
            yield pd.DataFrame([(float(p.sum()), float(p[tail - 1])) for p in out], columns=["expected", "tail"])

    rows = docs.select(F.col(key).alias("k"), predict(F.col(text).cast("string")).alias("p"))
    return rows.select(F.col("k").alias(key), F.col("p.expected").alias("expected_grade"), F.col("p.tail").alias("tail_prob"),
                       (F.col("p.tail") >= threshold).alias("kept"))
