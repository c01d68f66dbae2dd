"""URL filter (operator 5): host and path rules, then logistic regression.

Rules come first: a rule fits its host and all subdomains if the path starts with the
rule's path, and the longest rule wins.  Any other url is judged by a logistic
regression on hashed character n-grams of host and path, fitted on a small labelled
table of urls (``labelled_urls.csv`` or any other of at most ``MAX_LABELLED`` rows).
"""

from __future__ import annotations

import csv
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABELLED = os.path.join(os.path.dirname(os.path.abspath(__file__)), "labelled_urls.csv")
MAX_LABELLED = 10_000
BUCKETS = 1 << 14
SIZES = (2, 3, 4, 5)
THRESHOLD = 0.5
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))


def parts(address: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` or for null."""
    url = F.coalesce(address, F.lit(""))
    body = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(body, r"^[^/?#]*", 0)
    path = F.regexp_extract(body, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null.  Rules are a parameter."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(host: str, path: str) -> np.ndarray:
    """Distinct hashed character n-grams; host and path grams are different features."""
    found = set()
    for tag, s in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in SIZES:
            found.update(zlib.crc32((tag + s[i:i + n]).encode("utf-8", "surrogatepass")) % BUCKETS for i in range(len(s) - n + 1))
    return np.fromiter(sorted(found), dtype=np.int64, count=len(found))


def _split(url: str) -> tuple[str, str]:
    body = url.partition("://")[2]
    cut = min((i for i in map(body.find, "/?#") if i >= 0), default=len(body))
    path = body[cut:]
    end = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return body[:cut].lower(), path[:end]


def fit(rows: list[tuple[str, int]], steps: int = 800, rate: float = 0.5, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept by gradient descent from zero; both classes weigh the same."""
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled urls")
    x = np.zeros((len(rows), BUCKETS), dtype=np.float32)
    y = np.array([b for _, b in rows], dtype=np.float32)
    for i, (url, _) in enumerate(rows):
        g = grams(*_split(url))
        x[i, g] = 1 / np.sqrt(max(1, len(g)))
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, b = np.zeros(BUCKETS), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        g = share * (p - y)
        w -= rate * 20 * (x.T @ g + l2 * w)
        b -= rate * g.sum()
    return w.astype(np.float32), float(b)


def read_labelled(path: str = LABELLED) -> list[tuple[str, int]]:
    with open(path, encoding="utf-8", newline="") as f:
        return [(r["url"], int(r["block"])) for r in csv.DictReader(f)]


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES,
          labelled: list[tuple[str, int]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule, verdict, score (the model's
    probability of ``block``).

    A null url, or one without ``://``, has empty host and path and is allowed; repeated
    rows are judged alike; an empty table gives no rows; other columns are ignored.
    """
    w, b = fit(labelled if labelled is not None else read_labelled())
    host, path = parts(F.col(url))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            out = np.zeros(len(hosts))
            for i, (h, p) in enumerate(zip(hosts, paths)):
                g = grams(h, p)
                out[i] = w[g].sum() / np.sqrt(max(1, len(g))) + b
            yield pd.Series(1 / (1 + np.exp(-out)))

    rows = pages.select(F.col(key).alias("k"), host.alias("host"), path.alias("path"))
    rows = rows.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("r"), score("host", "path").alias("score"))
    blank = (F.col("host") == "") & (F.col("path") == "")
    own = F.when(blank | (F.col("score") < threshold), F.lit("allow")).otherwise(F.lit("block"))
    return rows.select(F.col("k").alias(key), "host", "path", F.col("r.rule").alias("rule"),
                       F.coalesce(F.col("r.verdict"), own).alias("verdict"), "score")
