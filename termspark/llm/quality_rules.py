"""Quality rules with adaptive thresholds (operator 9, native).

Base rules judge a text alone (too few words, mostly repeated windows).  The rest of
the verdict is relative: every rate of a text (word length, symbols, repeated lines,
repeated words) is held against the usual range of its language and source.

The usual range comes from a mergeable quantile sketch: a histogram over integer rates
whose buckets keep the four leading bits, so a bucket is at most 1/8 wide relative to
its values.  Adding counts merges two sketches exactly, in any order, and the sketch of
a (language, source) pair has at most a few hundred buckets.  Pairs with fewer than
``MIN_DOCS`` documents use the sketch of their language, and small languages that of
the whole table, merged from the same rows.

A rate is *usual* up to a multiple (``RATES``) of its 0.9 quantile; word length also has a
lower end, two thirds of its 0.1 quantile.  A pair's limit follows its own sketch, but only
between half and twice that of its language, so a source full of junk does not make junk
usual, and one that is cleaner than the rest does not condemn what its language has
everywhere.  A fault is counted only
from an occurrence or two on (``RATES``): where a fault is unknown to a language, the limit
is 0, and a single stray symbol or repeated line rejects nothing.  Texts that fail the base
rules are left out of the sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, staged, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
MIN_DOCS = 100
PERCENT = {"lo": 10, "hi": 90}
#: measure -> (halves of the 0.9 quantile that are usual, occurrences that never reject, has a lower limit); rates
#: are per 10,000 words; two three-word windows, each found twice, make 12 repeated words
RATES = {"word_chars": (3, 0, True), "n_symbols": (16, 2, False), "n_dup_lines": (16, 2, False), "n_repeat_words": (32, 12, False)}


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             source: str = "source") -> DataFrame:
    """Key, language, source and the base measures of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), F.col(lang).alias("lang"), F.col(source).alias("source"), body.alias("text"),
                       words(F.col(text)).alias("w"))
    n = F.size("w")
    hashes = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                         lambda i: F.struct(F.xxhash64(*[F.element_at("w", i + k) for k in range(WINDOW)]).alias("h"), i.alias("i")))
    rows = rows.withColumn("s", F.when(n >= WINDOW, F.sort_array(hashes)))
    same = lambda x, at: F.coalesce(F.get("s", at)["h"] == x["h"], F.lit(False))
    twice = F.filter("s", lambda x, i: same(x, i - 1) | same(x, i + 1))
    rows = rows.withColumn("twice", F.transform(twice, lambda x: x["i"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform("twice", lambda i: F.sequence(i, i + (WINDOW - 1))))))
    has_word = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return rows.withColumn("lines", has_word).select(
        "id", "lang", "source", n.cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.greatest(F.coalesce(covered, F.lit(0)), F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rate(measure: str) -> Column:
    return F.expr(f"({measure} * 10000L) div greatest(n_words, 1L)")


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, top, n): the histogram sketch of every pair and rate."""
    each = rows.where(~base_failed()).select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), rate(m).alias("x")) for m in RATES])).alias("r"))
    return (each.select("lang", "source", "r.measure", F.expr(
                "((r.x >> greatest(length(bin(r.x)) - 4, 0)) + 1L << greatest(length(bin(r.x)) - 4, 0)) - 1L").alias("top"))
            .groupBy("lang", "source", "measure", "top").agg(F.count(F.lit(1)).alias("n")))


def _quantiles(sketch: DataFrame, level: list[str]) -> DataFrame:
    """Sketches merged to ``level``: documents and the quantiles of each rate."""
    merged = sketch.groupBy(*level, "measure", "top").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*level, "measure")
    upto = whole.orderBy("top").rowsBetween(Window.unboundedPreceding, 0)
    merged = merged.withColumn("upto", F.sum("n").over(upto)).withColumn("docs", F.sum("n").over(whole))
    return merged.groupBy(*level, "measure").agg(
        F.max("docs").alias("docs"),
        *[F.min(F.when(100 * F.col("upto") >= p * F.col("docs"), F.col("top"))).alias(c)
          for c, p in PERCENT.items()])


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (language, source): of each rate four times the upper limit (``hi_``: halves
    of halves stay whole numbers) and the quantile that the lower limit is taken from (``lo_``)."""
    pair = _quantiles(sketch, ["lang", "source"]).alias("p")
    tongue = _quantiles(sketch, ["lang"]).alias("l")
    table = _quantiles(sketch, []).alias("t")
    same = F.col("p.lang").eqNullSafe(F.col("l.lang")) & (F.col("p.measure") == F.col("l.measure"))
    every = pair.join(tongue, same).join(table, F.col("p.measure") == F.col("t.measure"))
    halves = F.element_at(F.create_map(*[F.lit(x) for m, (h, *_) in RATES.items() for x in (m, h)]), F.col("p.measure"))

    def of(end: str) -> tuple[Column, Column]:
        """The quantile of the language and of the pair; a small group has that of the larger one."""
        own = F.when(F.col("l.docs") >= MIN_DOCS, F.col(f"l.{end}")).otherwise(F.col(f"t.{end}"))
        return own, F.when(F.col("p.docs") >= MIN_DOCS, F.col(f"p.{end}")).otherwise(own)

    (wide, near), (wide_lo, near_lo) = of("hi"), of("lo")
    # between half and twice the language's
    every = every.select("p.lang", "p.source", "p.measure", (F.least(F.greatest(2 * near, wide), 4 * wide) * halves).alias("hi"),
                         F.least(near_lo, wide_lo).alias("lo"))
    return every.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{c}_{m}") for m in RATES for c in ("lo", "hi")])


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """One row per row of ``docs``: key, n_words, the four base measures, base_failed, kept.

    Null and empty texts have no words and fail the base rules; a null language or
    source is a group like any other; repeated rows are judged alike; a group whose
    texts all fail the base rules has no thresholds and needs none; an empty table
    gives no rows.  Other columns are ignored.
    """
    rows = staged(measures(docs, key, text, lang, source), "quality")
    limits = thresholds(sketches(rows)).alias("t")
    rows = rows.alias("r").join(limits, F.col("r.lang").eqNullSafe(F.col("t.lang"))
                                & F.col("r.source").eqNullSafe(F.col("t.source")), "left")
    usual = F.lit(True)
    for m, (_, stray, both) in RATES.items():
        usual = usual & ((4 * rate(m) <= F.col(f"hi_{m}")) | (F.col(m) <= stray))
        usual = usual & (3 * rate(m) >= 2 * F.col(f"lo_{m}")) if both else usual
    return rows.select(F.col("id").alias(key), "n_words", *RATES, base_failed().alias("base_failed"),
                       (~base_failed() & F.coalesce(usual, F.lit(True))).alias("kept"))
