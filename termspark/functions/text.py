"""Text analysis as column expressions: text -> tokens, per language.

The analyzers of the search schema become built-in Spark expressions (regex,
translate, higher-order array functions), so they run JVM-side over whole
tables: no Python in the row path.

Chains (index side), applied in this order:
  en: lower, possessive 's removed, ASCII punctuation -> space, word tokens,
      stop words out, protected words kept, S-stemmer (Harman 1991).
  fr / fr_en: lower, elision (l', qu', ...) removed, punctuation -> space,
      accent folding, word tokens, stop words out (list folded too),
      light plural/feminine stemmer.
  de / es: lower, punctuation, word tokens, stop words out.
  general: lower, word tokens.
Elision and possessive run before the punctuation step, so they see the
apostrophe (see SURVEY Q9).

Two forms are offered: ``token_array`` (array column; for names and queries)
and ``token_rows`` (one row per token with its position; for whole documents
and postings, where the stop and stem steps are plain codegen'd expressions).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import stopwords

# Patterns shared with the SQL twins.
WORD = r"[\p{L}\p{N}]+"
ASCII_PUNCT = r"[!-/:-@\[-`{-~]"
APOSTROPHES = "['’]"
# French elision articles (word-initial, before an apostrophe).
ELISION_FR = ["l", "m", "t", "qu", "n", "s", "j", "d", "c", "jusqu", "quoiqu", "lorsqu", "puisqu"]


def _fold_table() -> tuple[str, str]:
    """Accent folding by rule: every lower-case letter of Latin-1 Supplement and
    Latin Extended-A whose canonical decomposition is an ASCII letter plus marks."""
    src, dst = [], []
    for cp in range(0xC0, 0x180):
        ch = chr(cp)
        if not ch.islower():
            continue
        base = unicodedata.normalize("NFKD", ch)
        if len(base) > 1 and base[0].isascii() and base[0].isalpha() and all(
                unicodedata.combining(x) for x in base[1:]):
            src.append(ch)
            dst.append(base[0])
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _fold_table()
# Ligatures folded to two letters.
LIGATURES = {"œ": "oe", "æ": "ae", "ß": "ss"}

LANGUAGES = {"en": "english", "fr": "french", "fr_en": "french", "de": "german", "es": "spanish"}

assert len(FOLD_FROM) == len(FOLD_TO)


def fold_text(s: str) -> str:
    """Python twin of the folding expression (for word lists)."""
    s = s.translate(str.maketrans(FOLD_FROM, FOLD_TO))
    for k, v in LIGATURES.items():
        s = s.replace(k, v)
    return s


def stop_list(lang: str) -> list[str]:
    words = stopwords.load(LANGUAGES[lang]) if lang in LANGUAGES else []
    if lang in ("fr", "fr_en"):
        words = sorted({fold_text(w) for w in words})
    return words


# ------------------------------------------------------------------ steps
def possessive(c: Column) -> Column:
    """English possessive: a trailing 's / ’s of a word is removed."""
    return F.regexp_replace(c, f"{APOSTROPHES}s([^\\p{{L}}\\p{{N}}]|$)", "$1")


def elision(c: Column, articles: Iterable[str] = ELISION_FR) -> Column:
    """Word-initial article + apostrophe removed (l'arbre -> arbre)."""
    alt = "|".join(articles)
    return F.regexp_replace(c, f"(^|[^\\p{{L}}\\p{{N}}])({alt}){APOSTROPHES}", "$1")


def punct_to_space(c: Column) -> Column:
    return F.regexp_replace(c, ASCII_PUNCT, " ")


def fold(c: Column) -> Column:
    c = F.translate(c, FOLD_FROM, FOLD_TO)
    for k, v in LIGATURES.items():
        c = F.replace(c, F.lit(k), F.lit(v))
    return c


def normalize(c: Column, lang: str) -> Column:
    """Text -> normalised text whose word runs are the tokens."""
    c = F.lower(c)
    if lang == "en":
        c = possessive(c)
    if lang in ("fr", "fr_en"):
        c = elision(c)
    c = punct_to_space(c)
    if lang in ("fr", "fr_en"):
        c = fold(c)
    return c


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), 0)


def stem_en(t: Column) -> Column:
    """S-stemmer: ies->y (not eies/aies), es->e (not aes/ees/oes), s-> (not us/ss)."""
    return (F.when(F.length(t) <= 3, t)
            .when(t.rlike("[^ae]ies$"), F.regexp_replace(t, "ies$", "y"))
            .when(t.rlike("[^aeo]es$"), F.regexp_replace(t, "es$", "e"))
            .when(t.rlike("[^us]s$"), F.regexp_replace(t, "s$", ""))
            .otherwise(t))


def stem_fr(t: Column) -> Column:
    """Light French stemmer: -aux -> -al, then plural s/x, then feminine e."""
    t1 = F.when((F.length(t) > 5) & t.endswith("aux"), F.regexp_replace(t, "aux$", "al")).otherwise(t)
    t2 = F.when((F.length(t1) > 3) & t1.rlike("[sx]$"), F.regexp_replace(t1, "[sx]$", "")).otherwise(t1)
    t3 = F.when((F.length(t2) > 3) & t2.endswith("e"), F.regexp_replace(t2, "e$", "")).otherwise(t2)
    return t3


def stem(t: Column, lang: str, protected: Iterable[str] = ()) -> Column:
    protected = list(protected)
    if lang == "en":
        s = stem_en(t)
    elif lang in ("fr", "fr_en"):
        s = stem_fr(t)
    else:
        return t
    if protected:
        s = F.when(t.isin(protected), t).otherwise(s)
    return s


# ------------------------------------------------------------- array form
def token_array(c: Column, lang: str = "en", protected: Iterable[str] = (), stem_tokens: bool = True,
                stop: bool = True) -> Column:
    """Column of tokens after the whole chain of ``lang``."""
    toks = words(normalize(c, lang))
    sl = stop_list(lang) if stop else []
    if sl:
        stop_arr = F.array(*[F.lit(w) for w in sl])
        toks = F.filter(toks, lambda x: ~F.array_contains(stop_arr, x))
    if stem_tokens and lang in ("en", "fr", "fr_en"):
        prot = list(protected)
        toks = F.transform(toks, lambda x: stem(x, lang, prot))
    return toks


# --------------------------------------------------------------- row form
def token_rows(df: DataFrame, text_col: str, lang: str = "en", keep: Iterable[str] = (),
               protected: Iterable[str] = (), stem_tokens: bool = True, stop: bool = True) -> DataFrame:
    """One row per kept token: keep columns + pos (0-based, stop words leave gaps) + token."""
    keep = list(keep)
    rows = df.select(*keep, F.posexplode(words(normalize(F.col(text_col), lang))).alias("pos", "token"))
    sl = stop_list(lang) if stop else []
    cond = ~F.col("token").isin(sl) if sl else None
    tok = stem(F.col("token"), lang, protected) if stem_tokens else F.col("token")
    if cond is not None:
        rows = rows.filter(cond)
    return rows.select(*keep, "pos", tok.alias("token"))


def token_rows_by(df: DataFrame, text_col: str, lang_col: str, langs: Iterable[str],
                  keep: Iterable[str] = (), protected: Iterable[str] = (), stem_tokens: bool = True) -> DataFrame:
    """Like ``token_rows`` with the chain picked per row by ``lang_col`` (one of
    ``langs``): a single pass over the input whatever the mix of languages."""
    keep = list(keep)
    langs = list(langs)
    lang = F.col(lang_col)

    def by_lang(fn):
        expr = None
        for lg in langs:
            expr = F.when(lang == lg, fn(lg)) if expr is None else expr.when(lang == lg, fn(lg))
        return expr

    norm = by_lang(lambda lg: normalize(F.col(text_col), lg))
    rows = df.select(*keep, lang_col, F.posexplode(words(norm)).alias("pos", "token"))
    t = F.col("token")
    is_stop = by_lang(lambda lg: t.isin(stop_list(lg)) if stop_list(lg) else F.lit(False))
    rows = rows.filter(~is_stop)
    tok = by_lang(lambda lg: stem(t, lg, protected) if stem_tokens else t)
    return rows.select(*keep, lang_col, "pos", tok.alias("token"))


# ------------------------------------------------------- other token forms
def whitespace_tokens(c: Column) -> Column:
    """Whitespace tokenizer: split on runs of white space, empty pieces dropped."""
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


def word_delimiter(c: Column, catenate: bool = True) -> Column:
    """Split words at case changes, letter/digit changes and non-alphanumerics;
    with ``catenate`` the joined parts of each multi-part word are added."""
    s = F.regexp_replace(c, r"([\p{Ll}])([\p{Lu}])", "$1 $2")
    s = F.regexp_replace(s, r"([\p{L}])([\p{N}])", "$1 $2")
    s = F.regexp_replace(s, r"([\p{N}])([\p{L}])", "$1 $2")
    parts = F.regexp_extract_all(s, F.lit(WORD), 0)
    if not catenate:
        return parts
    joined = F.filter(
        F.transform(F.split(c, r"\s+"), lambda w: F.array_join(F.regexp_extract_all(w, F.lit(WORD), 0), "")),
        lambda w: w != "")
    multi = F.filter(joined, lambda w: ~F.array_contains(parts, w))
    return F.concat(parts, multi)


def distinct_tokens(toks: Column) -> Column:
    return F.array_distinct(toks)


def reversed_tokens(toks: Column) -> Column:
    """Reversed tokens, for leading-wildcard matching by prefix."""
    return F.transform(toks, lambda x: F.reverse(x))


def path_prefixes(path: Column, delimiter: str = "/") -> Column:
    """Path hierarchy: '/a/b/c' -> ['/a', '/a/b', '/a/b/c']; a path without parts has none."""
    parts = F.filter(F.split(path, re.escape(delimiter)), lambda x: x != "")
    steps = F.transform(F.sequence(F.lit(1), F.size(parts)),
                        lambda i: F.concat(F.lit(delimiter), F.array_join(F.slice(parts, 1, i), delimiter)))
    return F.when(F.size(parts) > 0, steps).otherwise(F.array().cast("array<string>"))


def url_path(url: Column) -> Column:
    """Path part of a URL (no scheme, host, query or fragment)."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def payload_tokens(c: Column, delimiter: str = "|") -> Column:
    """'tok|1.5 other|2' -> array<struct<token, payload float>>; no payload = 1.0."""
    esc = "\\" + delimiter
    return F.transform(
        whitespace_tokens(c),
        lambda x: F.struct(F.get(F.split(x, esc), 0).alias("token"),
                           F.coalesce(F.get(F.split(x, esc), 1).try_cast("float"), F.lit(1.0).cast("float"))
                           .alias("payload")))


CJK_RUN = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]+"


def cjk_bigrams(c: Column) -> Column:
    """Overlapping character bigrams of each CJK run (a one-character run stays a unigram)."""
    runs = F.regexp_extract_all(c, F.lit(CJK_RUN), 0)
    grams = F.transform(runs, lambda r: F.when(
        F.length(r) == 1, F.array(r)).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, 2))))
    return F.flatten(grams)
