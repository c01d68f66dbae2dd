"""Analyzer steps on inline frames."""

from pyspark.sql import functions as F

from termspark.functions import text as tx


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("o")).first()["o"]


def test_english_chain(spark):
    toks = one(spark, lambda c: tx.token_array(c, "en"), "The Doctor's notes: babies, classes and glasses!")
    # possessive gone, stop words out, S-stemmer: babies->baby, classes->classe, glasses->glasse, notes->note
    assert toks == ["doctor", "note", "baby", "classe", "glasse"]


def test_protected_words_skip_stemming(spark):
    toks = one(spark, lambda c: tx.token_array(c, "en", protected=["glasses"]), "glasses babies")
    assert toks == ["glasses", "baby"]


def test_french_chain(spark):
    toks = one(spark, lambda c: tx.token_array(c, "fr"), "L'hôpital et les chevaux d'Élise: maladies")
    # elision, folding, stop words (folded list), light stemmer
    assert toks == ["hopital", "cheval", "elis", "maladi"]


def test_token_rows_positions_keep_gaps(spark):
    df = spark.createDataFrame([(1, "the big dogs")], "id int, t string")
    rows = tx.token_rows(df, "t", "en", keep=["id"]).orderBy("pos").collect()
    assert [(r.pos, r.token) for r in rows] == [(1, "big"), (2, "dog")]


def test_token_rows_by_language_column(spark):
    df = spark.createDataFrame([(1, "en", "dogs"), (2, "fr", "l'arbres")], "id int, lang string, t string")
    rows = {r.id: r.token for r in tx.token_rows_by(df, "t", "lang", ["en", "fr"], keep=["id"]).collect()}
    assert rows == {1: "dog", 2: "arbr"}


def test_word_delimiter(spark):
    toks = one(spark, lambda c: tx.word_delimiter(c), "WiFi wi-fi SD500")
    assert toks[:6] == ["Wi", "Fi", "wi", "fi", "SD", "500"]
    assert "WiFi" in toks and "wifi" in toks and "SD500" in toks


def test_whitespace_distinct_reversed(spark):
    assert one(spark, tx.whitespace_tokens, "  a  b\tc ") == ["a", "b", "c"]
    assert one(spark, lambda c: tx.distinct_tokens(tx.whitespace_tokens(c)), "a b a") == ["a", "b"]
    assert one(spark, lambda c: tx.reversed_tokens(tx.whitespace_tokens(c)), "abc de") == ["cba", "ed"]


def test_path_prefixes(spark):
    assert one(spark, lambda c: tx.path_prefixes(tx.url_path(c)), "https://h.org/a/b/c?x=1#f") == ["/a", "/a/b", "/a/b/c"]
    for empty in ("https://h.org/", "https://h.org", "", "//"):
        assert one(spark, lambda c: tx.path_prefixes(tx.url_path(c)), empty) == []
    assert one(spark, lambda c: tx.path_prefixes(c), "/") == []


def test_payload_tokens(spark):
    out = one(spark, tx.payload_tokens, "foo|2.5 bar")
    assert [(r.token, r.payload) for r in out] == [("foo", 2.5), ("bar", 1.0)]


def test_cjk_bigrams(spark):
    assert one(spark, tx.cjk_bigrams, "東京都 x 日") == ["東京", "京都", "日"]


def test_stop_lists_and_fold():
    # the English list is the 33 words of the search schema
    assert len(tx.stop_list("en")) == 33 and {"the", "and", "was"} <= set(tx.stop_list("en"))
    assert "meme" in tx.stop_list("fr") and "même" not in tx.stop_list("fr")  # folded list
    assert {"der", "und", "nicht", "für"} <= set(tx.stop_list("de")) and {"el", "que", "también"} <= set(tx.stop_list("es"))
    assert tx.fold_text("œuvre élève") == "oeuvre eleve"


def test_literal_tokens(spark):
    """Expected tokens written out, so that a wrong list or pattern cannot agree with itself."""
    texts = {"en": ("The patients' fever was in the lungs; it's John's", ["patient", "fever", "lung", "john"]),
             "fr": ("L'hôpital et les maladies du cœur chez l'enfant", ["hopital", "maladi", "coeur", "chez", "enfant"]),
             "de": ("Der Arzt und die Pflege sind nicht mit dem Kind", ["arzt", "pflege", "kind"]),
             "es": ("El médico y la enfermera de los niños", ["médico", "enfermera", "niños"])}
    for lang, (body, want) in texts.items():
        got = spark.range(1).select(tx.token_array(F.lit(body), lang).alias("t")).first().t
        assert got == want, (lang, got)
