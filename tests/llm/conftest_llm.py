SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, slot string, size string, `key` string, kept string, _at string, _copy string, mix_shard string, _metadata string"


def make(spark, rows, tmp_path=None):
    """documents with columns whose names clash with those of the operators; a Parquet
    scan if ``tmp_path`` is given, else a frame in memory."""
    full = [(i, t, lang, source, None if t is None else len(t), "x", "y", "z", "k", "q", "a", "b", "c", "d") for i, t, lang, source in rows]
    df = spark.createDataFrame(full, SCHEMA).coalesce(2)
    if tmp_path is None:
        return df
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet")


LONG = " ".join(f"wort{i % 977}x{i}" for i in range(20000))
BASE = " ".join(f"tok{i}" for i in range(60))


def odd():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    near = BASE.replace("tok30", "changed")
    return [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, LONG, "en", "b"), (5, LONG, "en", "b"),
            (6, BASE, "de", "b"), (7, near, "de", None), (8, "One two", "fr", "c"), (9, "one TWO", "fr", "c"), (9, "one TWO", "fr", "c"),
            (10, "#### $$$$ 1234", "es", "c"), (None, "text without an id", "en", "a"), (11, BASE + " tail", None, "a"),
            (12, "Ünïcode é 漢字 words, here are six", "fr", "a"), (13, "", None, "d"), (14, BASE.upper(), "de", "b")]
