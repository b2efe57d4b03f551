"""Rows that every operator has to take: nulls, blanks, repeats, a long text, clashing columns."""

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
ROWS = [
    (1, "The quick brown fox, it's 42 fine days.\nAnd more text follows here now.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n ", "en", "b"),
    (5, "word", "en", "b"),
    (6, "Ünïcödé 日本語 🙂 don't stop", "fr", "c"),
    (7, LONG, "en", "a"),
    (8, "The quick brown fox, it's 42 fine days.\nAnd more text follows here now.", "en", "a"),
    (8, "The quick brown fox, it's 42 fine days.\nAnd more text follows here now.", "en", "a"),
    (None, "no id here", "en", None),
    (9, "x" * 5000, "de", "c"),
]
#: Names that operators use inside.
EXTRA = ("id", "row", "score", "label", "band", "part", "shard", "ids", "n_words", "kept_text", "stats", "rest", "row_key")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def documents(spark, rows=ROWS):
    full = [(*r, len(r[1] or ""), *("?" for _ in EXTRA)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def tables(spark, folder, rows=ROWS, labels=()):
    """A folder like those of the test data."""
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)
