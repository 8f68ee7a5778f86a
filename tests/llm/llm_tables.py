"""Small tables with every odd row the operators must take."""

LONG = " ".join(f"word{k % 977} und{k % 31}." for k in range(30_000))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, body string, fp long, score double"


def odd_documents(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [
        (1, "Alpha beta gamma delta.\nSecond line here, and more.", "en", "a", 51, "x", 1, 0.5),
        (2, "Alpha beta gamma delta.\nSecond line here, and more.", "en", "a", 51, None, 2, None),
        (2, "Alpha beta gamma delta.\nSecond line here, and more.", "en", "a", 51, None, 2, None),
        (3, "", "en", "a", 0, "", None, 1.0),
        (4, None, None, None, None, None, None, None),
        (None, "a text without a number", "de", "b", 23, "y", 3, 0.1),
        (5, " \t\n ", "fr", "b", 4, "z", 4, 0.2),
        (6, LONG, "en", None, len(LONG), "z", 4, 0.2),
        (7, "12345 67890 ...", None, "a", 15, "z", 4, 0.2),
        (9, "É\u0301\x1c ünïcode 🎉 text — «quoted»", "fr", "b", 20, "z", 4, 0.2),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
