from __future__ import annotations

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, lang="en", first=0):
    """Rows of ``documents`` for the given texts, numbered from ``first``."""
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t in enumerate(texts, start=first)]
    return spark.createDataFrame(rows, DOCS)


ODD = ["", None, "   \n\t ", "word", "é ñ ß İ", "a" * 100_000, "x y z " * 20_000]
