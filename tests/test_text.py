from __future__ import annotations

import brute
from pyspark.sql import functions as F

from gradeframe.functions.multisets import intersection_size, token_counts
from gradeframe.functions.text import ngrams, normalize_text, strip, tokenize


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_strip_agrees_with_python_for_every_character(spark):
    chars = [chr(c) for c in range(1, 0x3100)]
    df = spark.createDataFrame([(f"{c}x {c} y{c}",) for c in chars], "s string")
    rows = df.select("s", strip("s").alias("t")).collect()
    assert [r.s for r in rows if r.t != r.s.strip()] == []


def test_normalize_text(spark):
    (text,) = one(spark, normalize_text(F.lit("\t HeLLo W　\n")))
    assert text == "hello w"


def test_tokenize(spark):
    texts = ["Ünder 12 Bridges 桥下", "", "  ", "naïve_word", "K ß Σας İx", "ｆｕｌｌ かな 한글", "a-b.c"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select("s", tokenize("s").alias("t")).collect()
    for r in rows:
        assert r.t == brute.words(r.s), r.s
    assert one(spark, tokenize(F.lit(None).cast("string"))) == ([],)


def arrays(spark, *texts):
    """One row with an array of the characters of each text, as a, b, ..."""
    row = tuple(list(t) for t in texts)
    names = "abcdef"[: len(texts)]
    return spark.createDataFrame([row], ", ".join(f"{n} array<string>" for n in names))


def test_ngrams(spark):
    df = arrays(spark, "abc")
    got = tuple(df.select(*[ngrams("a", n) for n in (-1, 0, 1, 2, 3, 4)]).first())
    assert got == ([], [], ["a", "b", "c"], ["a b", "b c"], ["a b c"], [])


def test_intersection_size_counts_copies(spark):
    def size(a, b):
        return arrays(spark, a, b).select(intersection_size("a", "b")).first()[0]

    assert size("aabbc", "abbbd") == 3
    assert size("aaaa", "aa") == 2
    assert size("abc", "def") == 0
    assert size("", "a") == 0
    assert size("zzyyxx", "xxyyzz") == 6


def test_token_counts(spark):
    df = arrays(spark, "banana", "")
    counts, none = df.select(token_counts("a"), token_counts("b")).first()
    assert [tuple(c) for c in counts] == [("a", 3), ("b", 1), ("n", 2)]
    assert none == []
