from __future__ import annotations

import random

import numpy as np
from helpers import ODD, documents
from pyspark.sql import functions as F

from gradeframe.llm import language as L
from gradeframe.llm import queries

SF = "/root/testdata/sf0.01"


def model(names=("de", "en", "ru"), switch=4.0, seed=1):
    rng = np.random.default_rng(seed)
    allowed = np.ones((len(L.SCRIPTS), len(names)), bool)
    return L.Languages(list(names), rng.normal(-5, 2, (1 << 15, len(names))).astype(np.float32), allowed, switch)


def slow_words(text):
    words, at = [], 0
    for i, c in enumerate(text + " "):
        if not c.isalpha():
            if i > at:
                words.append((at, i))
            at = i + 1
    return words


def test_words_and_offsets():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab éİß1 \n中я-😀𝟙𠀋𝐀") for _ in range(rng.randint(0, 40))) for _ in range(200)] + ["", "x"]
    words = L.split_words(texts)
    for i, text in enumerate(texts):
        own = words.text == i
        assert list(zip(words.start[own].tolist(), words.end[own].tolist())) == slow_words(text), text


def test_hashes_do_not_depend_on_neighbouring_texts():
    alone = L.split_words(["tide"]).hashes.tolist()
    assert L.split_words(["x", "tide", "salt"]).hashes.tolist()[1:5] == alone


def best_path(scores, switch):
    """The best path by trying all of them."""
    import itertools

    def value(path):
        jumps = sum(a != b for a, b in zip(path, path[1:]))
        return sum(s[k] for s, k in zip(scores, path)) - switch * jumps

    return max(map(value, itertools.product(range(scores.shape[1]), repeat=len(scores)))), value


def test_paths_against_all_paths():
    m, rng = model(), random.Random(3)
    texts = [" ".join(rng.choice(["tide", "salz", "meer", "rope", "я"]) for _ in range(rng.randint(0, 7))) for _ in range(60)]
    words = L.split_words(texts)
    path, scores = m.paths(words, len(texts)), m.word_scores(words).astype(float)
    for i in range(len(texts)):
        own = words.text == i
        if own.any():
            best, value = best_path(scores[own], m.switch)
            assert abs(value(path[own].tolist()) - best) < 1e-3


def test_scripts_rule_languages_out():
    m = model()
    m.allowed[:, 2] = False
    m.allowed[[n for n, _ in L.SCRIPTS].index("cyrillic")] = [False, False, True]
    found = L.identify(["море и соль", "tide and salt", "123", "tide tide tide море море море"], m)
    assert found[0][0] == "ru" and found[1][0] != "ru" and found[2] == ("und", 0.0, [])
    assert [s["lang"] for s in found[3][2]][-1] == "ru" and len(found[3][2]) == 2


def corpus(spark):
    rng = random.Random(5)
    say = {
        "en": "the of and tide salt rope harbour with from this that ship".split(),
        "de": "der die und mit von salz hafen schiff meer nicht auch ein".split(),
    }
    texts, langs = [], []
    for i in range(400):
        lang = "en" if i % 3 else "de"
        texts.append(" ".join(rng.choice(say[lang]) for _ in range(30)))
        langs.append(lang)
    df = documents(spark, texts)
    names = spark.createDataFrame(list(enumerate(langs)), "doc_id bigint, l string")
    return df.drop("lang").join(names, "doc_id").withColumnRenamed("l", "lang"), say


def test_learns_and_splits_mixed_texts(spark):
    df, say = corpus(spark)
    m = L.fit(df, F.lit(True))
    assert m.names == ["de", "en"]
    mixed = " ".join(say["en"] * 3) + ". " + " ".join(say["de"] * 2)
    ((name, share, spans),) = L.identify([mixed], m)
    assert name == "en" and 0.5 < share < 0.75
    assert [s["lang"] for s in spans] == ["en", "de"]
    assert mixed[spans[1]["start"] : spans[1]["end"]] == " ".join(say["de"] * 2)


def test_unusable_rows_and_null_languages_are_not_learned_from(spark):
    df, _ = corpus(spark)
    base = L.fit(df, F.col("doc_id") < 300)
    spoiled = df.withColumn("text", F.when(F.col("doc_id") < 300, F.col("text")).otherwise("zz qq"))
    more = documents(spark, ["xx yy zz", None, ""], lang=None, first=0).select(*df.columns)
    again = L.fit(spoiled.unionByName(more), F.col("doc_id") < 300)
    np.testing.assert_array_equal(base.trigrams, again.trigrams)
    assert L.fit(df.filter("false"), F.lit(True)) is None


def test_rows_stay_rows(spark):
    df, _ = corpus(spark)
    m = L.fit(df, F.lit(True))
    odd = documents(spark, [*ODD, "again", "again"]).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")
    for learned in (m, None):
        rows = L.with_language(odd, learned).collect()
        assert len(rows) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in rows)
        assert sum(r.lang_pred == "und" for r in rows) == (3 if learned else len(rows))
    assert L.with_language(odd.filter("false"), m).count() == 0


def test_registered_query_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op10_language(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(truth)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
