from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from helpers import ODD
from pyspark.sql import functions as F

from gradeframe.llm import collocations as module
from gradeframe.llm.collocations import Filter, collocations, phrase_counts

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows, min_count, top=2000, most_words=5):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, most_words + 1):
                for i in range(len(words) - m + 1):
                    key = lang, tuple(words[i : i + m])
                    counts[key] = counts.get(key, 0) + 1
    found = {}
    kept = {k: f for k, f in counts.items() if f >= min_count}
    for (lang, words), a in kept.items():
        if len(words) < 2:
            continue
        inside = any(
            lo == lang and len(longer) > len(words) and f >= a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (lo, longer), f in kept.items()
        )
        if inside:
            continue
        n, cuts = totals[lang], []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right, n))
    return sorted(
        (lang, i, p.decode(), -a, left, right, n, -s)
        for lang, rows in found.items()
        for i, (s, a, p, left, right, n) in enumerate(sorted(rows)[:top], 1)
    )


def run(spark, rows, parts=5, extra=None, **more):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    if extra:
        docs = docs.withColumns(extra)
    return sorted(tuple(r) for r in collocations(docs, **more).collect())


def random_rows(seed, n=60, words="a b c d e f é A. b, c d", langs=("en", "de", None, "und")):
    rng = random.Random(seed)
    vocabulary = words.split()
    return [
        (rng.choice(langs), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", "\n", "! "]) for _ in range(rng.randrange(60))))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("min_count", [2, 6])
def test_against_brute_force(spark, monkeypatch, seed, min_count):
    monkeypatch.setattr(module, "_FLUSH", 50)  # many flushes a task
    rows = random_rows(seed)
    assert run(spark, rows, min_count=min_count) == slow(rows, min_count)


def test_small_budget_splits_prefixes_and_groups(spark):
    rows = random_rows(7, words="x y x x z")
    wanted = slow(rows, 3)
    for budget in (1, 20):
        assert run(spark, rows, min_count=3, budget=budget) == wanted


def test_other_sizes_and_top(spark):
    rows = random_rows(8)
    for most_words in (2, 4):
        assert run(spark, rows, min_count=4, most_words=most_words, top=3) == slow(rows, 4, 3, most_words)
    assert run(spark, rows, min_count=4, most_words=1) == []
    with pytest.raises(ValueError):
        run(spark, rows, min_count=0)


def test_copies_and_long_passages(spark):
    """A passage that fills the corpus: its parts are dropped for the longest phrases."""
    passage = "one two three four five six seven eight nine ten"
    rows = [("en", passage)] * 300 + [("en", "one two")] * 7 + [("en", "x " * 30_000)]
    found = run(spark, rows, min_count=100)
    assert found == slow(rows, 100)
    assert ("en", "one two") in {(r[0], r[2]) for r in found}
    assert ("en", "two three") not in {(r[0], r[2]) for r in found}


def test_odd_rows(spark):
    rows = [("en", t) for t in ODD] + [(None, None), (None, "a b"), (None, "a b"), ("", "a\x00 b\x1cc d")] * 2
    rows += [("de", "É É ß ß. É É")] * 3 + [("de", " wide  wide")] * 3
    extra = {name: F.lit("x") for name in ("phrase", "n", "prefix", "rank", "a.b", "w")}
    assert run(spark, rows, min_count=2, extra=extra) == slow(rows, 2)
    assert run(spark, rows[:0]) == []
    assert run(spark, [("en", "a b c")]) == []


def test_ties_take_the_smallest_cut_and_bytewise_order(spark):
    rows = [("en", t) for t in ["é z", "z é", "a b c", "𝟙 x", "￿ x"] * 4]
    assert run(spark, rows, min_count=2) == slow(rows, 2)


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts of a corpus of 10 billion words."""
    counts = [("", 10**13), ("a", 4 * 10**12), ("b", 5 * 10**12), ("a b", 3 * 10**12)]
    rows = [("en", p, n) for p, n in counts]
    table = spark.createDataFrame(rows, "lang string, phrase string, n bigint")
    monkeypatch.setattr(module, "phrase_counts", lambda *a, **k: table)
    found = [tuple(r) for r in collocations(spark.range(0)).collect()]
    score = 1000 * 3 * 10**12 * 10**13 // (4 * 10**12 * 5 * 10**12)
    assert found == [("en", 1, "a b", 3 * 10**12, 4 * 10**12, 5 * 10**12, 10**13, score)]


def test_filter_holds_all_and_few_more(spark):
    phrases = [("en", f"w{i}") for i in range(3000)]
    kept = Filter.of(spark.createDataFrame(phrases, "lang string, phrase string"))
    import numpy as np

    def hashes(names):
        return np.array([module._word_hash("en", w.encode()) for w in names], np.uint64)

    assert kept.has(hashes([w for _, w in phrases])).all()
    assert kept.has(hashes([f"other{i}" for i in range(3000)])).mean() < 0.1


def test_counts_do_not_depend_on_a_full_filter(spark, monkeypatch):
    """A filter that holds too much only makes suffixes longer."""
    rows = random_rows(9, words=" ".join(f"w{i}" for i in range(150)) + " a b" * 40)
    docs = spark.createDataFrame(rows, "lang string, text string")
    wanted = sorted(map(tuple, phrase_counts(docs, min_count=5).collect()))
    monkeypatch.setattr(Filter, "MOST_BITS", 6)
    assert sorted(map(tuple, phrase_counts(docs, min_count=5).collect())) == wanted
