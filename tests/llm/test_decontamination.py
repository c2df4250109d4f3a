from __future__ import annotations

import hashlib
import random
import re

import pytest
from helpers import ODD, documents
from plans import physical

from gradeframe.llm import decontamination as D
from gradeframe.llm import queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items, length=10):
    """(n_words, n_hit, item ids) of each text, by comparing every place with every window."""
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - length + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + length]), set()).add(item)
    found = []
    for text in texts:
        w, hit, owners = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                items_here = windows.get(tuple(w[i : i + size]))
                if items_here:
                    hit.update(range(i, i + size))
                    owners |= items_here
        found.append((len(w), len(hit), sorted(str(o) for o in owners if o is not None)))
    return found


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def compare(spark, texts, items, length=10):
    got = D.contamination(documents(spark, texts), benchmark(spark, items), length=length).collect()
    assert len(got) == len(texts)
    expected = brute(texts, items, length)
    for r in got:
        assert (r.n_words, r.n_hit, r["items"]) == expected[r.doc_id], texts[r.doc_id][:200]


def test_random_texts(spark):
    rng = random.Random(3)
    vocabulary = ["the", "of", "a", "Été", "été", "x1", "É", "k", "K"]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n)).replace(" a ", rng.choice([" a, ", "\n", " A "]))

    items = [(i, text(rng.randint(0, 14))) for i in range(40)] + [(41, None), (1, text(12)), (None, "the of the of")]
    texts = [text(rng.randint(0, 60)) for _ in range(60)] + [f"{text(5)} {t} {text(5)}" for _, t in items[:20]] + ODD
    compare(spark, texts, items, length=4)


def test_passages_overlaps_and_edges(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    part = " ".join(f"w{i}" for i in range(5, 16))
    texts = [passage, f"{part}, {part}", part[:-1], f"{passage} {passage}", passage.upper() + "!", " ".join(f"w{i}" for i in range(9)), "v " + part]
    items = [(10, passage), (9, part), (2, passage.title()), (3, "w0 w1"), (4, "never seen words"), (5, "v")]
    compare(spark, texts * 2 + ODD, items)


def test_one_word_is_everywhere(spark):
    texts = [("the " * n).strip() for n in range(40)] + ["the end"]
    compare(spark, texts, [(1, "the " * 10), (2, "the"), (3, "the the the end")])


def test_nulls_repeated_rows_and_empty_tables(spark):
    rows = [(None, "a b c"), (None, None), (1, "a b c"), (1, "a b c"), (1, "other")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS key", "2 AS print", "3 AS n_hit")
    items = benchmark(spark, [(7, "A b C"), (None, "other")])
    got = sorted(map(str, D.contamination(df, items).select("doc_id", "n_hit", "items").collect()))
    expected = [(None, 3, ["7"]), (None, 0, []), (1, 3, ["7"]), (1, 3, ["7"]), (1, 1, [])]
    assert got == sorted(f"Row(doc_id={d}, n_hit={n}, items={i})" for d, n, i in expected)
    clean = D.uncontaminated(df, items)
    assert [tuple(r) for r in clean.collect()] == [(None, None, 1, 2, 3)]
    assert D.contamination(df.filter("false"), items).count() == 0
    assert D.contamination(df, items.filter("false")).filter("n_hit > 0").count() == 0
    assert D.uncontaminated(df, items.filter("false")).count() == 5


def proximity(spark, texts, windows, leads, slop, length):
    """(text, window, start, distance, exact) of proximity matches around the given lead terms."""
    docs = D._documents(documents(spark, texts), "doc_id", "text")
    phrases = D.item_windows(benchmark(spark, windows), length=length)
    rarest = leads(docs, phrases)
    index = D.build_index(docs, rarest, length, slop)
    found = D.matches(index, rarest, phrases, slop=slop)
    said = phrases.windows.select("window", "words")
    return {(r.key, tuple(r.words), r.start, r.distance, r.exact) for r in found.join(said, "window").collect()}


def slow_proximity(text, window, lead, slop):
    """Each place that an occurrence of word ``lead`` of the window gives, by the definition."""
    said, found = words(text), set()
    for at, word in enumerate(said):
        if word == window[lead]:
            start, shifts = at - lead, []
            for i, wanted in enumerate(window):
                near = [abs(j - start - i) for j, w in enumerate(said) if w == wanted and abs(j - start - i) <= slop]
                shifts.append(min(near, default=None))
            if None not in shifts:
                exact = start >= 0 and tuple(said[start : start + len(window)]) == window
                found.add((start, max(shifts), exact))
    return found


def test_proximity_needs_every_word(spark):
    items = [(1, "alpha beta gamma delta")]
    texts = ["alpha beta gamma delta", "alpha big beta gamma delta", "alpha " + "x " * 9 + "beta gamma delta", "beta alpha"]
    got = proximity(spark, texts, items, D.rarest_terms, 2, 10)
    assert {(key, distance, exact) for key, _, _, distance, exact in got} == {(0, 0, True), (1, 1, False)}
    far = ["alpha beta gamma alpha beta gamma alpha beta gamma", "zeta alpha beta gamma kappa"]
    got = proximity(spark, far, [(1, far[1])], D.rarest_terms, 2, 10)
    assert {key for key, *_ in got} == {1}


def test_proximity_by_brute_force(spark):
    rng = random.Random(8)
    names = ["ka", "lo", "mi", "nu", "pe", "ra"]
    windows = [tuple(rng.sample(names, rng.randint(2, 4))) for _ in range(12)]
    windows = sorted(set(windows))
    texts = [" ".join(rng.choices([*names, "x"], k=rng.randint(0, 25))) for _ in range(60)]
    for slop in (1, 3):
        seen = {}

        def leads(docs, phrases):
            rarest = D.rarest_terms(docs, phrases)
            said = {r.window: tuple(r.words) for r in phrases.windows.collect()}
            seen.update({said[r.window]: r.offset for r in rarest.filter("rank = 0").collect()})
            return rarest

        got = proximity(spark, texts, [(i, " ".join(w)) for i, w in enumerate(windows)], leads, slop, 4)
        expected = {
            (k, w, *hit) for w in windows if w in seen for k, t in enumerate(texts) for hit in slow_proximity(t, w, seen[w], slop)
        }
        assert got == expected and any(not exact for *_, exact in got)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_the_same_without_broadcasts(spark, monkeypatch, limit):
    passage = " ".join(f"w{i}" for i in range(12))
    monkeypatch.setattr(D.small, "__defaults__", (limit,))
    compare(spark, [passage, "w1 w2", ""], [(1, passage), (2, "w2")])


def test_no_python_and_no_shuffled_texts(spark):
    docs = D._documents(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text")
    phrases = D.item_windows(spark.read.parquet(f"{SF}/benchmark.parquet"))
    plan = physical(D.matches(D.build_index(docs, D.rarest_terms(docs, phrases), 10), D.rarest_terms(docs, phrases), phrases))
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_registered_query(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    expected = dict(zip(docs, brute(docs.values(), items)))
    rows = queries.op1_decontamination(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows:
        n, hit, owners = expected[r.doc_id]
        digest = hashlib.sha256(",".join(owners).encode()).hexdigest()
        assert tuple(r) == (r.doc_id, n, hit, len(owners), digest, hit > 0)
