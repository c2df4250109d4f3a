from __future__ import annotations

import hashlib
import warnings

import numpy as np
import pytest
from helpers import documents
from pyspark.sql.functions import lit

from gradeframe.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def slow_rake(cells, targets, sweeps=2000):
    """Raking of {values: mass} in plain Python."""
    w = {k: float(m) for k, m in cells.items()}
    for _ in range(sweeps):
        for axis, shares in enumerate(targets):
            seen = {k[axis] for k, m in cells.items() if m}
            total = sum(s for v, s in shares.items() if v in seen)
            now = {}
            for k, x in w.items():
                now[k[axis]] = now.get(k[axis], 0) + x
            w = {k: x * (shares.get(k[axis], 0) / total / now[k[axis]] if now[k[axis]] else 0) for k, x in w.items()}
    return w


def frame(spark, rows, names):
    return spark.createDataFrame(rows, names)


def test_rake_against_plain_python(spark):
    rng = np.random.default_rng(3)
    cells = {(a, b, c): int(rng.integers(1, 1000)) for a in "xyz" for b in ["p", "q", None] for c in "uv" if rng.random() < 0.9}
    cells[("x", "p", "u")] = 0
    targets = [{"x": 0.5, "y": 0.3, "z": 0.2, "unseen": 0.4}, {"p": 1.0, "q": 2.0, None: 3.0}, {"u": 0.5, "v": 0.5}]
    df = frame(spark, [(*k, m) for k, m in cells.items()], "a string, b string, c string, mass bigint")
    frames = {n: frame(spark, list(t.items()), f"{n} string, share double") for n, t in zip("abc", targets)}
    got = {(r.a, r.b, r.c): r.weight for r in mixing.rake(df, frames, sweeps=3).collect()}
    assert got == pytest.approx(slow_rake(cells, targets, 3))
    assert sum(got.values()) == pytest.approx(1)
    near = mixing.rake(df, frames, sweeps=30, tolerance=0.01).collect()
    full = slow_rake(cells, targets)
    assert all(r.weight == pytest.approx(full[(r.a, r.b, r.c)], abs=0.02) for r in near)


def test_values_without_a_target_and_contradictions(spark):
    df = frame(spark, [("x", "p", 5), ("y", "q", 5), ("z", "p", 5)], "a string, b string, mass bigint")
    only = {"a": frame(spark, [("x", 1.0), ("y", 1.0)], "a string, share double")}
    assert {r.a: r.weight for r in mixing.rake(df, only).collect()} == {"x": 0.5, "y": 0.5, "z": 0.0}
    # x is all of p and y all of q, so no weights meet both.
    clash = {
        "a": frame(spark, [("x", 0.9), ("y", 0.1)], "a string, share double"),
        "b": frame(spark, [("p", 0.1), ("q", 0.9)], "b string, share double"),
    }
    assert mixing.rake(df.filter("a != 'z'"), clash, sweeps=2).count() == 2


def leaky(leak):
    """20 sources, each of one of 4 languages but for a leak; shares the sources' tokens do not have."""
    cells = {(f"s{i}", f"l{j}"): int(1e9 * (i + 1) * (1 - 3 * leak if i % 4 == j else leak)) for i in range(20) for j in range(4)}
    sums = [{}, {}]
    for k, m in cells.items():
        for axis in range(2):
            sums[axis][k[axis]] = sums[axis].get(k[axis], 0) + m
    return cells, [{v: m**0.85 for v, m in s.items()} for s in sums]


def test_mostly_one_language_a_source_is_raked_to_the_end(spark):
    for leak, on_driver in ((0.01, mixing.CELLS_ON_DRIVER), (0.0001, mixing.CELLS_ON_DRIVER), (0.15, 0)):
        cells, targets = leaky(leak)
        df = frame(spark, [(*k, m) for k, m in cells.items()], "a string, b string, mass bigint")
        frames = {n: frame(spark, list(t.items()), f"{n} string, share double") for n, t in zip("ab", targets)}
        with warnings.catch_warnings():
            warnings.simplefilter("error", UserWarning)
            rows = mixing.rake(df, frames, on_driver=on_driver).collect()
        for name, shares in zip("ab", targets):
            for value, share in shares.items():
                got = sum(r.weight for r in rows if r[name] == value)
                assert got == pytest.approx(share / sum(shares.values()), rel=1e-8)


def test_contradicting_targets_are_reported(spark):
    df = frame(spark, [("x", "p", 5), ("y", "q", 5)], "a string, b string, mass bigint")
    clash = {
        "a": frame(spark, [("x", 0.9), ("y", 0.1)], "a string, share double"),
        "b": frame(spark, [("p", 0.1), ("q", 0.9)], "b string, share double"),
    }
    for on_driver in (0, 10):
        with pytest.warns(UserWarning, match="still off"):
            assert mixing.rake(df, clash, on_driver=on_driver).count() == 2


def docs(spark):
    rows = []
    for i in range(3000):
        source = "hot" if i % 3 == 0 else f"s{i % 4}"
        rows.append((i, f"text {i}", source, "en" if i % 5 else None, i % 7))
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_tokens bigint")


def test_mix_meets_its_targets_in_expectation(spark):
    df = docs(spark)
    targets = {
        "source": frame(spark, [("hot", 0.2), ("s1", 0.3), ("s2", 0.3), ("s0", 0.1), ("s3", 0.1)], "source string, share double"),
        "lang": frame(spark, [("en", 0.7), (None, 0.3)], "lang string, share double"),
    }
    rows = mixing.mix(df, ["source", "lang"], targets).collect()
    assert len(rows) == 3000
    expected = sum(r.n_tokens * r.probability for r in rows)
    hot = sum(r.n_tokens * r.probability for r in rows if r.source == "hot")
    none = sum(r.n_tokens * r.probability for r in rows if r.lang is None)
    assert hot / expected == pytest.approx(0.2) and none / expected == pytest.approx(0.3)
    assert max(r.probability for r in rows) == pytest.approx(1)
    for r in rows:
        chance = int(hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest()[:8], 16) / 2**32
        assert r.sampled == (chance < r.probability)
    taken = sum(r.n_tokens for r in rows if r.sampled)
    assert abs(taken / expected - 1) < 0.1


def test_nulls_repeats_and_empty_tables(spark):
    df = docs(spark).limit(4).unionByName(docs(spark).limit(1))
    df = df.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "source", "lang", "n_tokens", "1 AS mass", "2 AS v")
    assert mixing.mix(df, ["source", "lang"]).count() == 5
    assert mixing.mix(df.filter("false"), ["source", "lang"]).count() == 0
    nothing = mixing.with_margins(documents(spark, [None, "", "  "]))
    rows = mixing.mix(nothing, ["source", "lang", "topic"]).collect()
    assert [(r.n_tokens, r.weight, r.probability, r.sampled) for r in rows] == [(0, None, 0.0, False)] * 3


def test_topics_and_tokens(spark):
    texts = ["a | b", "Licensed under the X", "call 1234", "plain", None, "a\x0bb c d"]
    rows = mixing.with_margins(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r.topic for r in rows] == ["table", "licensed", "records", "prose", "prose", "prose"]
    assert [r.n_tokens for r in rows] == [3, 4, 2, 1, 0, 3]


def test_registered_query_is_raked_to_the_end(spark):
    """Weights and probabilities are those of as many sweeps as it takes."""
    rows = queries.op6_mixing(spark, SF).collect()
    cells, sums = {}, [{}, {}, {}]
    for r in rows:
        cells[(r.source, r.lang, r.topic)] = cells.get((r.source, r.lang, r.topic), 0) + r.n_tokens
    for k, m in cells.items():
        for axis in range(3):
            sums[axis][k[axis]] = sums[axis].get(k[axis], 0) + m
    weights = slow_rake(cells, [{v: m**0.85 for v, m in s.items()} for s in sums], 200)
    total = sum(cells.values())
    top = max(weights[k] / m for k, m in cells.items() if m)
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        key = (r.source, r.lang, r.topic)
        assert r.weight == pytest.approx(weights[key] * total / cells[key], abs=2e-6)
        assert r.probability == pytest.approx(weights[key] / cells[key] / top, abs=2e-6)


def test_columns_with_the_names_of_results(spark):
    docs = documents(spark, ["one two three", "four five", ""])
    plain = mixing.mix(mixing.with_margins(docs), ["source", "lang", "topic"])
    odd = docs.withColumns({n: lit("x") for n in ("weight", "probability", "sampled", "mass", "v", "share")})
    mixed = mixing.mix(mixing.with_margins(odd), ["source", "lang", "topic"])
    names = ["doc_id", "weight", "probability", "sampled"]
    assert sorted(mixed.select(*names).collect(), key=str) == sorted(plain.select(*names).collect(), key=str)
    assert {r.mass for r in mixed.collect()} == {"x"}
