from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from helpers import ODD, documents
from pyspark.sql import functions as F

from gradeframe.llm import quality, queries

SF = "/root/testdata/sf0.01"


def blobs(n, share, seed):
    """Two clouds of features; ``share`` of the rows are positive ones."""
    rng = np.random.default_rng(seed)
    good = rng.random(n) < share
    x = rng.normal(0, 1, (n, 6)).astype(np.float32)
    x[good] += 1.5
    return x, good


def trained(positive, unlabelled, prior, rounds=6, hidden=16, epochs=7):
    net = quality.start(unlabelled.mean(0), unlabelled.std(0) + 1e-3, hidden)
    for i in range(rounds):
        quality.steps(net, positive, unlabelled, prior, np.random.default_rng(i), epochs)
    return net


def test_prior_and_classifier_from_positives_and_unlabelled():
    for share in (0.3, 0.85):
        x, good = blobs(6000, share, 1)
        positive = blobs(6000, 1.0, 2)[0]
        told = trained(positive[::2], x[::2], None, rounds=1, epochs=10)
        p, u = told.logit(positive[1::2]), told.logit(x[1::2])
        cuts = np.quantile(p, np.linspace(0, 0.95, 96))
        above = [np.array([(v > c).mean() for c in cuts]) for v in (p, u)]
        prior = quality.prior_from(*above, len(p), len(u))
        assert abs(prior - share) < 0.07
        net = trained(positive, x, prior, rounds=3)
        fresh, truth = blobs(4000, share, 3)
        # The two clouds overlap: the best possible rule is right for over 95 % of the rows.
        assert ((net.score(fresh) > 0.5) == truth).mean() > 0.93


def test_the_risk_is_kept_from_going_negative():
    # Far more network than data: without the bound all unlabelled rows end as negatives.
    x, good = blobs(60, 0.7, 4)
    positive = blobs(40, 1.0, 5)[0]
    net = trained(positive, x, 0.7, rounds=1, hidden=64, epochs=300)
    assert (net.score(x)[good] > 0.5).mean() > 0.8


def slow_risk(net, positive, unlabelled, prior):
    """The non-negative risk, row by row; the part that steps go down on."""
    def logit(x):
        h = np.tanh(np.array([sum(x[i] * net.hidden[i, j] for i in range(len(x))) for j in range(len(net.out))]) + net.hidden_bias)
        return float(h @ net.out + net.out_bias[0])

    def loss(z):
        return np.log1p(np.exp(-z))

    gp, gu = [logit(x) for x in positive], [logit(x) for x in unlabelled]
    of_p = prior * np.mean([loss(z) for z in gp])
    of_u = np.mean([loss(-z) for z in gu]) - prior * np.mean([loss(-z) for z in gp])
    return of_p, of_u


def test_risk_and_slopes_against_brute_force():
    x, p = blobs(30, 0.5, 8)[0], blobs(20, 1.0, 9)[0]
    net = quality.start(np.zeros(6, np.float64), np.ones(6), hidden=3)
    net = quality.Network(net.mean, net.scale, *[w.astype(np.float64) for w in net.weights])
    logits = [np.tanh(v @ net.hidden + net.hidden_bias) @ net.out + net.out_bias for v in (p, x)]
    seen = set()
    for prior in (0.2, 3.0):
        of_p, of_u = slow_risk(net, p, x, prior)
        assert quality.risk(*logits, prior) == (pytest.approx(of_p), pytest.approx(of_u))
        seen.add(of_u >= 0)
        found = quality.slopes(net, p, x, prior)
        for w, s in zip(net.weights, found):
            for i in np.ndindex(w.shape):
                old, sides = w[i], []
                for step in (1e-5, -1e-5):
                    w[i] = old + step
                    a, b = slow_risk(net, p, x, prior)
                    sides.append(a + b if of_u >= 0 else -b)
                w[i] = old
                assert s[i] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=2e-4)
    assert seen == {True, False}


def test_every_unlabelled_row_counts(spark):
    """Means, prior counts and rounds read all rows, in whatever tasks they are."""
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (2500, quality.N_FEATURES)).astype(np.float32)
    rows = [(v.tobytes(), i % 2) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vector binary, half long").repartition(7)
    mean, scale = quality._moments(vectors)
    assert np.allclose(mean, x.mean(0), atol=1e-5) and np.allclose(scale, x.std(0) + 1e-3, atol=1e-4)
    # With one task, a round is the steps over its rows.
    one = spark.createDataFrame(rows, "vector binary, half long").coalesce(1)
    net, own = quality.start(mean, scale), quality.start(mean, scale)
    quality._round(one, net, x[:50], 0.6, seed=3, epochs=2)
    quality.steps(own, x[:50], x, 0.6, np.random.default_rng([3, 0]), 2)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(net.weights, own.weights))


def test_features_of_odd_texts():
    for text in [t or "" for t in ODD] + ["\x00", "ÿ" * 50, "\n" * 10]:
        values = quality.features(text)
        assert values.shape == (quality.N_FEATURES,) and np.isfinite(values).all()
    assert not quality.features("").any()


def test_split_is_crc32_of_the_key(spark):
    rows = spark.range(200).select("id", quality.in_split(F.col("id"), 2).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def sample(spark):
    rng = random.Random(6)

    def good(i):
        return " ".join(rng.choice(["tide", "harbour", "the", "of", "salt", "rope"]) for _ in range(80)) + "."

    texts = [good(i) if i % 4 else good(i).upper().replace(" ", "$$$ ") for i in range(600)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 600, 2)], "doc_id bigint, quality int")
    return docs, labels


def test_scores_tell_good_from_bad(spark):
    docs, labels = sample(spark)
    odd = documents(spark, [*ODD, "again", "again"], first=9000)
    rows = quality.quality_scores(docs.unionByName(odd), labels).collect()
    assert len(rows) == 600 + len(ODD) + 2
    assert all(0 <= r.score <= 1 for r in rows)
    right = sum((r.score >= 0.7) == (r.doc_id % 4 > 0) for r in rows if r.doc_id < 600)
    assert right >= 570


def test_held_out_labels_and_other_columns_are_never_inputs(spark):
    docs, labels = sample(spark)
    base = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    held = quality.in_split(labels.doc_id, 2)
    changed = labels.filter(~held).unionByName(labels.filter(held).selectExpr("doc_id", "1 - quality AS quality"))
    other = docs.selectExpr("doc_id", "text", "'zz' AS lang", "'q' AS source", "7 AS score", "1 AS key", "2 AS vector")
    again = {r.doc_id: r.score for r in quality.quality_scores(other, changed).collect()}
    assert again == base


def test_nothing_to_learn_from(spark):
    docs, labels = sample(spark)
    none = quality.quality_scores(docs.limit(3), labels.filter("false"))
    assert [r.score for r in none.collect()] == [0.5] * 3
    assert quality.quality_scores(docs.filter("false"), labels).count() == 0
    null = docs.limit(2).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")
    assert [r.doc_id for r in quality.quality_scores(null, labels).collect()] == [None, None]


def test_registered_query_on_held_out_labels(spark):
    rows = {r.doc_id: r for r in queries.op5_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(rows[x.doc_id].predicted, x.quality) for x in labels if x.doc_id in rows and rows[x.doc_id].held_out]
    assert sum(p == q for p, q in held) / len(held) > 0.95
    assert all(r.predicted == int(r.score >= 0.7) for r in rows.values())
