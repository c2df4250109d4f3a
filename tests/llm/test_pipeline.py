from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gradeframe.llm import decontamination, quality, queries, secrets, simhash
from test_decontamination import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of every stage, each read again from Parquet, by name."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(folder / str(i)))
        docs = spark.read.parquet(str(folder / str(i)))
        found.append(docs)
    return [{r.doc_id: r for r in df.collect()} for df in found]


def test_stages_return_documents(stages):
    for rows in stages[1:-1]:
        assert list(next(iter(rows.values())).asDict()) == corpus_pipeline.COLUMNS
    for before, after in zip(stages, stages[1:]):
        assert set(after) <= set(before)


def test_quality_keeps_what_the_classifier_accepts(spark, stages):
    scores = queries.op5_quality(spark, SF).collect()
    assert set(stages[1]) == {r.doc_id for r in scores if r.score >= corpus_pipeline.QUALITY_BAR}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1 and d in stages[0]]
    assert sum(d in stages[1] for d in good) / len(good) > 0.98


def test_dedup_keeps_the_first_of_each_group(spark, stages):
    prints = {d: simhash.fingerprint(r.text) for d, r in stages[1].items()}
    distinct = sorted(set(prints.values()))
    close = [
        (a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    ]
    root = {p: p for p in distinct}
    for _ in distinct:
        before = dict(root)
        for a, b in close:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    first = {}
    for d in sorted(prints):
        first.setdefault(root[prints[d]], d)
    assert set(stages[2]) == set(first.values())


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = brute([r.text for r in stages[2].values()], items)
    assert set(stages[3]) == {d for d, (_, n, _) in zip(stages[2], hit) if n == 0}


def test_secrets_are_masked_and_documents_stay(stages):
    assert set(stages[4]) == set(stages[3])
    for d, r in stages[4].items():
        spans = secrets.find_parts(stages[3][d].text)
        if not spans:
            assert r == stages[3][d]
        for kind, start, end in spans:
            if kind in secrets.SURE:
                assert stages[3][d].text[start:end] not in r.text
        assert r.n_chars == len(r.text)
    assert any("[SECRET]" in r.text for r in stages[4].values())


def test_the_sample_follows_its_probabilities(stages):
    assert 0 < len(stages[5]) <= len(stages[4])
    for d, r in stages[5].items():
        assert r.text == stages[4][d].text and 0 < r.probability <= 1
        assert r.n_tokens == len(re.findall(r"[^\x20\x09-\x0D]+", r.text))


def test_run_is_the_stages_in_turn(spark, stages):
    assert {r.doc_id for r in queries.pipeline(spark, SF).collect()} == set(stages[5])


def test_odd_documents_pass_through(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x " * 60_000, None, "s", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.withColumn("key", F.lit(1)).withColumn("score", F.lit("x"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in kept} <= {None, 1, 2}
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs.filter("false"), str(tmp_path)).write.format("noop").mode("overwrite").save()


def test_operators_come_from_their_modules():
    assert len(corpus_pipeline.STAGES) == 5
    assert quality.fit and decontamination.uncontaminated
