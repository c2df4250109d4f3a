from __future__ import annotations

import json

import pytest
from conftest import EXPECTED_PASS
from plans import physical
from pyspark.sql import functions as F

from gradeframe.operators import aggregates as A
from gradeframe.operators import report as R
from gradeframe.operators.scoring import METRICS, evaluate
from gradeframe.plans.evaluation import run_evaluation
from gradeframe.plans.tables import samples as table_samples

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(samples):
    return evaluate(samples)


def test_outcomes(results):
    rows = {r.sample_id: r for r in results.collect()}
    assert {k: r.passed for k, r in rows.items()} == EXPECTED_PASS
    for r in rows.values():
        classification = r.task_type == "classification"
        assert (r.exact_match is None) != classification
        for m in ("rouge_l_f1", "rouge_l_recall", "bleu", "cosine_similarity"):
            assert (r[m] is None) == classification
        assert r.token_f1 is not None
        assert r.details.primary_metric == ("exact_match" if classification else "rouge_l_f1")
    assert rows["n03"].rouge_l_f1 == pytest.approx(10 / 12)
    assert rows["n04"].rouge_l_recall == 1.0
    assert rows["n09"].rouge_l_f1 == pytest.approx(1 / 3)
    assert rows["n09"].details.prompt == "Describe the wind."


def test_threshold_is_inclusive(samples):
    at = {r.sample_id: r.passed for r in evaluate(samples, 1.0).collect()}
    assert at["n01"] and at["n11"] and not at["n03"]
    assert evaluate(samples, 0.0).filter("NOT passed").isEmpty()


def test_empty_texts(spark):
    rows = [("c", "", "", "", "classification"), ("g", "", "", "", "generation")]
    df = spark.createDataFrame(rows, "id string, prompt string, reference string, model_output string, task_type string")
    assert {r.sample_id: r.passed for r in evaluate(df).collect()} == {"c": True, "g": False}


def test_summary(results):
    summary = A.summarize(results)
    row = summary.first()
    assert (row.total, row.passed, row.pass_rate) == (11, 6, 6 / 11)
    local = results.toPandas()
    means = {m: local[m].astype(float).mean() for m in METRICS}
    assert row.avg_scores == pytest.approx(means)
    assert {r.metric: r.avg_score for r in A.average_scores(summary).collect()} == row.avg_scores
    assert A.gate(summary, 0.25).first().gate_ok
    assert A.gate(summary, 6 / 11).first().gate_ok
    assert not A.gate(summary, 0.55).first().gate_ok
    assert A.passed_rows(results).count() + A.failed_rows(results).count() == 11
    assert A.score_range_violations(results).isEmpty()


def test_summary_of_nothing_and_of_one_task(results):
    row = A.summarize(results.filter("false")).first()
    assert (row.total, row.passed, row.pass_rate, row.avg_scores) == (0, 0, 0.0, {})
    labels = results.filter("task_type = 'classification'")
    names = {"exact_match", "token_f1"}
    assert set(A.summarize(labels).first().avg_scores) == names
    assert {r.metric for r in A.metric_names(labels).collect()} == names
    assert {r.metric for r in A.metric_names(results).collect()} == set(METRICS)


def test_violations_are_named(results):
    off = results.withColumn("bleu", F.when(F.col("sample_id") == "n03", 1.5).otherwise(F.col("bleu")))
    off = off.withColumn(
        "token_f1",
        F.when(F.col("sample_id") == "n04", F.lit(float("nan"))).otherwise(F.col("token_f1")),
    )
    found = sorted((r.sample_id, r.metric) for r in A.score_range_violations(off).collect())
    assert found == [("n03", "bleu"), ("n04", "token_f1")]


def test_label_metrics(spark):
    df = spark.createDataFrame(
        [("a", "A "), ("b", "b"), ("c", "x"), ("d", "y")], "model_output string, reference string"
    )
    assert A.accuracy(df).first().accuracy == 0.5
    assert A.accuracy(df, normalize=False).first().accuracy == 0.25
    assert tuple(A.label_precision_recall_f1(df).first()) == (0.5, 0.5, 0.5)
    none = df.filter("false")
    assert A.accuracy(none).first().accuracy == 0.0
    assert tuple(A.label_precision_recall_f1(none).first()) == (0.0, 0.0, 0.0)


def test_report_tables(results):
    table = R.report_results(results).withColumn("names", F.map_keys("scores"))
    rows = {r.sample_id: r for r in table.collect()}
    assert rows["n01"].names == ["exact_match", "token_f1"]
    assert rows["n03"].names == [m for m in METRICS if m != "exact_match"]
    assert rows["n09"].scores["cosine_similarity"] == 0.335176
    people = {r.sample_id: r for r in R.report_rows(results).collect()}
    assert people["n01"].status == "通过"
    assert people["n02"].status == "未通过"
    assert people["n01"].score_text == "exact_match=1.0000, token_f1=1.0000"
    assert people["n09"].score_text.startswith("rouge_l_f1=0.3333, rouge_l_recall=0.2000, bleu=0.0000")
    cards = R.report_cards(A.summarize(results)).orderBy("position").collect()
    assert [c.value for c in cards[:3]] == ["11", "6", "0.5455"]
    assert cards[2].percent == "54.55%"
    assert [c.label for c in cards[3:]] == sorted(METRICS)


def test_run_evaluation_stores_scores_and_report(spark, samples, tmp_path):
    results, summary = run_evaluation(spark, samples, str(tmp_path / "new" / "run"), run="first")
    assert results.count() == 11
    assert summary.first().passed == 6
    report = tmp_path / "new" / "run" / "report" / "run=first"
    lines = [
        json.loads(line)
        for part in (report / "results").glob("part-*")
        for line in part.read_text(encoding="utf-8").splitlines()
    ]
    assert {r["sample_id"]: r["passed"] for r in lines} == EXPECTED_PASS
    (part,) = [p for p in (report / "statistics").glob("part-*") if p.stat().st_size]
    statistics = json.loads(part.read_text(encoding="utf-8"))
    assert statistics["total"] == 11 and statistics["avg_scores"]["exact_match"] == 0.6
    assert len(statistics["generated_at"]) == len("2026-01-01T00:00:00")


def test_scoring_moves_no_rows_and_calls_python_once(samples):
    plan = physical(evaluate(samples))
    assert "Exchange" not in plan
    assert plan.count("ArrowEvalPython") == 1


def test_filters_reach_the_scan_and_scores_are_not_evaluated_twice(spark, tmp_path, samples):
    samples.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    plan = physical(evaluate(stored).filter("passed AND task_type = 'generation' AND sample_id = 'n03'"))
    assert "EqualTo(id,n03)" in plan and "EqualTo(task_type,generation)" in plan
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("regexp_extract_all(lower(coalesce(model_output") == 1


def test_summary_shuffles_one_row_per_task_and_reads_no_prompts(spark):
    plan = physical(A.summarize(evaluate(spark.read.parquet(f"{SF}/conversations.parquet").selectExpr(
        "'x' AS id", "'y' AS prompt", "text AS reference", "role AS model_output", "'generation' AS task_type"
    ))))
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan
    assert "conv_id" not in plan


def test_derived_samples_use_unique_join_keys(spark):
    plan = physical(table_samples(spark, SF))
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_metric_names_score_nothing(spark, samples):
    from plans import physical

    assert "Python" not in physical(A.metric_names(samples))
    names = {r.metric for r in A.metric_names(samples.filter("task_type = 'generation'")).collect()}
    assert names == set(METRICS) - {"exact_match"}
    assert A.metric_names(samples.limit(0)).isEmpty()
