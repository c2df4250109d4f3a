"""The registered queries: every operator over the whole of the given tables.

Scores are rounded to 6 decimals for comparison, because engines add up floating
point numbers in different orders.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.multisets import intersection_size
from ..functions.text import ngrams, normalize_text, tokenize
from ..operators import aggregates, corpus, joins, judge, report, scoring, selection
from ..session import shared_folder
from ..sources.reports import read_report
from ..sources.requests import read_requests, write_requests
from ..sources.samples import read_samples, write_samples
from ..streaming.scoring import read_sample_stream, read_summary, start_scoring, start_summary
from . import tables
from .evaluation import run_evaluation

Query = Callable[[SparkSession, str], DataFrame]

GATE_BAR = 0.25
WEIGHTS = (0.7, 0.3)

# About how much text goes into a JSON document, which is written by one task: several
# splits of Spark's for its readers, and far less than a task can stream.
DOCUMENT_BYTES = 256 * 1024 * 1024


def _six(name: str | Column, alias: str | None = None) -> Column:
    column = F.col(name) if isinstance(name, str) else name
    return F.round(column, 6).alias(alias or name)


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = tables.samples(spark, folder).select("id", "model_output", "reference")
    return selection.spread(pairs)


def _results(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.evaluate(selection.spread(tables.samples(spark, folder)))


def _flat(results: DataFrame) -> DataFrame:
    return results.select(
        "sample_id",
        "task_type",
        "passed",
        *[_six(m) for m in scoring.METRICS],
        F.col("details.primary_metric").alias("primary_metric"),
    )


def _scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    unique = spark.sql("SELECT uuid()").first()[0]
    return f"{shared_folder(spark)}/gradeframe-{name}-{unique}"


def load_samples(spark: SparkSession, folder: str) -> DataFrame:
    return tables.samples(spark, folder).withColumn("metadata", F.to_json("metadata"))


def stored_samples(spark: SparkSession, folder: str) -> DataFrame:
    path = _scratch(spark, "samples")
    write_samples(tables.samples(spark, folder), path)
    return read_samples(spark, path).withColumn("metadata", F.to_json("metadata"))


def document_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Samples written as JSON documents, which are cut to be read: two documents, or as
    many as keep each to ``DOCUMENT_BYTES`` of text."""
    path = _scratch(spark, "documents")
    n = max(2, math.ceil(tables.text_bytes(spark, folder) / DOCUMENT_BYTES))
    write_samples(tables.samples(spark, folder).coalesce(n), path, "json")
    return read_samples(spark, path, "json").withColumn("metadata", F.to_json("metadata"))


def wrapped_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that each wrap a sample and its counterpart with the texts swapped."""
    path = _scratch(spark, "wrapped")
    pair = F.array(
        F.struct("id", "prompt", "reference", "model_output", "task_type"),
        F.struct(
            F.concat("id", F.lit("-swapped")).alias("id"),
            "prompt",
            F.col("model_output").alias("reference"),
            F.col("reference").alias("model_output"),
            F.lit("cls").alias("task_type"),
        ),
    )
    tables.samples(spark, folder).select(F.lit("v1").alias("version"), pair.alias("samples")).write.json(path)
    return read_samples(spark, path).drop("metadata")


def task_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.count_by_task(tables.samples(spark, folder))


def normalize_tokenize(spark: SparkSession, folder: str) -> DataFrame:
    documents = selection.spread(tables.table(spark, folder, "documents").select("doc_id", "text"))
    return (
        documents.select("doc_id", normalize_text("text").alias("normalized"), tokenize("text").alias("t"))
        .select(
            "doc_id",
            "normalized",
            F.size("t").cast("bigint").alias("n_tokens"),
            F.array_join("t", " ").alias("tokens"),
        )
    )


def ngram_lists(spark: SparkSession, folder: str) -> DataFrame:
    turns = selection.spread(tables.table(spark, folder, "conversations").select("conv_id", "turn", "text"))
    tokens = turns.select("conv_id", "turn", tokenize("text").alias("t"))
    return tokens.select(
        "conv_id",
        "turn",
        *[F.array_join(ngrams("t", n), "|").alias(f"grams_{n}") for n in (0, 1, 2, 3, 4)],
    )


def exact_match(spark: SparkSession, folder: str) -> DataFrame:
    return (
        tables.samples(spark, folder)
        .select("id", "model_output", "reference")
        .transform(scoring.with_exact_match)
        .transform(scoring.with_exact_match, normalize=False, output="exact_match_raw")
        .select("id", "exact_match", "exact_match_raw")
    )


def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    aligned = align_strict(spark, folder)
    return aggregates.accuracy(aligned, "pred", "label").select(_six("accuracy"))


def label_scores(spark: SparkSession, folder: str) -> DataFrame:
    aligned = align_matched(spark, folder)
    scores = aggregates.label_precision_recall_f1(aligned, "pred", "label")
    return scores.select(*[_six(c) for c in scores.columns])


def align_strict(spark: SparkSession, folder: str) -> DataFrame:
    preds, labels = tables.predicted_labels(spark, folder), tables.reference_labels(spark, folder)
    return joins.align(preds, labels, on="doc_id")


def align_matched(spark: SparkSession, folder: str) -> DataFrame:
    return joins.align(
        tables.predicted_labels(spark, folder),
        tables.true_labels(spark, folder),
        on="doc_id",
        how="matched",
    )


def token_f1(spark: SparkSession, folder: str) -> DataFrame:
    scored = scoring.with_token_f1(_pairs(spark, folder))
    return scored.select(
        "id", *[_six(F.col(f"token_f1.{c}"), c) for c in ("precision", "recall", "f1")]
    )


def token_overlap(spark: SparkSession, folder: str) -> DataFrame:
    tokens = _pairs(spark, folder).select(
        "id", tokenize("model_output").alias("p"), tokenize("reference").alias("r")
    )
    return tokens.select(
        "id",
        intersection_size("p", "r").cast("bigint").alias("common_tokens"),
        F.size(F.array_intersect("p", "r")).cast("bigint").alias("shared_words"),
        F.size(F.array_union("p", "r")).cast("bigint").alias("all_words"),
    )


def modified_precision(spark: SparkSession, folder: str) -> DataFrame:
    df = _pairs(spark, folder)
    orders = (1, 2, 3, 4)
    for n in orders:
        df = scoring.with_ngram_precision(df, n)
    return df.select("id", *[_six(f"precision_{n}") for n in orders])


def bleu(spark: SparkSession, folder: str) -> DataFrame:
    scored = scoring.with_bleu(_pairs(spark, folder))
    return scored.select("id", _six("bleu"))


def bleu_weighted(spark: SparkSession, folder: str) -> DataFrame:
    scored = scoring.with_bleu(_pairs(spark, folder), max_n=len(WEIGHTS), weights=WEIGHTS)
    return scored.select("id", _six("bleu"))


def cosine(spark: SparkSession, folder: str) -> DataFrame:
    scored = scoring.with_cosine_similarity(_pairs(spark, folder))
    return scored.select("id", _six("cosine_similarity"))


def term_frequency(spark: SparkSession, folder: str) -> DataFrame:
    documents = tables.table(spark, folder, "documents").select("doc_id", "text")
    terms = corpus.term_frequencies(selection.spread(documents), "doc_id", "text")
    return terms.select("doc_id", "term", F.col("count").cast("bigint").alias("n"), _six("tf"))


def corpus_idf(spark: SparkSession, folder: str) -> DataFrame:
    documents = selection.spread(tables.table(spark, folder, "documents").select("text"))
    terms = corpus.inverse_document_frequencies(documents, "text")
    return terms.select("term", "document_frequency", _six("idf"))


def rouge_l(spark: SparkSession, folder: str) -> DataFrame:
    scored = scoring.with_rouge_l(_pairs(spark, folder))
    return scored.select(
        "id",
        F.col("rouge_l.lcs").cast("bigint").alias("lcs"),
        *[_six(F.col(f"rouge_l.{c}"), c) for c in ("precision", "recall", "f1")],
    )


def evaluate(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_results(spark, folder))


def evaluate_stream(spark: SparkSession, folder: str) -> DataFrame:
    source, scored, log = (_scratch(spark, name) for name in ("source", "scored", "log"))
    write_samples(tables.samples(spark, folder), source)
    stream = read_sample_stream(spark, source, max_files=1000)
    start_scoring(stream, scored, log).awaitTermination()
    return _flat(spark.read.parquet(scored))


def summary_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The summary that a stream has come to after its samples, half of them sent twice."""
    source, output, log = (_scratch(spark, name) for name in ("source", "running", "log"))
    samples = tables.samples(spark, folder)
    write_samples(samples, source)
    write_samples(samples.filter(F.crc32(F.col("id").cast("binary")) % 2 == 0), source, mode="append")
    stream = read_sample_stream(spark, source, max_files=1000, arrived="arrived")
    start_summary(stream, output, log, replays="1 hour").awaitTermination()
    return read_summary(spark, output).select("total", "passed", _six("pass_rate"))


def summary(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.summarize(_results(spark, folder)).select(
        "total", "passed", _six("pass_rate")
    )


def avg_scores(spark: SparkSession, folder: str) -> DataFrame:
    means = aggregates.average_scores(aggregates.summarize(_results(spark, folder)))
    return means.select("metric", _six("avg_score"))


def metric_names(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.metric_names(tables.samples(spark, folder))


def passed_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(aggregates.passed_rows(_results(spark, folder)))


def failed_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(aggregates.failed_rows(_results(spark, folder)))


def gate(spark: SparkSession, folder: str) -> DataFrame:
    summary = aggregates.summarize(_results(spark, folder))
    return aggregates.gate(summary, GATE_BAR).select("total", "passed", "gate_ok")


def score_range_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of some samples are first put out of range, by a rule on their ids."""
    off = _results(spark, folder).withColumns(
        {
            "bleu": F.when(F.col("sample_id").endswith("-3"), F.col("bleu") + 2).otherwise(F.col("bleu")),
            "token_f1": F.when(F.col("sample_id").like("doc-%7"), F.col("token_f1") - 2).otherwise(F.col("token_f1")),
        }
    )
    return aggregates.score_range_violations(off).select("sample_id", "metric", _six("score"))


def rule_judge(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge.rule_judge(tables.samples(spark, folder))
    return judged.select(
        "id",
        "score",
        "reason",
        *[_six(F.variant_get("raw", f"$.{c}", "double"), c) for c in ("f1", "cosine")],
    )


def apply_judge(spark: SparkSession, folder: str) -> DataFrame:
    def compare_lengths(prompt: str, reference: str, answer: str) -> tuple[float, str, str]:
        share = min(len(answer), len(reference)) / max(len(answer), len(reference), 1)
        return share, f"{len(answer)} of {len(reference)}", f'{{"prompt": {len(prompt)}}}'

    judged = judge.apply_judge(
        tables.samples(spark, folder), judge.row_judge(compare_lengths)
    )
    return judged.select(
        "id", _six("score"), "reason", F.variant_get("raw", "$.prompt", "bigint").alias("raw")
    )


def apply_batch_judge(spark: SparkSession, folder: str) -> DataFrame:
    def start() -> judge.BatchJudge:
        def compare_lengths(texts: list[tuple[str, str, str]]) -> list[tuple[float, str, str]]:
            sizes = [(len(prompt), len(ref), len(answer)) for prompt, ref, answer in texts]
            return [
                (min(a, r) / max(a, r, 1), f"{a} of {r}", f'{{"prompt": {p}}}') for p, r, a in sizes
            ]

        return compare_lengths

    judged = judge.apply_judge(tables.samples(spark, folder), judge.batch_judge(start, rows=100))
    return judged.select(
        "id", _six("score"), "reason", F.variant_get("raw", "$.prompt", "bigint").alias("raw")
    )


def judge_requests(spark: SparkSession, folder: str) -> DataFrame:
    return judge.judge_requests(tables.samples(spark, folder))


def pending_requests(spark: SparkSession, folder: str) -> DataFrame:
    path = _scratch(spark, "requests")
    asked = judge.judge_requests(tables.samples(spark, folder))
    write_requests(asked, path, tables.reply_records(spark, folder), rows_per_file=1000)
    return read_requests(spark, path)


def judge_replies(spark: SparkSession, folder: str) -> DataFrame:
    replies = judge.read_replies(tables.reply_records(spark, folder))
    return replies.select("id", _six("score"), "reason", "status")


def attach_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    verdicts = judge.read_replies(tables.reply_records(spark, folder))
    judged = judge.attach_verdicts(tables.samples(spark, folder), verdicts)
    return judged.select("id", "task_type", _six("score"), "reason")


def report_results(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_report(report.report_results(_results(spark, folder)))


def stored_report(spark: SparkSession, folder: str) -> DataFrame:
    path = _scratch(spark, "run")
    run_evaluation(spark, tables.samples(spark, folder), path, run="stored")
    return _flat_report(read_report(spark, f"{path}/report", "stored")[0])


def _flat_report(rows: DataFrame) -> DataFrame:
    return rows.select(
        "sample_id",
        "task_type",
        "passed",
        *[F.try_element_at("scores", F.lit(m)).alias(m) for m in scoring.METRICS],
        "reference",
        "model_output",
    )


def report_statistics(spark: SparkSession, folder: str) -> DataFrame:
    statistics = report.report_statistics(aggregates.summarize(_results(spark, folder)))
    return statistics.select(
        "total",
        "passed",
        _six("pass_rate"),
        *[_six(F.try_element_at("avg_scores", F.lit(m)), m) for m in scoring.METRICS],
    )


def report_rows(spark: SparkSession, folder: str) -> DataFrame:
    return report.report_rows(_results(spark, folder))


def report_cards(spark: SparkSession, folder: str) -> DataFrame:
    cards = report.report_cards(aggregates.summarize(_results(spark, folder)))
    return cards.withColumn("position", F.col("position").cast("bigint"))


def first_n(spark: SparkSession, folder: str) -> DataFrame:
    first = selection.first_n(tables.samples(spark, folder), 4)
    return first.select("id", "task_type", "prompt", "reference", "model_output")


def first_n_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """All answers of a conversation share an id here, so other columns settle the ties."""
    shared = tables.samples(spark, folder).withColumn("id", F.split_part("id", F.lit("-"), F.lit(1)))
    first = selection.first_n(shared.drop("metadata"), 12)
    return first.select("id", "task_type", "prompt", "reference", "model_output")


def find_sample(spark: SparkSession, folder: str) -> DataFrame:
    found = selection.find_sample(tables.samples(spark, folder), "0-1")
    return found.select("id", "task_type", "prompt", "reference", "model_output")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        load_samples,
        stored_samples,
        document_samples,
        wrapped_samples,
        task_type_counts,
        normalize_tokenize,
        ngram_lists,
        exact_match,
        accuracy,
        label_scores,
        align_strict,
        align_matched,
        token_f1,
        token_overlap,
        modified_precision,
        bleu,
        bleu_weighted,
        cosine,
        term_frequency,
        corpus_idf,
        rouge_l,
        evaluate,
        evaluate_stream,
        summary_stream,
        summary,
        avg_scores,
        metric_names,
        passed_rows,
        failed_rows,
        gate,
        score_range_violations,
        rule_judge,
        apply_judge,
        apply_batch_judge,
        judge_requests,
        pending_requests,
        judge_replies,
        attach_verdicts,
        report_results,
        stored_report,
        report_statistics,
        report_rows,
        report_cards,
        first_n,
        first_n_repeated,
        find_sample,
    )
}
