"""Score model answers against references at table scale, on Spark."""

from .operators.aggregates import (
    accuracy,
    average_scores,
    count_by_task,
    failed_rows,
    gate,
    label_precision_recall_f1,
    metric_names,
    passed_rows,
    score_range_violations,
    summarize,
)
from .operators.corpus import inverse_document_frequencies, term_frequencies
from .operators.joins import align
from .operators.judge import (
    apply_judge,
    attach_verdicts,
    batch_judge,
    judge_requests,
    read_replies,
    row_judge,
    rule_judge,
)
from .operators.report import report_cards, report_results, report_rows, report_statistics
from .operators.scoring import (
    evaluate,
    with_bleu,
    with_cosine_similarity,
    with_exact_match,
    with_metrics,
    with_ngram_precision,
    with_rouge_l,
    with_token_f1,
)
from .operators.selection import find_sample, first_n, spread
from .plans.evaluation import run_evaluation
from .session import build_session
from .sources.reports import read_report, report_runs, write_report
from .sources.requests import pending_requests, read_requests, write_requests
from .sources.samples import conform_samples, read_samples, write_samples
from .streaming.scoring import read_sample_stream, read_summary, start_scoring, start_summary

__all__ = [
    "accuracy",
    "align",
    "apply_judge",
    "attach_verdicts",
    "average_scores",
    "batch_judge",
    "build_session",
    "conform_samples",
    "count_by_task",
    "evaluate",
    "failed_rows",
    "find_sample",
    "first_n",
    "gate",
    "inverse_document_frequencies",
    "judge_requests",
    "label_precision_recall_f1",
    "metric_names",
    "passed_rows",
    "pending_requests",
    "read_replies",
    "read_report",
    "read_requests",
    "report_runs",
    "read_sample_stream",
    "read_samples",
    "read_summary",
    "report_cards",
    "report_results",
    "report_rows",
    "report_statistics",
    "row_judge",
    "rule_judge",
    "run_evaluation",
    "score_range_violations",
    "spread",
    "start_scoring",
    "start_summary",
    "summarize",
    "term_frequencies",
    "with_bleu",
    "with_cosine_similarity",
    "with_exact_match",
    "with_metrics",
    "with_ngram_precision",
    "with_rouge_l",
    "with_token_f1",
    "write_report",
    "write_requests",
    "write_samples",
]
