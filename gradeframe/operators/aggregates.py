"""Roll-ups of labels and of scored samples.

Every one is a partial aggregate per task and a final one over a row per task, or
works on a table that such an aggregate made small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from .scoring import CLASSIFICATION, GENERATION, METRICS, METRICS_OF, PRED, REF


def accuracy(
    df: DataFrame, pred: str = PRED, ref: str = REF, normalize: bool = True
) -> DataFrame:
    """One row: the share of rows whose texts are equal, 0.0 without rows."""
    hit = M.exact_match(pred, ref, normalize).cast("double")
    return df.agg(F.coalesce(F.avg(hit), F.lit(0.0)).alias("accuracy"))


def label_precision_recall_f1(df: DataFrame, pred: str = PRED, ref: str = REF) -> DataFrame:
    """One row: micro precision, recall and F1 of one label per row.

    A wrong label is a false positive for itself and a false negative for the true
    one.
    """
    hit = M.exact_match(pred, ref)
    counts = df.agg(F.count_if(hit).alias("tp"), F.count_if(~hit).alias("wrong"))
    predicted = actual = F.col("tp") + F.col("wrong")
    scores = M.precision_recall_f1(F.col("tp"), predicted, actual)
    return counts.select(scores.alias("s")).select("s.*")


def count_by_task(df: DataFrame) -> DataFrame:
    return df.groupBy("task_type").agg(F.count(F.lit(1)).alias("n"))


def passed_rows(results: DataFrame) -> DataFrame:
    return results.filter("passed")


def failed_rows(results: DataFrame) -> DataFrame:
    return results.filter("NOT passed")


def _metric_map() -> Column:
    entries = [part for m in sorted(METRICS) for part in (F.lit(m), F.col(m))]
    return F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())


def summarize(results: DataFrame) -> DataFrame:
    """One row: total, passed, pass_rate and the mean of each metric that occurs.

    A mean is over the rows that have the metric, whatever their task type.
    """
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("passed").alias("passed"),
        *[F.avg(m).alias(m) for m in METRICS],
    ).select(
        "total",
        "passed",
        F.coalesce(F.try_divide(F.col("passed"), F.col("total")), F.lit(0.0)).alias("pass_rate"),
        _metric_map().alias("avg_scores"),
    )


def average_scores(summary: DataFrame) -> DataFrame:
    """The means of a summary as rows (metric, avg_score)."""
    return summary.select(F.explode("avg_scores").alias("metric", "avg_score"))


def metric_names(rows: DataFrame) -> DataFrame:
    """The metrics at least one row has, of samples or of results.

    Which metrics a row has follows from its task type, so nothing is scored.
    """
    classification = F.coalesce(F.col("task_type") == CLASSIFICATION, F.lit(False))
    occurs = {CLASSIFICATION: classification, GENERATION: ~classification}
    present = rows.agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(task) for task, c in occurs.items()])

    def has(metric: str) -> Column:
        return reduce(Column.__or__, [F.col(task) for task, own in METRICS_OF.items() if metric in own])

    names = F.array_compact(F.array(*[F.when(has(m), F.lit(m)) for m in sorted(METRICS)]))
    return present.select(F.explode(names).alias("metric"))


def gate(summary: DataFrame, min_pass_rate: float) -> DataFrame:
    """Add BOOLEAN ``gate_ok``: the pass rate reaches the bar."""
    return summary.withColumn("gate_ok", F.col("pass_rate") >= F.lit(float(min_pass_rate)))


def score_range_violations(results: DataFrame) -> DataFrame:
    """Rows (sample_id, metric, score) for each score outside [0, 1]; none if all is well."""
    outside = {m: F.col(m).isNotNull() & ~F.col(m).between(0.0, 1.0) for m in METRICS}
    scores = F.array_compact(
        F.array(
            *[
                F.when(bad, F.struct(F.lit(m).alias("metric"), F.col(m).alias("score")))
                for m, bad in outside.items()
            ]
        )
    )
    return results.select("sample_id", F.inline(scores))
