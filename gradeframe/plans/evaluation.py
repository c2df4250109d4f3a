"""A whole evaluation run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.aggregates import summarize
from ..operators.scoring import evaluate
from ..operators.selection import spread
from ..sources.reports import write_report


def run_evaluation(
    spark: SparkSession,
    samples: DataFrame,
    path: str,
    threshold: float = 0.5,
    spread_first: bool = False,
    run: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Score samples, store the scores and a report below ``path``.

    Returns the stored results and their summary. Scoring runs once: the summary
    and the report read the stored table, which an executor loss cannot take away.
    ``spread_first`` evens out the partitions beforehand, at the cost of shuffling all
    texts once; use it for unevenly stored samples. ``run`` names the run of the report.
    """
    evaluate(spread(samples) if spread_first else samples, threshold).write.mode("overwrite").parquet(f"{path}/scored")
    results = spark.read.parquet(f"{path}/scored")
    summary = summarize(results)
    write_report(results, summary, f"{path}/report", run)
    return results, summary
