"""Report tables from scored samples and their summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import fixed_text, round_exact
from .scoring import METRICS, PRED, REF

# The words a report shows.
PASSED_TEXT, FAILED_TEXT = "通过", "未通过"
TOTAL_LABEL, PASSED_LABEL, PASS_RATE_LABEL = "样本总数", "通过数", "通过率"


def report_results(results: DataFrame) -> DataFrame:
    """Detail rows; ``scores`` maps the metrics a row has to values at 6 decimals."""
    entries = [part for m in METRICS for part in (F.lit(m), round_exact(m, 6))]
    scores = F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())
    return results.select(
        "sample_id",
        "task_type",
        "passed",
        scores.alias("scores"),
        F.col("details")[REF].alias(REF),
        F.col("details")[PRED].alias(PRED),
    )


def report_statistics(summary: DataFrame) -> DataFrame:
    """The summary row and the time of the report, to the second."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return summary.select(now.alias("generated_at"), *summary.columns)


def report_rows(results: DataFrame) -> DataFrame:
    """Detail rows for people: a status word and the scores as text at 4 decimals."""
    score_text = F.concat_ws(
        ", ", *[F.concat(F.lit(f"{m}="), fixed_text(m, 4)) for m in METRICS]
    )
    return results.select(
        "sample_id",
        "task_type",
        F.when(F.col("passed"), F.lit(PASSED_TEXT)).otherwise(F.lit(FAILED_TEXT)).alias("status"),
        score_text.alias("score_text"),
        F.col("details")[REF].alias(REF),
        F.col("details")[PRED].alias(PRED),
    )


def report_cards(summary: DataFrame) -> DataFrame:
    """Rows (position, label, value, percent) for the head of a report.

    Totals, the pass rate at 4 decimals (and as a percentage at 2), then the metric
    means at 4 decimals by name.
    """

    def card(label: Column, value: Column, percent: Column | None = None) -> Column:
        return F.struct(
            label.alias("label"),
            value.alias("value"),
            (F.lit(None).cast("string") if percent is None else percent).alias("percent"),
        )

    rate = F.col("pass_rate")
    percent = F.concat(fixed_text(rate * F.lit(100.0), 2), F.lit("%"))
    head = F.array(
        card(F.lit(TOTAL_LABEL), F.col("total").cast("string")),
        card(F.lit(PASSED_LABEL), F.col("passed").cast("string")),
        card(F.lit(PASS_RATE_LABEL), fixed_text(rate, 4), percent),
    )
    means = F.transform(
        F.array_sort(F.map_entries("avg_scores")),
        lambda e: card(e.key, fixed_text(e.value, 4)),
    )
    return summary.select(
        F.posexplode(F.concat(head, means)).alias("position", "card")
    ).select("position", "card.*")
