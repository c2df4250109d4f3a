"""Metric formulas over the per-row counts, plain codegen-friendly arithmetic."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, as_column, normalize_text

# BLEU replaces a zero precision by this, and scores 4-grams.
BLEU_FLOOR = 1e-12
BLEU_ORDER = 4


def _ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is 0.0 for an empty denominator, also under ANSI mode."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(0.0))


def precision_recall_f1(hits: Column, n_pred: Column, n_ref: Column) -> Column:
    """STRUCT<precision, recall, f1> from hit and size counts."""
    precision, recall = _ratio(hits, n_pred), _ratio(hits, n_ref)
    return F.struct(
        precision.alias("precision"),
        recall.alias("recall"),
        f1_of(precision, recall).alias("f1"),
    )


def f1_of(precision: Column, recall: Column) -> Column:
    return _ratio(F.lit(2.0) * precision * recall, precision + recall)


def exact_match(pred: ColumnOrName, ref: ColumnOrName, normalize: bool = True) -> Column:
    """BOOLEAN: the texts are equal, by default after normalising both."""
    p, r = (F.coalesce(as_column(c), F.lit("")) for c in (pred, ref))
    return normalize_text(p) == normalize_text(r) if normalize else p == r


def ngram_precision(matches: Column, n_pred: Column, n: int) -> Column:
    """Clipped matches over the number of n-grams in the prediction."""
    return F.when(n_pred >= n, _ratio(matches, n_pred - F.lit(n - 1))).otherwise(F.lit(0.0))


def bleu_weights(max_n: int, weights: Sequence[float] | None) -> list[float]:
    if max_n < 1:
        raise ValueError("max_n must be at least 1")
    if weights is None:
        return [1.0 / max_n] * max_n
    if len(weights) < max_n:
        raise ValueError(f"{len(weights)} weights given for n-grams up to {max_n}")
    return [float(w) for w in weights[:max_n]]


def bleu_score(
    matches: Sequence[Column], n_pred: Column, n_ref: Column, weights: Sequence[float]
) -> Column:
    """Smoothed BLEU from the clipped matches of 1-grams, 2-grams, ..."""
    log_sum = F.lit(0.0)
    for n, (m, weight) in enumerate(zip(matches, weights), start=1):
        p_n = ngram_precision(m, n_pred, n)
        log_sum = log_sum + F.lit(weight) * F.log(F.greatest(p_n, F.lit(BLEU_FLOOR)))
    brevity = F.when(n_pred > n_ref, F.lit(1.0)).otherwise(
        F.exp(F.lit(1.0) - F.try_divide(n_ref.cast("double"), n_pred))
    )
    return F.when(n_pred == 0, F.lit(0.0)).otherwise(brevity * F.exp(log_sum))


def smoothed_idf(n_documents: Column, document_frequency: Column) -> Column:
    return F.log((n_documents + 1) / (document_frequency + 1)) + F.lit(1.0)


def cosine_of_overlap(overlap: Column, n_pred: Column, n_ref: Column) -> Column:
    """TF-IDF cosine of two texts, the IDF taken from just these two.

    A token in both texts weighs ln(3/3) + 1 = 1, a token in one of them
    ln(3/2) + 1. The division by text length cancels between the dot product and
    the norms, and whole-number sums make equal texts come out at exactly 1.0.
    """
    single = F.lit((math.log(3 / 2) + 1) ** 2)

    def norm(total: Column, shared: Column) -> Column:
        return shared + single * (total - shared)

    squares = norm(overlap.pred_sq, overlap.shared_pred_sq) * norm(
        overlap.ref_sq, overlap.shared_ref_sq
    )
    cosine = _ratio(overlap.dot, F.sqrt(squares))
    return F.when((n_pred == 0) | (n_ref == 0), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine))
    )
