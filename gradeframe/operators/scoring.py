"""Scoring operators: DataFrame in, DataFrame with score columns out.

Each one is usable with ``df.transform`` and works on batch and streaming
tables alike. None of them shuffles: a row holds both of its texts, so every
score is worked out where the row was read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.multisets import intersection_size, ngram_matches, unigram_overlap
from ..functions.subsequence import lcs_length
from ..functions.text import tokenize

PRED, REF = "model_output", "reference"
CLASSIFICATION, GENERATION = "classification", "generation"

# Score columns, in an order that fits the one reports use for either task type.
METRICS = (
    "exact_match",
    "rouge_l_f1",
    "rouge_l_recall",
    "bleu",
    "token_f1",
    "cosine_similarity",
)
METRICS_OF = {
    CLASSIFICATION: ("exact_match", "token_f1"),
    GENERATION: ("rouge_l_f1", "rouge_l_recall", "bleu", "token_f1", "cosine_similarity"),
}
PRIMARY_METRIC = {CLASSIFICATION: "exact_match", GENERATION: "rouge_l_f1"}

# Working columns, dropped before a result is returned.
_MARK = "__gf_"
_P, _R, _SAME, _UNIGRAMS = (
    f"{_MARK}pred_tokens",
    f"{_MARK}ref_tokens",
    f"{_MARK}same",
    f"{_MARK}unigrams",
)
_N_PRED, _N_REF, _COMMON, _COSINE, _LCS, _PLAIN_MATCHES = (
    f"{_MARK}n_pred",
    f"{_MARK}n_ref",
    f"{_MARK}common",
    f"{_MARK}cosine",
    f"{_MARK}lcs",
    f"{_MARK}matches",
)


def _matches(n: int) -> str:
    """Column with the clipped matches of the n-grams."""
    return _COMMON if n == 1 else f"{_MARK}matches_{n}"


def _tokens(df: DataFrame, pred: str, ref: str) -> DataFrame:
    return (
        df.withColumns({_P: tokenize(pred), _R: tokenize(ref)})
        # Texts with equal tokens need no counting.
        .withColumns({_SAME: F.col(_P) == F.col(_R), _N_PRED: F.size(_P), _N_REF: F.size(_R)})
    )


def _unigrams(df: DataFrame) -> DataFrame:
    overlap = F.col(_UNIGRAMS)
    cosine = M.cosine_of_overlap(overlap, F.col(_N_PRED), F.col(_N_REF))
    return df.withColumn(_UNIGRAMS, F.when(~F.col(_SAME), unigram_overlap(_P, _R))).withColumns(
        {
            _COMMON: F.when(F.col(_SAME), F.col(_N_PRED)).otherwise(overlap.common),
            _COSINE: F.when(
                F.col(_SAME), F.when(F.col(_N_PRED) > 0, F.lit(1.0)).otherwise(F.lit(0.0))
            ).otherwise(cosine),
        }
    )


def _ngrams(df: DataFrame, max_n: int, where: Column | None = None) -> DataFrame:
    """Clipped matches of the 2-grams and up, each order only where the one below matched."""
    wanted = F.lit(True) if where is None else where
    for n in range(2, max_n + 1):
        df = df.withColumn(
            _matches(n),
            F.when(F.col(_SAME), F.greatest(F.col(_N_PRED) - F.lit(n - 1), F.lit(0)))
            .when(wanted & (F.col(_matches(n - 1)) > 0), ngram_matches(_P, _R, n))
            .otherwise(F.lit(0)),
        )
    return df


def _lcs(df: DataFrame, where: Column | None = None, common: str | None = None) -> DataFrame:
    return df.withColumn(
        _LCS, lcs_length(_P, _R, where, common=None if common is None else F.col(common))
    )


def _settled(df: DataFrame, counts: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Keep the working columns ``counts`` (and the sizes), each evaluated once per row.

    Catalyst pushes a later filter on a score below the projection that defines it
    and so evaluates the whole chain a second time, Python included. It does not
    push what a generator puts out, while filters on the input columns still reach
    the scan. What is computed above the generator from the columns ``keep`` is only
    evaluated for the rows such a filter lets through, if at all.
    """
    inputs = [c for c in df.columns if not c.startswith(_MARK)]
    row = F.struct(_N_PRED, _N_REF, *counts)
    return df.select(*inputs, *keep, F.inline(F.array(row)))


def _add(df: DataFrame, output: str, score: Column) -> DataFrame:
    kept = [c for c in df.columns if not c.startswith(_MARK) and c != output]
    return df.select(*kept, score.alias(output))


def with_exact_match(
    df: DataFrame,
    pred: str = PRED,
    ref: str = REF,
    normalize: bool = True,
    output: str = "exact_match",
) -> DataFrame:
    """Add a BOOLEAN: the texts are equal."""
    return df.withColumn(output, M.exact_match(pred, ref, normalize))


def _overlap_scores(hits: str) -> Column:
    return M.precision_recall_f1(F.col(hits), F.col(_N_PRED), F.col(_N_REF))


def with_token_f1(
    df: DataFrame, pred: str = PRED, ref: str = REF, output: str = "token_f1"
) -> DataFrame:
    """Add a STRUCT<precision, recall, f1> over the token multisets."""
    return (
        df.transform(_tokens, pred, ref)
        .transform(_unigrams)
        .transform(_settled, [_COMMON])
        .transform(_add, output, _overlap_scores(_COMMON))
    )


def with_rouge_l(
    df: DataFrame, pred: str = PRED, ref: str = REF, output: str = "rouge_l"
) -> DataFrame:
    """Add a STRUCT<precision, recall, f1, lcs>."""
    score = _overlap_scores(_LCS).withField("lcs", F.col(_LCS))
    return (
        df.transform(_tokens, pred, ref)
        .withColumn(_COMMON, intersection_size(_P, _R))
        .transform(_lcs, None, _COMMON)
        .transform(_settled, [_LCS])
        .transform(_add, output, score)
    )


def with_ngram_precision(
    df: DataFrame, n: int, pred: str = PRED, ref: str = REF, output: str | None = None
) -> DataFrame:
    """Add the clipped n-gram precision; 0.0 where the prediction has no n-gram."""
    matches = ngram_matches(_P, _R, n) if n >= 1 else F.lit(0)
    score = (
        M.ngram_precision(F.col(_PLAIN_MATCHES), F.col(_N_PRED), n) if n >= 1 else F.lit(0.0)
    )
    return (
        df.transform(_tokens, pred, ref)
        .withColumn(_PLAIN_MATCHES, matches)
        .transform(_settled, [_PLAIN_MATCHES])
        .transform(_add, output or f"precision_{n}", score)
    )


def _bleu(weights: Sequence[float]) -> Column:
    matches = [F.col(_matches(n)) for n in range(1, len(weights) + 1)]
    return M.bleu_score(matches, F.col(_N_PRED), F.col(_N_REF), weights)


def with_bleu(
    df: DataFrame,
    max_n: int = M.BLEU_ORDER,
    weights: Sequence[float] | None = None,
    pred: str = PRED,
    ref: str = REF,
    output: str = "bleu",
) -> DataFrame:
    """Add smoothed BLEU over 1-grams to ``max_n``-grams.

    ``weights`` default to equal ones; there must be ``max_n`` of them at least.
    """
    used = M.bleu_weights(max_n, weights)
    return (
        df.transform(_tokens, pred, ref)
        .withColumn(_COMMON, intersection_size(_P, _R))
        .transform(_ngrams, max_n)
        .transform(_settled, [_matches(n) for n in range(1, max_n + 1)])
        .transform(_add, output, _bleu(used))
    )


def with_cosine_similarity(
    df: DataFrame, pred: str = PRED, ref: str = REF, output: str = "cosine_similarity"
) -> DataFrame:
    """Add the TF-IDF cosine of the two texts, in [0, 1]."""
    return (
        df.transform(_tokens, pred, ref)
        .transform(_unigrams)
        .transform(_settled, [_COSINE])
        .transform(_add, output, F.col(_COSINE))
    )


def with_token_f1_and_cosine(
    df: DataFrame, f1: str, cosine: str, pred: str = PRED, ref: str = REF
) -> DataFrame:
    """Add token F1 and cosine from one pass over the tokens."""
    kept = [c for c in df.columns if c not in (f1, cosine)]
    return (
        df.transform(_tokens, pred, ref)
        .transform(_unigrams)
        .transform(_settled, [_COMMON, _COSINE])
        .select(*kept, _overlap_scores(_COMMON).f1.alias(f1), F.col(_COSINE).alias(cosine))
    )


def with_metrics(
    df: DataFrame, metrics: Sequence[str], pred: str = PRED, ref: str = REF
) -> DataFrame:
    """Add several metrics, each as its own ``with_...`` would, from one pass over the tokens.

    ``metrics`` may name ``token_f1``, ``rouge_l``, ``bleu`` (up to 4-grams, equal weights)
    and ``cosine_similarity``; columns of these names are replaced.
    """
    scores = {
        "token_f1": _overlap_scores(_COMMON),
        "rouge_l": _overlap_scores(_LCS).withField("lcs", F.col(_LCS)),
        "bleu": _bleu(M.bleu_weights(M.BLEU_ORDER, None)),
        "cosine_similarity": F.col(_COSINE),
    }
    unknown = [m for m in metrics if m not in scores]
    if unknown:
        raise ValueError(f"unknown metrics {', '.join(unknown)}")
    rows = df.transform(_tokens, pred, ref).transform(_unigrams)
    counts = [_COMMON, _COSINE]
    if "rouge_l" in metrics:
        rows, counts = rows.transform(_lcs, None, _COMMON), [*counts, _LCS]
    rows = rows.transform(_settled, counts, keep=[_P, _R, _SAME])
    if "bleu" in metrics:
        rows = rows.transform(_ngrams, M.BLEU_ORDER)
    kept = [c for c in df.columns if c not in metrics]
    return rows.select(*kept, *[scores[m].alias(m) for m in dict.fromkeys(metrics)])


def evaluate(samples: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Score samples with the metrics of their task type and decide pass or fail.

    A metric that does not apply to a row's task type is NULL there. A row passes
    when its primary metric reaches ``threshold``.
    """
    classification = F.coalesce(F.col("task_type") == CLASSIFICATION, F.lit(False))
    generation = ~classification
    max_n = M.BLEU_ORDER
    rouge = _overlap_scores(_LCS)
    scores = {
        "exact_match": F.when(classification, M.exact_match(PRED, REF).cast("double")),
        "token_f1": _overlap_scores(_COMMON).f1,
        "rouge_l_f1": F.when(generation, rouge.f1),
        "rouge_l_recall": F.when(generation, rouge.recall),
        "bleu": F.when(generation, _bleu(M.bleu_weights(max_n, None))),
        "cosine_similarity": F.when(generation, F.col(_COSINE)),
    }
    primary = F.coalesce(
        *[
            F.when(applies, F.col(PRIMARY_METRIC[task]))
            for task, applies in ((CLASSIFICATION, classification), (GENERATION, generation))
        ],
        F.lit(0.0),
    )
    primary_name = F.when(classification, F.lit(PRIMARY_METRIC[CLASSIFICATION])).otherwise(
        F.lit(PRIMARY_METRIC[GENERATION])
    )
    return (
        samples.select("id", "task_type", "prompt", REF, PRED)
        .transform(_tokens, PRED, REF)
        .transform(_unigrams)
        .transform(_lcs, generation, _COMMON)
        .transform(_settled, [_COMMON, _COSINE, _LCS], keep=[_P, _R, _SAME])
        .transform(_ngrams, max_n, generation)
        .withColumns(scores)
        .select(
            F.col("id").alias("sample_id"),
            "task_type",
            (primary >= F.lit(float(threshold))).alias("passed"),
            *METRICS,
            F.struct("prompt", REF, PRED, primary_name.alias("primary_metric")).alias(
                "details"
            ),
        )
    )
