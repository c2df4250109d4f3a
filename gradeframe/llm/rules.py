"""Quality rules whose cutoffs are guaranteed to reject few good documents."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import column, map_texts, ship_by_value, small, stored

_WHITE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper"]
# What documents are ranked by, all shares between 0 and 1.
RULES = ["symbol_share", "dup_line_share", "repeat_share", "upper_share"]
_SCHEMA = ", ".join(f"{c} bigint" for c in [*COUNTS, "n_lines"])


def measure(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_lines.

    Words are runs of anything but ASCII white space. A duplicate line has a word and
    equals an earlier line. A repeated word lies in a window of three words that the text
    has twice or more. Upper-case letters are A-Z; lines are those with a word.
    """
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * 7
    word_chars = len(text) - sum(map(text.count, _WHITE))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        covered = 0  # words before this one are counted
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    upper = sum(map(raw.count, _UPPER))
    return n, word_chars, symbols, len(lines) - len(set(lines)), repeated, upper, len(lines)


_UPPER = [bytes([b]) for b in range(65, 91)]


def with_measures(df: DataFrame, keep_text: bool = False) -> DataFrame:
    """Add the counts of ``measure`` and the shares that rules look at."""

    def run(texts: list[str]) -> list[pa.Array]:
        columns = list(zip(*map(measure, texts))) or [()] * 7
        return [pa.array(c, pa.int64()) for c in columns]

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return map_texts(df, run, _SCHEMA, keep_text).withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "upper_share": share("n_upper", "word_chars"),
        }
    )


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed exactly in logarithms."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    log_p, log_q, top = math.log(p), math.log1p(-p), math.lgamma(n + 1)
    terms = [
        top - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q for i in range(k + 1)
    ]
    largest = max(terms)
    return min(1.0, math.exp(largest) * math.fsum(math.exp(t - largest) for t in terms))


@dataclass(frozen=True)
class Risk:
    """The guarantee: with probability ``1 - delta``, in no stratum do the cutoffs reject
    more than ``alpha`` of the good documents. Cutoffs are multiples of ``1 / steps``."""

    alpha: float = 0.04
    delta: float = 0.1
    steps: int = 200


def certified(n: int, rejected: list[int], alpha: float, delta: float) -> int:
    """The number of cutoffs, from the laxest on, that are certified.

    ``rejected[i]`` of ``n`` good documents fall to cutoff i, more from one to the next.
    Each is tested by the exact binomial bound at level ``delta``; as they are tested in
    order and testing ends at the first failure, that level holds for all of them (fixed
    sequence testing), with no division by their number.
    """
    for i, k in enumerate(rejected):
        if binomial_tail(k, n, alpha) > delta:
            return i
    return len(rejected)


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, risk: Risk = Risk()) -> DataFrame:
    """Rows (stratum, rule, cutoff): documents above a cutoff may be rejected.

    ``measured`` holds (key, stratum, shares...), ``labels`` (key, label). Holdout documents
    are good if any of their labels is 1, otherwise bad; they are counted by stratum, rule
    and step, so that what one task gets is bounded by the number of steps whatever the
    number of documents. The risk ``alpha`` is shared out evenly over the rules, which a
    document may fall to in turn, and ``delta`` over all rules and strata (Bonferroni). As
    all certified cutoffs hold at once, any may be picked: it is the one that rejects the
    most bad less good documents, the laxest of equals. A stratum with too few good
    documents has no cutoff: the bound cannot be met there, so nothing is rejected.
    """
    marked = labels.filter("label IS NOT NULL").groupBy("key").agg(F.max(F.col("label") == 1).alias("good"))
    holdout = measured.join(marked, "key")
    step = F.struct(*[F.ceil(F.col(r) * risk.steps).cast("int").alias(r) for r in RULES])
    steps = holdout.select(stratum, "good", step.alias("s")).select(stratum, "good", "s.*")
    counts = (
        steps.unpivot([stratum, "good"], RULES, "rule", "step")
        .groupBy(stratum, "rule", "step")
        .agg(F.count_if("good").alias("n"), F.count_if(~F.col("good")).alias("bad"))
    )
    counts = stored(counts, "rule-counts")
    n_strata = max(1, counts.select(F.coalesce(F.col(stratum).cast("string"), F.lit("\0"))).distinct().count())
    alpha, delta = risk.alpha / len(RULES), risk.delta / (len(RULES) * n_strata)
    n_steps = risk.steps

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        good, bad = [0] * (n_steps + 2), [0] * (n_steps + 2)
        for s, n, b in zip(group["step"], group["n"], group["bad"]):
            good[min(max(int(s), 0), n_steps + 1)] += int(n)
            bad[min(max(int(s), 0), n_steps + 1)] += int(b)
        # A document of step s lies above cutoff c where s > c; c = n_steps rejects none.
        lost = [sum(good[c + 1 :]) for c in range(n_steps, -1, -1)]
        caught = [sum(bad[c + 1 :]) for c in range(n_steps, -1, -1)]
        passed = certified(sum(good), lost, alpha, delta)
        out = group[[stratum, "rule"]].head(1).copy()
        if not passed:
            return out.assign(cutoff=0.0).head(0)
        gain = [caught[i] / max(1, sum(bad)) - lost[i] / max(1, sum(good)) for i in range(passed)]
        return out.assign(cutoff=(n_steps - gain.index(max(gain))) / n_steps)

    kind = measured.schema[stratum].dataType.simpleString()
    return counts.groupBy(stratum, "rule").applyInPandas(choose, f"`{stratum}` {kind}, rule string, cutoff double")


def judged(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
    risk: Risk = Risk(),
) -> DataFrame:
    """Rows (key, counts..., base_failed, kept), one for each document.

    ``base_failed``: under 50 words, or over half of them repeated. ``kept``: not that, and
    no rule's share above the cutoff of its stratum (NULL is a stratum of its own). NULL
    and empty texts have no words and fail. Repeated rows and NULL keys are kept as rows;
    a key is good if any of its labels is 1. Texts are read once; the measures, without
    the texts, are written to the shared folder.
    """
    source = documents.select(
        column(documents, key).alias("key"),
        column(documents, stratum).cast("string").alias("stratum"),
        column(documents, text).cast("string").alias("text"),
    )
    measured = stored(with_measures(source), "measures")
    marks = labels.select(column(labels, key).alias("key"), column(labels, label).alias("label"))
    wide = cutoffs(measured, marks, "stratum", risk).groupBy("stratum").pivot("rule", RULES).agg(F.first("cutoff"))
    wide = small(wide.select(F.col("stratum").alias("__s"), *[F.col(r).alias(f"__{r}") for r in RULES]), "cutoffs")
    joined = measured.join(wide, measured["stratum"].eqNullSafe(wide["__s"]), "left")
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rejected = F.lit(False)
    for rule in RULES:
        above = F.ceil(F.col(rule) * risk.steps) > F.round(F.col(f"__{rule}") * risk.steps)
        rejected = rejected | F.coalesce(above, F.lit(False))
    return joined.select(
        F.col("key").alias(key),
        *COUNTS[:-1],
        base_failed.alias("base_failed"),
        (~base_failed & ~rejected).alias("kept"),
        *RULES,
    )


ship_by_value(__name__)
