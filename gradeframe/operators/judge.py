"""Judging answers: by rule, by user code, or by replies recorded elsewhere.

A judge is a function from a DataFrame with ``prompt``, ``reference`` and
``model_output`` to the same rows with ``score``, ``reason`` and ``raw`` added.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from types import ModuleType

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import fixed_text, round_exact
from ..functions.text import STRIP_CHARACTERS
from .joins import left_lookup
from .scoring import PRED, REF, with_token_f1_and_cosine

Judge = Callable[[DataFrame], DataFrame]
Verdict = tuple[float, str, str | None]
BatchJudge = Callable[[list[tuple[str, str, str]]], Sequence[Verdict]]
VERDICT_COLUMNS = ("score", "reason", "raw")
ANSWERED, NO_CONTENT, NOT_JSON = "answered", "no content", "not json"

# The texts a verdict and a judge request are made of.
RULE_REASON = "离线规则裁判：token F1=%s，余弦相似度=%s，加权得分=%s"
SYSTEM_PROMPT = (
    "你是一个严格但公正的 LLM 输出评测裁判。"
    "请阅读「题目」「参考答案」「模型输出」，判断模型输出的正确性，"
    "并只返回一个 JSON 对象，格式如下：\n"
    '{"score": 0到1之间的小数, "reason": "简短理由"}\n'
    "不要输出 JSON 以外的任何内容。"
)
USER_PROMPT = "【题目】\n%s\n\n【参考答案】\n%s\n\n【模型输出】\n%s\n"
DEFAULT_MODEL = "gpt-4o-mini"

# What Python's ``float`` accepts as text, apart from digit grouping.
_NUMBER = r"(?i)[+-]?(inf(inity)?|nan|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)"


def rule_judge(df: DataFrame) -> DataFrame:
    """Score by the mean of token F1 and cosine similarity, at 4 decimals."""
    f1, cosine = F.col("__gf_f1"), F.col("__gf_cosine")
    score = F.col("score")
    kept = [c for c in df.columns if c not in VERDICT_COLUMNS]
    return (
        df.select(*kept)
        .transform(with_token_f1_and_cosine, "__gf_f1", "__gf_cosine")
        .withColumn("score", round_exact(F.lit(0.5) * f1 + F.lit(0.5) * cosine, 4))
        .select(
            *kept,
            "score",
            F.format_string(RULE_REASON, *[fixed_text(c, 3) for c in (f1, cosine, score)]).alias(
                "reason"
            ),
            F.to_variant_object(F.struct(f1.alias("f1"), cosine.alias("cosine"))).alias("raw"),
        )
    )


def batch_judge(start: Callable[[], BatchJudge], rows: int = 64) -> Judge:
    """A judge from a function that is made once per Python worker, such as a loaded model.

    ``start`` takes no arguments and returns the judge: a function of a list of at most
    ``rows`` (prompt, reference, model_output) that returns, in this order, a (score,
    reason, raw reply as JSON text or None) for each; another number of them fails the
    query. A worker calls ``start`` for its first row and keeps what it returns for all its
    tasks, of this query or a later one with the same judge. Calls see rows of one Arrow
    batch after another, so a call may get fewer rows than ``rows``. Texts cross to
    Python once and rows stay where they are. Where a worker is lost, another one starts.
    """
    if rows < 1:
        raise ValueError("rows must be at least 1")
    name = uuid.uuid4().hex

    def started() -> BatchJudge:
        # A worker unpickles the function anew for every task; a module outlives them.
        kept = sys.modules.setdefault("gradeframe_judges", ModuleType("gradeframe_judges"))
        if not hasattr(kept, name):
            setattr(kept, name, start())
        return getattr(kept, name)

    def verdicts(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        for prompts, refs, preds in batches:
            texts = list(zip(prompts, refs, preds))
            found: list[Verdict] = []
            for first in range(0, len(texts), rows):
                asked = texts[first : first + rows]
                given = list(started()(asked))
                if len(given) != len(asked):
                    raise ValueError(f"the judge gave {len(given)} verdicts for {len(asked)} rows")
                found += given
            yield pd.DataFrame(found, columns=["score", "reason", "raw"])

    def apply(df: DataFrame) -> DataFrame:
        call = F.pandas_udf(verdicts, "score double, reason string, raw string")
        kept = [c for c in df.columns if c not in VERDICT_COLUMNS]
        # The generator keeps later filters above the call, which would else run twice.
        called = df.select(*kept, F.explode(F.array(call("prompt", REF, PRED))).alias("__v"))
        return called.select(
            *kept, "__v.score", "__v.reason", F.parse_json("__v.raw").alias("raw")
        )

    return apply


def row_judge(judge: Callable[[str, str, str], Verdict]) -> Judge:
    """A judge from a Python function of (prompt, reference, model_output).

    It returns score, reason and the raw reply as JSON text (or None).
    """
    return batch_judge(lambda: lambda texts: [judge(*t) for t in texts])


def apply_judge(df: DataFrame, judge: Judge) -> DataFrame:
    """Add the verdict columns of a judge."""
    judged = judge(df)
    missing = [c for c in (*df.columns, *VERDICT_COLUMNS) if c not in judged.columns]
    if missing:
        raise ValueError(f"the judge returned no column {', '.join(missing)}")
    return judged


def attach_verdicts(df: DataFrame, verdicts: DataFrame, on: str = "id") -> DataFrame:
    """Add recorded verdicts, at most one per id; NULL where there is none."""
    return left_lookup(df, verdicts.select(on, *VERDICT_COLUMNS), on)


def user_prompt() -> Column:
    return F.format_string(USER_PROMPT, "prompt", REF, PRED)


def judge_requests(df: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """Rows (id, request): the chat request for each sample, as JSON text.

    Written out, they feed whatever runs the model; its replies come back through
    ``read_replies``.
    """

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    request = F.struct(
        F.lit(model).alias("model"),
        F.array(message("system", F.lit(SYSTEM_PROMPT)), message("user", user_prompt())).alias(
            "messages"
        ),
        F.lit(0).alias("temperature"),
    )
    return df.select("id", F.to_json(request).alias("request"))


def read_replies(
    replies: DataFrame, response: str = "response", on: str = "id", mode: str = "keep"
) -> DataFrame:
    """Rows (id, score, reason, raw, status) from whole chat replies as JSON text.

    The first choice should hold a JSON object with ``score`` and ``reason``. If it
    does not, the score is 0.0 and the reason its text; ``status`` is ``answered`` either
    way. A reply without any such content (an API error, no choices) is ``no content``, one
    that is not JSON at all (NULL included) ``not json``: there is no verdict, so score and
    reason are NULL and means leave it out. With ``mode="fail"`` such a reply fails the
    query instead.
    """
    if mode not in ("keep", "fail"):
        raise ValueError(f"unknown mode {mode!r}")
    content = "$.choices[0].message.content"
    answered = F.col("status") == ANSWERED
    read = (
        replies.select(on, F.try_parse_json(response).alias("raw"))
        .withColumn(
            "status",
            F.when(F.col("raw").isNull(), F.lit(NOT_JSON))
            .when(F.try_variant_get("raw", content, "variant").isNull(), F.lit(NO_CONTENT))
            .otherwise(F.lit(ANSWERED)),
        )
        .withColumn("__content", F.coalesce(F.try_variant_get("raw", content, "string"), F.lit("")))
        .withColumn("__parsed", F.try_parse_json("__content"))
        .withColumn("__v", F.when(answered, _verdict(F.col("__parsed"), F.col("__content"))))
    )
    if mode == "fail":
        broken = F.raise_error(F.concat(F.lit("a judge reply is "), "status")).cast("boolean")
        read = read.filter(F.when(answered, F.lit(True)).otherwise(broken))
    return read.select(on, "__v.score", "__v.reason", "raw", "status")


def _verdict(parsed: Column, content: Column) -> Column:
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    score = F.try_variant_get(parsed, "$.score", "variant")
    score_text = F.btrim(F.try_variant_get(parsed, "$.score", "string"), F.lit(STRIP_CHARACTERS))
    is_text = F.schema_of_variant(score) == "STRING"
    # Casting text to a double also takes Java's suffixes, such as ``1d``.
    number = F.when(
        ~is_text | score_text.rlike(f"^{_NUMBER}$"),
        F.coalesce(
            F.when(is_text, score_text.try_cast("double")),
            F.try_variant_get(parsed, "$.score", "double"),
        ),
    )
    reason = F.try_variant_get(parsed, "$.reason", "variant")
    kind = F.schema_of_variant(reason)
    reason_text = (
        F.when(reason.isNull(), F.lit(""))
        .when(F.is_variant_null(reason), F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(F.try_variant_get(parsed, "$.reason", "string")))
        .otherwise(F.try_variant_get(parsed, "$.reason", "string"))
    )
    usable = is_object & (score.isNull() | number.isNotNull())
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(number, F.lit(0.0))))
    return F.when(
        usable, F.struct(clamped.alias("score"), reason_text.alias("reason"))
    ).otherwise(F.struct(F.lit(0.0).alias("score"), content.alias("reason")))
