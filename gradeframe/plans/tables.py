"""Evaluation sets derived from the given tables.

Answers to score come from ``conversations``: the text of an assistant turn is the
reference, the turn before it the prompt, and the answer a variation on either.
Labels to score come from ``documents`` and ``labels``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.samples import conform_samples


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def answer_records(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records of assistant turns, with all sorts of task type spellings."""
    turns = table(spark, folder, "conversations")
    # Joining on (conv_id, turn) instead of a window per conversation: the keys are
    # unique, so a very long conversation is spread like any other rows.
    before = turns.select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt")
    )
    half = F.expr("int(length(text) / 2)")
    kind = F.col("conv_id") % 5
    answer = (
        F.when(kind == 0, F.col("text"))
        .when(kind == 1, F.replace("text", F.lit("th"), F.lit("d")))
        .when(kind == 2, F.col("prompt"))
        .when(kind == 3, F.lit(""))
        .otherwise(F.concat(F.expr("substr(text, int(length(text) / 2) + 1)"), F.left("text", half)))
    )
    spelling = F.col("conv_id") % 4
    return (
        turns.filter("role = 'assistant'")
        .join(before, ["conv_id", "turn"])
        .select(
            "conv_id",
            F.concat_ws("-", "conv_id", "turn").alias("id"),
            "prompt",
            F.col("text").alias("reference"),
            answer.alias("model_output"),
            F.when(spelling == 0, F.lit("generation"))
            .when(spelling == 1, F.lit("summary"))
            .when(spelling == 2, F.lit(""))
            .alias("task_type"),
            F.when(
                F.col("turn") % 2 == 1, F.concat(F.lit('{"turn":'), F.col("turn"), F.lit("}"))
            ).alias("metadata"),
        )
    )


def label_records(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records of labelled documents, with all sorts of task type spellings."""
    spelling = F.col("doc_id") % 3
    return (
        table(spark, folder, "documents")
        .join(table(spark, folder, "labels"), "doc_id")
        .select(
            F.concat(F.lit("doc-"), "doc_id").alias("id"),
            F.col("text").alias("prompt"),
            F.when(F.col("quality") == 1, F.lit("high")).otherwise(F.lit("low")).alias("reference"),
            F.when(F.col("n_chars") >= 500, F.lit("  HIGH　\n"))
            .otherwise(F.lit("Low"))
            .alias("model_output"),
            F.when(spelling == 0, F.lit("classification"))
            .when(spelling == 1, F.lit("\tClassify "))
            .otherwise(F.lit("CLS"))
            .alias("task_type"),
            F.concat(
                F.lit('{"lang":"'), "lang", F.lit('","source":"'), "source", F.lit('"}')
            ).alias("metadata"),
        )
    )


def samples(spark: SparkSession, folder: str) -> DataFrame:
    return conform_samples(
        answer_records(spark, folder)
        .drop("conv_id")
        .unionByName(label_records(spark, folder))
    )


def text_bytes(spark: SparkSession, folder: str) -> int:
    """The bytes of all texts that samples are made of; those of turns count twice, as they
    are joined with the turn before."""
    size = F.sum(F.octet_length("text").cast("bigint")).alias("n")
    turns, documents = (table(spark, folder, t).agg(size).first().n or 0 for t in ("conversations", "documents"))
    return 2 * turns + documents


def predicted_labels(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, pred) for every document."""
    long = F.col("n_chars") >= 500
    return table(spark, folder, "documents").select(
        "doc_id", F.when(long, F.lit("  HIGH　\n")).otherwise(F.lit("Low")).alias("pred")
    )


def true_labels(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, label) for the labelled documents."""
    return table(spark, folder, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, F.lit("high")).otherwise(F.lit("low")).alias("label"),
    )


def reference_labels(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, label) for every document: by its quality, or else by its language."""
    quality = table(spark, folder, "labels").select("doc_id", "quality")
    label = F.when(F.col("quality") == 1, F.lit("high")).when(F.col("quality") == 0, F.lit("low"))
    other = F.when(F.col("lang") == "en", F.lit(" High")).otherwise(F.lit("low"))
    return (
        table(spark, folder, "documents")
        .select("doc_id", "lang")
        .join(quality, "doc_id", "left")
        .select("doc_id", F.coalesce(label, other).alias("label"))
    )


def reply_records(spark: SparkSession, folder: str) -> DataFrame:
    """(id, response): a chat reply for each answer, well formed or not."""
    answers = answer_records(spark, folder)
    kind = F.col("conv_id") % 11
    reason = F.col("prompt").alias("reason")

    def reply(score: Column) -> Column:
        return F.to_json(F.struct(score.alias("score"), reason))

    content = (
        F.when(kind == 0, reply(F.lit(0.75)))
        .when(kind == 1, reply(F.lit("0.5")))
        .when(kind == 2, reply(F.lit(3)))
        .when(kind == 3, reply(F.lit(-1)))
        .when(kind == 4, F.to_json(F.struct(reason)))
        .when(kind == 5, F.lit('{"score": null, "reason": "none"}'))
        .when(kind == 6, F.concat(F.lit("I would say: "), F.col("prompt")))
        .otherwise(F.concat(F.lit("```json\n"), reply(F.lit(1)), F.lit("\n```")))
    )
    message = F.struct(F.struct(content.alias("content")).alias("message"))
    response = (
        F.when(kind == 8, F.lit('{"error": {"code": "rate_limit", "message": "slow down"}}'))
        .when(kind == 9, F.lit('{"choices": []}'))
        .when(kind == 10, F.lit("<html><body>502 Bad Gateway</body></html>"))
        .otherwise(F.to_json(F.struct(F.array(message).alias("choices"))))
    )
    return answers.select("id", response.alias("response"))
