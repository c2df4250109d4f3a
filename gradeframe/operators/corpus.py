"""Term statistics over a column of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import smoothed_idf
from ..functions.multisets import token_counts
from ..functions.text import tokenize


def term_frequencies(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, term, count, tf): each term of a text with its share of the tokens.

    Counted within the row, so nothing is shuffled.
    """
    tokens = df.select(key, tokenize(text).alias("__tokens"))
    counted = tokens.select(
        key, F.size("__tokens").alias("__n"), F.inline(token_counts("__tokens"))
    )
    return counted.select(
        key,
        F.col("token").alias("term"),
        "count",
        (F.col("count") / F.col("__n")).alias("tf"),
    )


def inverse_document_frequencies(df: DataFrame, text: str) -> DataFrame:
    """Rows (term, document_frequency, idf) over all texts of the table.

    A document sends each of its terms once, and terms are counted before they are
    shuffled, so that a term found everywhere costs one row per task.
    """
    terms = df.select(F.explode(F.array_distinct(tokenize(text))).alias("term"))
    n_documents = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        terms.groupBy("term")
        .agg(F.count(F.lit(1)).alias("document_frequency"))
        .withColumn("idf", smoothed_idf(n_documents, F.col("document_frequency")))
    )
