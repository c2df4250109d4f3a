"""The registered queries of this package: each operator over its whole table.

Digest columns that a query must return are derived here from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from ..plans.tables import table
from . import (
    collocations,
    decontamination,
    html,
    language,
    licenses,
    merkle,
    mixing,
    pieces,
    pseudo_likelihood,
    quality,
    rules,
    secrets,
    simhash,
)
from .oracle import ORACLE_SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with what it shares with the benchmark."""
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its counts and the verdict of risk-controlled rules."""
    judged = rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op3_html(spark: SparkSession, folder: str) -> DataFrame:
    """Each page with its main text."""
    texts = html.extract(table(spark, folder, "pages"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def _joined(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with the secrets found in it."""
    found = secrets.secret_spans(table(spark, folder, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in secrets.SURE],
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its quality score."""
    scored = quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select(
        "doc_id",
        quality.in_split(F.col("doc_id"), 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, F.lit(1)).otherwise(F.lit(0)).alias("predicted"),
    )


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its calibrated weight, and whether it is in the sample."""
    documents = mixing.with_margins(table(spark, folder, "documents"))
    mixed = mixing.mix(documents, ["source", "lang", "topic"])
    return mixed.select(
        "doc_id",
        "source",
        "lang",
        "topic",
        "n_tokens",
        F.round("weight", 6).alias("weight"),
        F.round("probability", 6).alias("probability"),
        "sampled",
    )


def op7_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its masked pseudo-log-likelihood."""
    return pseudo_likelihood.scored(table(spark, folder, "documents"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its SimHash fingerprint and near-duplicate group."""
    groups = simhash.near_duplicates(table(spark, folder, "documents"))
    return groups.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its licence sentences and licences."""
    found = licenses.license_scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.size("sentences").cast("bigint").alias("n_sentences"),
        F.array_join("sentences", ",").alias("sentences"),
        F.array_join("licences", ",").alias("licences"),
    )


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its main language."""
    documents = table(spark, folder, "documents")
    held_out = quality.in_split(F.col("doc_id"), 2)
    model = language.fit(documents, ~held_out)
    source = documents.select("doc_id", held_out.alias("held_out"), "text")
    found = language.with_language(source, model)
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("bigint").alias("n_spans"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best collocations of each language."""
    return collocations.collocations(table(spark, folder, "documents"))


def op12_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its SentencePiece ids and what they decode to."""
    import public_tokenizers

    model = pieces.Pieces.read(public_tokenizers.path("piece_bpe_32k.model"))
    found = pieces.decoded(pieces.encoded(table(spark, folder, "documents"), model), model)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its Merkle proof, and whether a copy that was tampered with passes."""
    documents = table(spark, folder, "documents")

    def fields(n_chars: Column) -> list[Column]:
        return [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + F.when(tampered, F.lit(1)).otherwise(F.lit(0))
    found = merkle.manifest(documents, fields(F.col("n_chars")), fields(more))
    root = merkle.folded(F.col("claimed"), F.col("path"))
    rows = found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), root.alias("folded_root")
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus pipeline from raw documents to the weighted sample."""
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Query] = {q.__name__: q for q in (op1_decontamination, op2_rules, op3_html, op4_secrets, op5_quality, op6_mixing, op7_pseudo_likelihood, op8_simhash, op9_licenses, op10_language, op11_collocations, op12_pieces, op13_merkle, pipeline)}

__all__ = ["ORACLE_SQL", "QUERIES"]
