"""Preparing a training corpus: five stages from raw documents to a weighted sample.

    run(spark, "/data/corpus")     # reads /data/corpus/documents.parquet and its neighbours

A stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and
returns a DataFrame. Its result is written to the shared folder and read again before the
next stage starts, so a lost executor costs at most the tasks of one stage. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeframe.llm import decontamination, mixing, quality, secrets, simhash
from gradeframe.llm.store import stored
from gradeframe.plans.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
QUALITY_BAR = 0.7


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier scores below the bar go."""
    docs = docs.select(*COLUMNS)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    if model is None:  # nothing to learn from, so nothing to reject
        return docs
    return quality.with_score(docs, model).filter(F.col("score") >= QUALITY_BAR).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.without_near_duplicates(docs.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.uncontaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; the documents stay."""
    masked = secrets.redacted(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the target mix of sources, languages and topics."""
    mixed = mixing.mix(mixing.with_margins(docs.select(*COLUMNS)), ["source", "lang", "topic"])
    sampled = mixed.filter("sampled")
    return sampled.select(*COLUMNS, "topic", "n_tokens", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", source_mixing),
]

# A network trained in numpy and XXH64 fingerprints are beyond SQL; the stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to the sample."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
