"""Scoring a stream of samples.

Scoring needs no state, so the batch operators run on a stream as they are. A running
summary keeps two states: its sums, and the ids of a while, so that what is sent again is not
counted again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.aggregates import summarize
from ..operators.scoring import evaluate
from ..sources.samples import LINE, conform_samples, line_records


def read_sample_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: str | None = None,
    arrived: str | None = None,
) -> DataFrame:
    """Samples from JSON-lines files as they arrive in a folder.

    ``max_files`` or ``max_bytes`` (such as ``"10g"``), not both, bound what a micro-batch
    takes on. A broken line fails the query. ``arrived`` names a further column, the time at
    which the sample's file was written.
    """
    reader = spark.readStream.schema(LINE).option("mode", "FAILFAST")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    lines = reader.json(path)
    if arrived is None:
        return conform_samples(line_records(lines))
    timed = lines.withColumn(arrived, F.col("_metadata.file_modification_time"))
    return conform_samples(line_records(timed, [arrived]), [arrived])


def start_scoring(
    samples: DataFrame, output: str, checkpoint: str, threshold: float = 0.5
) -> StreamingQuery:
    """Append the scores of a stream of samples to a parquet table.

    Works off what is there and ends; started again it goes on from ``checkpoint``,
    and no file is scored twice.
    """
    return (
        evaluate(samples, threshold)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_summary(
    samples: DataFrame,
    output: str,
    checkpoint: str,
    threshold: float = 0.5,
    replays: str | None = None,
    arrived: str = "arrived",
) -> StreamingQuery:
    """Keep the summary of all samples of a stream up to date, in a state store.

    Each micro-batch writes the whole summary so far as one row, which ``read_summary``
    reads; a batch that is repeated after a failure writes over its own. With ``replays``
    (such as ``"1 hour"``), a sample whose id came within that time of the latest ``arrived``
    (a timestamp column of ``samples``) is taken to be sent again, and left out; ids are held
    that long, no longer. Without it every row counts, as in a batch, where ids may repeat.

    Works off what is there and ends; started again it goes on from ``checkpoint``. The
    state is one row, and one short row for each id within the time.
    """
    if replays is not None:
        samples = samples.withWatermark(arrived, replays).dropDuplicatesWithinWatermark(["id"])

    def write(summary: DataFrame, batch: int) -> None:
        summary.write.mode("overwrite").parquet(f"{output}/batch={batch}")

    return (
        summarize(evaluate(samples, threshold))
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_summary(spark: SparkSession, output: str) -> DataFrame:
    """The latest summary that ``start_summary`` wrote, as ``summarize`` returns it."""
    rows = spark.read.schema(_SUMMARY).parquet(output)
    latest = rows.groupBy().agg(F.max_by(F.struct(*rows.columns), "batch").alias("s"))
    return latest.filter("s IS NOT NULL").select("s.*").drop("batch")


_SUMMARY = "total bigint, passed bigint, pass_rate double, avg_scores map<string, double>, batch bigint"
