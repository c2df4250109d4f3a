from __future__ import annotations

import pytest

from gradeframe.operators.scoring import evaluate
from gradeframe.sources.samples import conform_samples, write_samples
from gradeframe.operators.aggregates import summarize
from gradeframe.streaming.scoring import read_sample_stream, read_summary, start_scoring, start_summary


def test_stream_scores_each_file_once(spark, samples, tmp_path):
    source, output, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    full = conform_samples(samples)
    for part in ("task_type = 'classification'", "task_type = 'generation'"):
        write_samples(full.filter(part), source, mode="append")
        start_scoring(read_sample_stream(spark, source), output, log).awaitTermination()
    # Everything is there already, so a bounded stream does the same in more batches.
    again = read_sample_stream(spark, source, max_files=1)
    start_scoring(again, f"{output}-2", f"{log}-2").awaitTermination()
    assert spark.read.parquet(f"{output}-2").count() == 11
    streamed = spark.read.parquet(output).drop("details")
    batch = evaluate(full).drop("details")
    assert streamed.count() == 11
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_running_summary_over_stops_and_replays(spark, samples, tmp_path):
    """Stopped and started again between files, with rows sent twice: the batch summary."""
    source, output, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    full = conform_samples(samples)

    def run():
        stream = read_sample_stream(spark, source, max_files=1, arrived="arrived")
        start_summary(stream, output, log, replays="2 hours").awaitTermination()
        return read_summary(spark, output).collect()

    seen = full.limit(0)
    for part in ("id < 'n04'", "id < 'n07'", "id > 'n05'", "true"):
        write_samples(full.filter(part), source, mode="append")
        seen = seen.union(full.filter(part)).dropDuplicates(["id"])
        (now,) = run()
        (batch,) = summarize(evaluate(seen)).collect()
        assert (now.total, now.passed) == (batch.total, batch.passed)
        assert now.avg_scores == pytest.approx(batch.avg_scores)
    assert now.total == 11
    assert run() == [now]  # nothing new


def test_without_replays_every_row_counts(spark, samples, tmp_path):
    source, output, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    full = conform_samples(samples)
    for _ in range(2):
        write_samples(full, source, mode="append")
    start_summary(read_sample_stream(spark, source), output, log).awaitTermination()
    (now,) = read_summary(spark, output).collect()
    (batch,) = summarize(evaluate(full.union(full))).collect()
    assert (now.total, now.passed, now.pass_rate) == (batch.total, batch.passed, batch.pass_rate)


def test_ids_are_forgotten_after_a_while(spark, samples, tmp_path):
    """A row that comes again long after the first time counts again."""
    import os

    source, output, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    full = conform_samples(samples).filter("id <= 'n03'")
    totals = []
    for hours, part in ((0, "id <= 'n02'"), (5, "id = 'n03'"), (10, "id <= 'n02'")):
        known = set(tmp_path.glob("in/*.json"))
        write_samples(full.filter(part).coalesce(1), source, mode="append")
        for file in set(tmp_path.glob("in/*.json")) - known:
            os.utime(file, (1_700_000_000 + hours * 3600,) * 2)
        stream = read_sample_stream(spark, source, arrived="arrived")
        start_summary(stream, output, log, replays="1 hour").awaitTermination()
        totals.append(read_summary(spark, output).first().total)
    assert totals == [2, 3, 5]
