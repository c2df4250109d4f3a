from __future__ import annotations

import pytest

import gradeframe as gf
from gradeframe.sources import reports


def run(spark, samples, path, **options):
    results = gf.evaluate(samples)
    return gf.write_report(results, gf.summarize(results), path, **options)


def test_a_finished_run_is_read_back(spark, samples, tmp_path):
    path = str(tmp_path / "report")
    assert gf.report_runs(spark, path).count() == 0
    first, second = run(spark, samples, path), run(spark, samples.limit(0), path, run="empty")
    assert {(r.run, r.results, r.statistics) for r in gf.report_runs(spark, path).collect()} == {
        (first, 11, 1),
        (second, 0, 1),
    }
    results, statistics = gf.read_report(spark, path, first)
    expected = gf.report_results(gf.evaluate(samples))
    assert sorted(map(str, results.collect())) == sorted(map(str, expected.collect()))
    assert (statistics.first().total, statistics.first().passed) == (11, 6)
    summary = gf.summarize(gf.evaluate(samples)).first()
    assert statistics.first().avg_scores == summary.avg_scores
    assert gf.read_report(spark, path, "empty")[0].count() == 0


@pytest.mark.parametrize("after", ["results", "statistics"])
def test_a_run_that_stops_in_between_cannot_be_read(spark, samples, tmp_path, monkeypatch, after):
    path = str(tmp_path / "report")

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(reports, "report_statistics" if after == "results" else "Observation", stop)
    with pytest.raises(KeyboardInterrupt):
        run(spark, samples, path, run="stopped")
    with pytest.raises(ValueError, match="not finished"):
        gf.read_report(spark, path, "stopped")
    assert gf.report_runs(spark, path).count() == 0


def test_lost_files_names_and_names_in_use(spark, samples, tmp_path):
    path = str(tmp_path / "report")
    run(spark, samples.repartition(3), path, run="a")
    with pytest.raises(Exception, match="already exists"):
        run(spark, samples, path, run="a")
    with pytest.raises(ValueError, match="not a name"):
        run(spark, samples, path, run="../a")
    next((tmp_path / "report" / "run=a" / "results").glob("part-*")).unlink()
    with pytest.raises(ValueError, match="were written"):
        gf.read_report(spark, path, "a")
