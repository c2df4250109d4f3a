from __future__ import annotations

import pytest

import gradeframe as gf

GOOD = '{"choices": [{"message": {"content": "{\\"score\\": 1}"}}]}'


def replies(spark, rows):
    return spark.createDataFrame(rows, "id string, response string")


def test_a_second_run_writes_only_what_is_unanswered(spark, samples, tmp_path):
    asked = gf.judge_requests(samples)
    assert gf.write_requests(asked, str(tmp_path / "1"), rows_per_file=2) == 11
    files = list((tmp_path / "1").glob("part-*"))
    assert sum(len(f.read_text().splitlines()) for f in files) == 11
    assert all(len(f.read_text().splitlines()) <= 2 for f in files)
    came = replies(
        spark,
        [(f"n{i:02}", GOOD) for i in range(1, 8)]
        + [("n08", '{"error": "busy"}'), ("n09", None), ("n09", GOOD), ("n10", "<html>"), ("other", GOOD)],
    )
    assert gf.write_requests(asked, str(tmp_path / "2"), came) == 3
    rows = gf.read_requests(spark, str(tmp_path / "2")).collect()
    expected = {r.id: r.request for r in asked.collect() if r.id in ("n08", "n10", "n11")}
    assert {r.id: r.request for r in rows} == expected
    more = came.unionByName(replies(spark, [(i, GOOD) for i in expected]))
    assert gf.write_requests(asked, str(tmp_path / "3"), more) == 0
    assert gf.read_requests(spark, str(tmp_path / "3")).count() == 0


def test_repeated_ids_empty_tables_and_folders_in_use(spark, samples, tmp_path):
    asked = gf.judge_requests(samples).unionByName(gf.judge_requests(samples))
    none = replies(spark, [])
    assert gf.pending_requests(asked, none).count() == 22
    assert gf.pending_requests(asked, replies(spark, [("n01", GOOD), ("n01", GOOD)])).count() == 20
    assert gf.pending_requests(asked.limit(0), none).count() == 0
    gf.write_requests(asked, str(tmp_path / "x"))
    with pytest.raises(Exception, match="already exists"):
        gf.write_requests(asked, str(tmp_path / "x"))
    with pytest.raises(ValueError, match="rows_per_file"):
        gf.write_requests(asked, str(tmp_path / "y"), rows_per_file=0)
