from __future__ import annotations

import json

import pytest
from plans import physical
from pyspark.sql import functions as F

from gradeframe.operators.aggregates import count_by_task
from gradeframe.operators.selection import find_sample, first_n, spread
from gradeframe.sources.samples import conform_samples, read_samples, write_samples

RECORDS = [
    {"id": "a", "prompt": "p", "reference": "好", "model_output": "o", "task_type": " CLS "},
    {"id": 1, "prompt": "p", "task_type": "Classify", "metadata": {"level": "easy", "n": [1]}},
    {"id": "b", "reference": "r", "task_type": "ranking", "metadata": None, "other": 5},
    {"id": "b", "reference": "r", "task_type": None, "metadata": {}},
    {"id": "c", "task_type": "classification", "metadata": False},
]
EXPECTED = [
    ("1", "p", "", "", "classification", '{"level":"easy","n":[1]}'),
    ("a", "p", "好", "o", "classification", "{}"),
    ("b", "", "r", "", "generation", "{}"),
    ("b", "", "r", "", "generation", "{}"),
    ("c", "", "", "", "classification", "{}"),
]


def rows(df):
    got = df.withColumn("metadata", F.to_json("metadata")).collect()
    return sorted(tuple(r) for r in got)


def write(path, content):
    path.write_text(json.dumps(content, ensure_ascii=False, indent=1), encoding="utf-8")
    return str(path)


def test_list_and_wrapper(spark, tmp_path):
    assert rows(read_samples(spark, write(tmp_path / "l.json", RECORDS), "json")) == EXPECTED
    wrapped = write(tmp_path / "w.json", {"name": "x", "samples": RECORDS})
    assert rows(read_samples(spark, wrapped, "json")) == EXPECTED


def test_object_without_samples_holds_none(spark, tmp_path):
    assert rows(read_samples(spark, write(tmp_path / "o.json", {"items": [1]}), "json")) == []
    assert rows(read_samples(spark, write(tmp_path / "e.json", []), "json")) == []


def test_missing_id_and_broken_json_fail(spark, tmp_path):
    for i, content in enumerate([[{"prompt": "x"}], [{"id": None, "prompt": "x"}]]):
        with pytest.raises(Exception, match="without an id"):
            read_samples(spark, write(tmp_path / f"{i}.json", content), "json").collect()
    broken = tmp_path / "b.json"
    broken.write_text('[{"id": "a"', encoding="utf-8")
    with pytest.raises(Exception, match="JSONDecodeError"):
        read_samples(spark, str(broken), "json").collect()
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_samples(spark, str(broken)).collect()


@pytest.mark.parametrize("format", ["ndjson", "parquet"])
def test_round_trip(spark, tmp_path, format):
    samples = read_samples(spark, write(tmp_path / "l.json", RECORDS), "json")
    out = str(tmp_path / "out")
    write_samples(samples, out, format)
    assert rows(read_samples(spark, out, format)) == EXPECTED


def test_json_lines_keep_text_and_all_fields(spark, tmp_path):
    samples = read_samples(spark, write(tmp_path / "l.json", RECORDS[:1]), "json")
    write_samples(samples.coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    line = part.read_text(encoding="utf-8")
    assert "好" in line
    assert list(json.loads(line)) == [
        "id",
        "prompt",
        "reference",
        "model_output",
        "task_type",
        "metadata",
    ]


def test_conform_takes_any_table_with_ids(spark):
    df = spark.createDataFrame([(7, {"k": "v"})], "id long, metadata map<string,string>")
    assert rows(conform_samples(df)) == [("7", "", "", "", "generation", '{"k":"v"}')]
    df = spark.createDataFrame([("x", None)], "id string, metadata string")
    assert rows(conform_samples(df)) == [("x", "", "", "", "generation", "{}")]


def test_selection(spark, samples):
    assert [r.id for r in first_n(samples, 3).collect()] == ["n01", "n02", "n03"]
    assert find_sample(samples, "n05").first().reference == "copper"
    counts = {r.task_type: r.n for r in count_by_task(samples).collect()}
    assert counts == {"classification": 5, "generation": 6}


def test_first_n_settles_ties(spark):
    rows = [("a", f"p{i:02}") for i in range(30)] + [("b", "p")]
    df = spark.createDataFrame(rows, "id string, prompt string")
    for parts in (1, 7):
        first = first_n(df.orderBy(F.desc("prompt")).repartition(parts), 3).collect()
        assert [r.prompt for r in first] == ["p00", "p01", "p02"]
    assert [r.id for r in first_n(df, 1, ["prompt", "id"]).collect()] == ["b"]


def test_default_round_trip_keeps_every_row(spark, tmp_path):
    df = spark.range(100).selectExpr("string(id) AS id", "concat('p', id, '\\n\\u2028') AS prompt")
    samples = conform_samples(df.coalesce(2))
    write_samples(samples, str(tmp_path / "s"))
    assert rows(read_samples(spark, str(tmp_path / "s"))) == rows(samples)
    write_samples(samples, str(tmp_path / "j"), "json")
    assert rows(read_samples(spark, str(tmp_path / "j"), "json")) == rows(samples)


def test_json_documents_are_read_whole_or_not_at_all(spark, tmp_path):
    lines = tmp_path / "lines.json"
    lines.write_text('{"id": "a"}\n{"id": "b"}\n', encoding="utf-8")
    with pytest.raises(Exception, match="Extra data"):
        read_samples(spark, str(lines), "json").collect()
    with pytest.raises(Exception, match="without an id"):
        read_samples(spark, write(tmp_path / "x.json", [{"id": "a"}, {"other": 5}]), "json").collect()
    extra = write(tmp_path / "y.json", [{"id": "a", "samples": [{"id": "inner"}]}, {"id": "b", "samples": 3}])
    assert [r.id for r in read_samples(spark, extra, "json").orderBy("id").collect()] == ["a", "b"]
    assert read_samples(spark, write(tmp_path / "z.json", {"id": "a"}), "json").isEmpty()
    for i, content in enumerate([[1], "text", {"samples": {"id": "a"}}]):
        with pytest.raises(Exception, match="list of objects"):
            read_samples(spark, write(tmp_path / f"w{i}.json", content), "json").collect()


def test_lines_may_be_wrappers(spark, tmp_path):
    lines = [
        {"samples": RECORDS[:2], "name": "x"},
        {"samples": []},
        {"id": "own", "samples": [{"id": "inner"}]},
        {"id": "three", "samples": 3},
        *RECORDS[2:],
    ]
    path = tmp_path / "w.jsonl"
    path.write_text("\n".join(json.dumps(x, ensure_ascii=False) for x in lines), encoding="utf-8")
    got = rows(read_samples(spark, str(path)))
    assert [r for r in got if r[0] not in ("own", "three")] == EXPECTED
    assert [r[0] for r in got if r[0] in ("own", "three")] == ["own", "three"]
    assert physical(read_samples(spark, str(path))).count("FileScan") == 1
    for i, bad in enumerate([{"samples": [{"prompt": "x"}]}, {"samples": [5]}, {"name": "x"}]):
        path = tmp_path / f"bad{i}.jsonl"
        path.write_text(json.dumps(bad), encoding="utf-8")
        with pytest.raises(Exception, match="without an id"):
            read_samples(spark, str(path)).collect()


def test_id_filter_reaches_the_scan_and_a_missing_id_is_never_overlooked(spark, samples, tmp_path):
    out = str(tmp_path / "s")
    write_samples(conform_samples(samples), out, "parquet")
    found = find_sample(read_samples(spark, out, "parquet"), "n05")
    assert "EqualTo(id,n05)" in physical(found)
    assert found.count() == 1
    broken = spark.createDataFrame([("a", "p"), (None, "p")], "id string, prompt string")
    with pytest.raises(Exception, match="without an id"):
        count_by_task(conform_samples(broken)).collect()


def test_spread_evens_out_partitions(spark):
    uneven = spark.range(20000).selectExpr("id", "sha2(string(id), 512) AS t").coalesce(1)
    # The maximum keeps the texts in the plan; partitions are sized by their bytes.
    sizes = spread(uneven).groupBy(F.spark_partition_id()).agg(
        F.count("*").alias("n"), F.max("t")
    )
    counts = [r.n for r in sizes.collect()]
    assert len(counts) > 1 and sum(counts) == 20000
    assert max(counts) < 2 * min(counts)
