from __future__ import annotations

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gradeframe.plans import queries
from gradeframe.plans.oracle import ORACLE_SQL
from gradeframe.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert compare.differences(spark, FOLDER, name, con)[:3] == []


def test_entry(spark):
    df = entry.entry(spark)
    assert "passed" in df.columns
    assert not df.isEmpty()


def test_documents_of_samples_do_not_grow_with_the_tables(spark, tmp_path, monkeypatch):
    """No task writes more than a bounded document, whatever the size of the tables."""
    text = F.concat_ws(" ", F.lit("salt"), F.sequence(F.col("id"), F.col("id") + 60).cast("array<string>"))
    ids = spark.range(0, 400, 1, 8)
    of = {
        "documents": ids.select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"), F.length(text).cast("bigint").alias("n_chars")),
        "labels": ids.select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic")),
        "conversations": ids.select((F.col("id") / 2).cast("bigint").alias("conv_id"), (F.col("id") % 2).alias("turn"), F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"), text.alias("text")),
    }
    for name, table in of.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(queries, "DOCUMENT_BYTES", 40_000, raising=False)
    monkeypatch.setattr(queries, "_scratch", lambda spark, name: f"{tmp_path}/{name}")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in before:
            spark.conf.set(key, "8k")
        found = queries.document_samples(spark, str(tmp_path)).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted(found) == sorted(queries.load_samples(spark, str(tmp_path)).collect())
    sizes = [p.stat().st_size for p in (tmp_path / "documents").glob("part-*")]
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 3
