from __future__ import annotations

import pytest
from plans import physical
from pyspark.sql import functions as F

from gradeframe.operators import joins


def preds(spark, ids):
    return spark.createDataFrame([(i, f"p{i}") for i in ids], "id string, pred string")


def refs(spark, ids):
    return spark.createDataFrame([(i, f"r{i}") for i in ids], "id string, ref string")


def test_align_strict(spark):
    rows = joins.align(preds(spark, "abc"), refs(spark, "cab")).collect()
    assert sorted(tuple(r) for r in rows) == [(i, f"p{i}", f"r{i}") for i in "abc"]
    for left, right in (("ab", "a"), ("a", "ba")):
        with pytest.raises(Exception, match="unmatched key: b"):
            joins.align(preds(spark, left), refs(spark, right)).collect()
    with pytest.raises(ValueError):
        joins.align(preds(spark, "a"), refs(spark, "a"), how="other")


def test_align_matched_drops_rows_without_a_partner(spark):
    rows = joins.align(preds(spark, "abd"), refs(spark, "bce"), how="matched").collect()
    assert [tuple(r) for r in rows] == [("b", "pb", "rb")]


@pytest.mark.parametrize("how", ["strict", "matched"])
def test_align_refuses_repeated_keys(spark, how):
    for left, right in (("aab", "ab"), ("ab", "aab"), ("aa", "b")):
        with pytest.raises(Exception, match="more than once on a side: a"):
            joins.align(preds(spark, left), refs(spark, right), how=how).collect()


def test_align_and_null_keys(spark):
    left, right = preds(spark, ["a", None]), refs(spark, ["a", None])
    with pytest.raises(Exception, match="NULL key"):
        joins.align(left, right).collect()
    matched = joins.align(left.union(left.filter("id IS NULL")), right, how="matched")
    assert [tuple(r) for r in matched.collect()] == [("a", "pa", "ra")]


def test_align_is_lazy_and_reads_each_side_once(spark):
    left, right = preds(spark, "abc"), refs(spark, "cab")
    assert jobs(spark, lambda: joins.align(left, right)) == 0
    plan = physical(joins.align(left, right))
    assert plan.count("Exchange") == 1 and plan.count("Scan") == 2 and "Join" not in plan
    # The check holds even where no column but the key is asked for, or none at all.
    for pruned in (lambda df: df.select("id").collect(), lambda df: df.count()):
        with pytest.raises(Exception, match="unmatched key"):
            pruned(joins.align(left, refs(spark, "ab")))


def test_align_any_names_and_several_keys(spark):
    left = spark.sql("SELECT 1 AS `a.b`, 'x' AS k, 5 AS `__p`, 6 AS same")
    right = spark.sql("SELECT 'x' AS k, 1L AS `a.b`, 7 AS same")
    joined = joins.align(left, right, on=["a.b", "k"])
    assert joined.columns == ["a.b", "k", "__p", "same", "same"]
    assert [tuple(r) for r in joined.collect()] == [(1, "x", 5, 6, 7)]
    keys_only = joins.align(left.select("k"), right.select("k"), on="k")
    assert [tuple(r) for r in keys_only.collect()] == [("x",)]
    assert joins.align(left.limit(0), right.limit(0), on="k").isEmpty()


def test_lookup_splits_rows_that_are_all_alike(spark):
    """A key of 30 % of the rows, which are equal in every column."""
    left = spark.range(20000, numPartitions=4).selectExpr(
        "CASE WHEN id % 10 < 3 THEN 'hot' ELSE concat('k', id) END AS id", "CASE WHEN id % 10 < 3 THEN 'x' ELSE string(id) END AS t"
    )
    right = spark.createDataFrame([("hot", 1), ("k5", 2)], "id string, score int")
    assert jobs(spark, lambda: joins.left_lookup(left, right)) == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.left_lookup(left, right)
        sizes = [r["count"] for r in joined.filter("id = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 6000 and len(sizes) == 4 and max(sizes) < 4500
        assert joined.filter("score IS NOT NULL").count() == 6001
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def jobs(spark, action):
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lookup_splits_keys_of_any_share(spark):
    # One key has 30 % of the rows, others 3 %, 1 % and 0.1 %.
    share = "CASE WHEN id % 1000 < 300 THEN 'k0' WHEN id % 1000 < 330 THEN 'k1' WHEN id % 1000 < 340 THEN 'k2' " \
        "WHEN id % 1000 < 341 THEN 'k3' ELSE concat('k', id % 5000) END"
    left = spark.range(30000).selectExpr(f"{share} AS id", "id AS n").unionByName(
        spark.range(50).selectExpr("CAST(NULL AS STRING) AS id", "id AS n")
    )
    right = spark.range(4000).selectExpr("concat('k', id) AS id", "id AS score").unionByName(
        spark.sql("SELECT CAST(NULL AS STRING) AS id, -1L AS score")
    )
    assert jobs(spark, lambda: joins.left_lookup(left, right)) == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    # The partitions are small enough to be put together again, which would hide the split.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.left_lookup(left, right)
        plan = physical(joined)
        assert "Union" in plan and plan.count("SortMergeJoin") == 1  # the unions are the inputs'
        assert "Broadcast" not in plan
        plain = left.join(right, "id", "left")
        assert joined.count() == left.count()
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
        tasks = joined.filter("id = 'k0'").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_lookup_refuses_repeated_keys(spark):
    right = spark.sql("SELECT 'a' AS id, 1 AS score UNION ALL SELECT 'a', 2")
    with pytest.raises(Exception, match="several rows"):
        joins.left_lookup(preds(spark, "ab"), right).collect()
