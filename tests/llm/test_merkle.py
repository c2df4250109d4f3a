from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from helpers import DOCS, ODD
from pyspark.sql import functions as F

from gradeframe.llm import merkle, queries


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_digest(values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    """All levels of a tree, from the leaves to the root."""
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([digest(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return found


def siblings(tree, at):
    found = []
    for level in tree[:-1]:
        found.append((at ^ 1 < at, level[at ^ 1] if at ^ 1 < len(level) else ""))
        at //= 2
    return found


def slow_manifest(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows of documents."""
    def fields(r, more=0):
        n = r[4]
        return r[0], r[3], r[2], None if n is None else n + more, r[1]

    def order(value):
        return value is not None, value

    groups = {}
    for r in rows:
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        groups.setdefault(r[2], []).append((r[0], row_digest(fields(r)), row_digest(fields(r, int(bad)))))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda x: (order(x[0]) if x[0] is not None else (False, 0), x[1]))
    trees = {g: levels([x[1] for x in groups[g]]) for g in langs}
    top = levels([trees[g][-1][0] for g in langs])
    found = []
    for i, g in enumerate(langs):
        for at, (doc_id, leaf, claimed) in enumerate(groups[g]):
            path = siblings(trees[g], at) + siblings(top, i)
            h = claimed
            for before, other in path:
                h = digest(other, h) if before else digest(h, other)
            root = top[-1][0]
            found.append((doc_id, leaf, trees[g][-1][0], root, digest(*(s for _, s in path)), h, h == root))
    return sorted(found, key=str)


def run(spark, rows, tmp_path, monkeypatch, bits=None, extra=None):
    docs = spark.createDataFrame(rows, DOCS)
    if extra:
        docs = docs.withColumns(extra)
    docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    if bits:
        original = merkle.manifest
        monkeypatch.setattr(merkle, "manifest", lambda *a, **k: original(*a, bits=bits, **k))
    found = queries.op13_merkle(spark, str(tmp_path))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.select(*names).collect()), key=str)


def some_rows(n, langs=("en", "de", None, "é", ""), seed=3):
    rng = random.Random(seed)
    return [
        (rng.randrange(n), f"text {i} é", rng.choice(langs), rng.choice(["s", None]), rng.choice([None, i]))
        for i in range(n)
    ]


@pytest.mark.parametrize("bits", [1, 2, 3, None])
def test_against_plain_python(spark, tmp_path, monkeypatch, bits):
    rows = some_rows(61)
    assert run(spark, rows, tmp_path, monkeypatch, bits) == slow_manifest(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_sizes_around_powers_of_two(spark, tmp_path, monkeypatch, n):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(n)]
    assert run(spark, rows, tmp_path, monkeypatch, bits=2) == slow_manifest(rows)


def test_odd_rows(spark, tmp_path, monkeypatch):
    """NULLs anywhere, empty and long texts, equal rows, equal keys, the largest count."""
    rows = [(i % 4, t, "en", "s", 2**63 - 1) for i, t in enumerate(ODD)]
    rows += [(None, None, None, None, None)] * 3 + [(7, "same", "en", "s", 4)] * 5 + [(None, "x", "en", "s", 1)]
    assert run(spark, rows, tmp_path, monkeypatch) == slow_manifest(rows)


def test_empty_table_and_clashing_columns(spark, tmp_path, monkeypatch):
    assert run(spark, [], tmp_path, monkeypatch) == []
    names = ["grp", "key", "h", "tie", "rank", "n", "node", "path", "root", "r.at", "part", "first"]
    rows = some_rows(20)
    extra = {name: F.lit("x") for name in names}
    assert run(spark, rows, tmp_path, monkeypatch, extra=extra) == slow_manifest(rows)


def test_tampered_rows_fail_and_others_pass(spark):
    found = queries.op13_merkle(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == 200
    for r in found:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)


def test_large_group_of_equal_rows_is_spread(spark):
    """Equal rows do not meet in one partition when they are ranked."""
    rows = spark.range(20_000, numPartitions=8).select(F.lit("en").alias("grp"), F.lit(1).alias("key"), F.lit("h").alias("h"))
    spread = rows.withColumn("tie", F.monotonically_increasing_id())
    parts = spread.repartitionByRange(8, "grp", "key", "h", "tie").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 6_000
    ranks = merkle.ranked(spread, "grp", ["key", "h"], "test-ranked").select("rank", "n").collect()
    assert sorted(r["rank"] for r in ranks) == list(range(20_000)) and {r.n for r in ranks} == {20_000}
