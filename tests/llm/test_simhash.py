from __future__ import annotations

from pyspark.sql import functions as F

import random

import numpy as np
import pytest
import xxhash
from helpers import ODD, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from gradeframe.llm import queries, simhash
from gradeframe.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text("ab Éß\n\x0b\x85中", max_size=60))
def test_fingerprint_by_the_definition(text):
    assert simhash.fingerprint(text) % 2**64 == slow_fingerprint(text)


def test_masks_leave_one_alone_for_any_close_pair():
    rng = random.Random(1)
    for distance, blocks in ((3, 4), (3, 6), (2, 5), (0, 1)):
        masks = simhash.block_masks(distance, blocks)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), distance):
                b ^= 1 << bit
            assert any(a & m % 2**64 == b & m % 2**64 for m in masks)
    with pytest.raises(ValueError):
        simhash.block_masks(4, 4)


def components(values, distance):
    """Smallest value linked to each, by comparing all."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {v: find(v) for v in values}


def clustered(n, seed=2):
    """Fingerprints around few centres, so that chains and large buckets occur."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)]
    found = set()
    while len(found) < n:
        v = rng.choice(centres)
        for _ in range(rng.randint(0, 5)):
            v ^= 1 << rng.randrange(20)
        found.add(v - (1 << 64) if v >> 63 else v)
    return sorted(found)


@pytest.mark.parametrize("tile", [8, 2048])
def test_links_connect_what_all_pairs_connect(spark, tile):
    values = clustered(400)
    df = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")
    edges = simhash.fingerprint_links(df, tile=tile)
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert {v: roots.get(v, v) for v in values} == components(values, 3)


def test_stars_of_a_bucket():
    values = clustered(60, seed=5)
    expected = components(values, 3)
    root = {v: v for v in values} | dict(simhash.stars(np.array(values), 3))
    assert root == expected


def test_components_of_long_chains_and_hot_nodes(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5000, 6000 + i) for i in range(3000)]
    odd = [(7, 7), (None, 1), (9, 8), (8, 9), (9, 8)]
    df = spark.createDataFrame(chain + star + odd, "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(df).collect()}
    expected = {i: 100 for i in range(100, 161)} | {5000: 5000, 8: 8, 9: 8} | {6000 + i: 5000 for i in range(3000)}
    assert got == expected
    assert connected_components(df.filter("false")).count() == 0


def near(text, rng):
    words = text.split()
    words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


def test_groups_against_brute_force(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(400)) for _ in range(8)]
    texts = [*base, *[near(rng.choice(base), rng) for _ in range(40)], base[0], base[0].upper(), *ODD]
    rows = simhash.near_duplicates(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    prints = {r.doc_id: slow_fingerprint(texts[r.doc_id] or "") for r in rows}
    roots = components(prints.values(), 3)
    first = {}
    for doc, value in sorted(prints.items()):
        first.setdefault(roots[value], doc)
    for r in rows:
        assert r.fingerprint % 2**64 == prints[r.doc_id]
        assert r.component == first[roots[prints[r.doc_id]]]


def test_null_and_repeated_rows(spark):
    rows = [(None, "one two three four"), (3, "one two three four"), (3, "one two three four"), (None, "other text is here"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS fingerprint", "1 AS key", "2 AS __id")
    got = sorted(((r.doc_id, r.component) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 3), (3, 3), (3, 3), (None, None), (4, 4), (5, 4)], key=str)
    kept = simhash.without_near_duplicates(df.drop("__id"))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, "one two three four"), (None, "other text is here"), (4, None)], key=str
    )
    assert kept.columns == df.drop("__id").columns
    assert simhash.near_duplicates(df.filter("false")).count() == 0
    assert simhash.without_near_duplicates(df.drop("__id").filter("false")).count() == 0


def test_registered_query(spark):
    rows = queries.op8_simhash(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(texts)
    prints = {d: slow_fingerprint(t) for d, t in texts.items()}
    roots = components(prints.values(), 3)
    first = {}
    for doc in sorted(prints):
        first.setdefault(roots[prints[doc]], doc)
    for r in rows:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}"
        assert r.component_id == first[roots[prints[r.doc_id]]]


def test_dedup_keeps_rows_whatever_the_columns_are_called(spark):
    docs = documents(spark, [f"text number {i} about subject {i * 7}" for i in range(20)] + ["same text here"] * 3)
    wanted = sorted(r.doc_id for r in simhash.without_near_duplicates(docs).collect())
    odd = docs.withColumns({n: F.lit(1) for n in ("__id", "__CHECK", "root", "best", "key", "a.b")})
    found = simhash.without_near_duplicates(odd)
    assert found.columns == odd.columns
    assert sorted(r.doc_id for r in found.collect()) == wanted and len(wanted) >= 1
