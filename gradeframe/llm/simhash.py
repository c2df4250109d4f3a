"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .store import Batches, column, free_names, map_texts, ship_by_value, stored

BITS = 64
_HASHES_AT_ONCE = 65_536
_PLACES = np.arange(8, dtype=np.int16) * 256
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text, as a signed integer.

    Words are runs of anything but ASCII white space, A-Z lowered; shingles of
    ``shingle`` words count as often as they occur, a shorter text is one shingle, and a
    text without words has fingerprint 0. A bit is 1 if it is set in over half of the
    shingles' XXH64 values (seed 42).
    """
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
        n = len(words) - shingle + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for start in range(0, n, _HASHES_AT_ONCE):
        count = min(_HASHES_AT_ONCE, n - start)
        hashes = np.fromiter((digest(next(grams), 42) for _ in range(count)), np.uint64, count)
        # How often each byte value occurs at each place, then the bits of those values.
        places = hashes.view(np.uint8).reshape(-1, 8) + _PLACES
        ones += (np.bincount(places.ravel(), minlength=8 * 256).reshape(8, 256) @ _BYTE_BITS).ravel()
    packed = np.packbits(ones * 2 > n, bitorder="little")
    return int(packed.view(np.int64)[0])


def with_fingerprint(df: DataFrame, shingle: int = 3) -> DataFrame:
    """Replace ``text`` by its ``fingerprint`` BIGINT; a NULL text counts as empty."""

    def run(texts: list[str]) -> list[pa.Array]:
        return [pa.array([fingerprint(t, shingle) for t in texts], pa.int64())]

    return map_texts(df, run, "fingerprint bigint")


def block_masks(distance: int, blocks: int) -> list[int]:
    """Masks that each keep ``blocks - distance`` of the blocks a fingerprint is cut into.

    Two fingerprints that differ in at most ``distance`` bits differ in at most that many
    blocks, so they agree under at least one mask.
    """
    if not 0 <= distance < blocks <= BITS:
        raise ValueError("distance must be below the number of blocks")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def stars(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges (value, smallest value linked to it) of the distinct values of a bucket."""
    if len(values) == 2:
        a, b = int(values[0]), int(values[1])
        close = ((a ^ b) & (2**64 - 1)).bit_count() <= distance
        return [(max(a, b), min(a, b))] if close else []
    rest, found = np.sort(values), []
    while len(rest) > 1:
        root, frontier, rest = int(rest[0]), [rest[0]], rest[1:]
        while frontier and len(rest):
            near = np.bitwise_count((rest ^ frontier.pop()).view(np.uint64)) <= distance
            frontier.extend(rest[near])
            found.extend((int(v), root) for v in rest[near])
            rest = rest[~near]
    return found


def fingerprint_links(
    distinct: DataFrame, column: str = "fingerprint", distance: int = 3, blocks: int = 6, tile: int = 2048
) -> DataFrame:
    """Edges (a, b) that connect all fingerprints at most ``distance`` bits apart.

    ``distinct`` holds each fingerprint once. Fingerprints are joined on blocks, and the
    Hamming distance is then verified inside a bucket. A bucket returns edges to the
    smallest member of each group, not all pairs, which keeps what is connected. A bucket
    of more than ``tile`` fingerprints is cut into tiles that meet two by two in tasks of
    their own, so no task holds more than two tiles (twice that by chance) and no pair is
    left out.
    """
    masks = block_masks(distance, blocks)
    keys = F.array(
        *[F.struct(F.lit(i).alias("block"), F.col(column).bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)]
    )
    members = distinct.select(F.col(column).alias("value"), F.inline(keys))
    sizes = members.groupBy("block", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    tiled = (
        members.join(sizes, ["block", "bits"])
        .withColumn("tiles", tiles)
        .withColumn("own", F.pmod(F.xxhash64("value"), "tiles").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("block", "bits", "value", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    )
    buckets = tiled.groupBy("block", "bits", "lo", "hi").agg(F.collect_list("value").alias("values"))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for values in batch.column(0):
                found.extend(stars(values.values.to_numpy(zero_copy_only=False), distance))
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return buckets.filter(F.size("values") > 1).select("values").mapInArrow(run, "a bigint, b bigint")


def _identity(key: Column, text: Column) -> list[Column]:
    """96 bits that tell rows apart by key and text, NULLs included."""
    both = key, text, key.isNull(), text.isNull()
    return [F.xxhash64(*both).alias("__id"), F.hash(*both).alias("__check")]


def _grouped(df: DataFrame, key: str, text: str, shingle: int, distance: int, blocks: int) -> DataFrame:
    """Rows (key, __id, __check, fingerprint, root, component), as many as in ``df``."""
    source = df.select(
        column(df, key).alias("key"),
        *_identity(column(df, key), column(df, text)),
        column(df, text).cast("string").alias("text"),
    )
    rows = stored(with_fingerprint(source, shingle), "fingerprints")
    nodes = rows.groupBy("fingerprint").agg(F.min("key").alias("first"))
    links = fingerprint_links(nodes.select("fingerprint"), distance=distance, blocks=blocks)
    roots = connected_components(links)
    labelled = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    groups = labelled.groupBy("root").agg(F.min("first").alias("component"))
    named = labelled.join(groups, "root").select("fingerprint", "root", "component")
    return rows.join(named, "fingerprint")


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    distance: int = 3,
    blocks: int = 6,
) -> DataFrame:
    """Rows (key, fingerprint BIGINT, component): each document and its group.

    Documents whose fingerprints differ in at most ``distance`` bits are linked, and a
    group is all that links reach; ``component`` is its smallest non-NULL key (NULL if it
    has none). Every input row gives one output row, repeated rows and NULL keys
    included; empty and NULL texts share fingerprint 0. Copies are counted as one
    fingerprint before anything is compared, so a group of equal texts costs one row.

    ``blocks`` blocks, of which ``blocks - distance`` form a key: with 6 and 3 a key has
    32 bits, under 20 masks. More blocks mean longer keys for more rows.
    """
    rows = _grouped(df, key, text, shingle, distance, blocks)
    return rows.select(F.col("key").alias(key), "fingerprint", "component")


def without_near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    distance: int = 3,
    blocks: int = 6,
) -> DataFrame:
    """One row of each group of ``near_duplicates``, with the columns of ``df``.

    The row with the smallest key stays, NULL keys last; rows that repeat key and text
    count once. The texts are shuffled once, to meet the list of those that stay. Other
    columns may have any names.
    """
    rows = _grouped(df, key, text, shingle, distance, blocks)
    order = F.struct(F.col("key").isNull(), "key", "__id", "__check")
    kept = rows.groupBy("root").agg(F.min(order).alias("best")).select("best.__id", "best.__check")
    same = free_names(df, "__id", "__check")
    mine = _identity(column(df, key), column(df, text))
    marked = df.select("*", *[c.alias(name) for c, name in zip(mine, same)])
    kept = kept.toDF(*same)
    return marked.join(kept, same, "left_semi").dropDuplicates(same).drop(*same)


ship_by_value(__name__)
