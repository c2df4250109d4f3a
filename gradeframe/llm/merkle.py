"""A Merkle manifest of a dataset: a digest for each row, a root for all, a proof for each row.

H is the lower-case hex SHA-256 of its inputs, concatenated; digests go in as hex text. Rows
of one group (a language) are the leaves of a binary tree, in the order of their key; a node
without a sibling becomes the H of itself alone. The roots of the groups are the leaves of
one more such tree.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import column, small, stored

# Leaves in a block are at most two to this power: what one row of a block table holds.
BLOCK_BITS = 10

_PLACE = (1 << 33) - 1  # the row's place in its partition, in monotonically_increasing_id


def row_digest(fields: Sequence[Column]) -> Column:
    """H of the fields, each ``-`` if NULL, else its bytes in UTF-8 as ``length:value``."""

    def part(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(f) for f in fields]), 256)


def ranked(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """Store rows with ``rank``, their place within the group from 0, and ``n``, its size.

    A range partitioning over all rows sorts them, so a group of any size is spread, and
    ``tie`` spreads equal rows. Ranks are places in a partition plus the rows of the group in the
    partitions before it: a table of one row per group and partition.
    """
    placed = rows.repartitionByRange(group, *order, "tie").sortWithinPartitions(group, *order, "tie")
    placed = stored(placed.drop("tie").withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    counts = placed.groupBy(F.col(group).alias("g"), part.alias("part")).agg(
        F.count(F.lit(1)).alias("own"), F.min(F.col("at").bitwiseAND(_PLACE)).alias("first")
    )
    counts = counts.selectExpr(
        "g",
        "part",
        "sum(own) over (partition by g) as n",
        "sum(own) over (partition by g order by part) - own - first as shift",
    )
    there = placed.withColumn("part", part).alias("r").join(
        small(counts, f"{name}-counts").alias("c"),
        (F.col("r.part") == F.col("c.part")) & F.col(f"r.{group}").eqNullSafe(F.col("c.g")),
    )
    rank = (F.col("r.at").bitwiseAND(_PLACE) + F.col("c.shift")).alias("rank")
    return there.select(*[f"r.{c}" for c in rows.columns if c != "tie"], rank, F.col("c.n").alias("n"))


def _blocks(nodes: DataFrame, bits: int) -> DataFrame:
    """Rows (grp, block, n, node) of nodes (grp, rank, n, node): the tree over ``2 ** bits``
    neighbours. Binary digits of the rank are grouped away one by one, the lowest first;
    a parent ``struct<h, kids>`` holds its children. All steps share one shuffle by block.
    A group with one node left is not hashed any further.
    """
    digits = [f"d{j}" for j in range(bits)]
    base = ["grp", "block", "n"]
    block = F.shiftright("rank", bits).alias("block")
    split = [F.shiftright("rank", j).bitwiseAND(1).alias(d) for j, d in enumerate(digits)]
    tree = nodes.select("grp", block, "n", *split, "node").repartition("grp", "block")
    tree = tree.sortWithinPartitions(*base, *reversed(digits))
    for j, digit in enumerate(digits):
        keys = [*base, *reversed(digits[j + 1 :])]
        left, right = (F.first(F.when(F.col(digit) == side, F.col("node")), ignorenulls=True) for side in (0, 1))
        kids = tree.groupBy(*keys).agg(left.alias("left"), right.alias("right"))
        several = F.col("n") > (1 << j)
        digest = F.sha2(F.concat("left.h", F.coalesce(F.col("right.h"), F.lit(""))), 256)
        h = F.when(several, digest).otherwise(F.col("left.h")).alias("h")
        node = F.struct(h, F.array_compact(F.array("left", "right")).alias("kids"))
        tree = kids.select(*keys, node.alias("node"))
    return tree


def _leaves(blocks: DataFrame, bits: int) -> DataFrame:
    """Rows (grp, rank, leaf, path, top) of blocks (grp, block, n, node, path, top), unfolded
    level by level. A step of a path is ``<`` or ``>`` for the side the sibling is on and its
    digest, or ``=`` where there is none."""
    rows = blocks.withColumnRenamed("block", "rank")
    for j in reversed(range(bits)):
        rows = rows.select("grp", "rank", "n", "path", "top", "node.kids", F.posexplode("node.kids").alias("i", "node"))
        side = F.when(F.col("i") == 0, F.lit(">")).otherwise(F.lit("<"))
        step = F.when(F.size("kids") == 2, F.concat(side, F.get("kids", 1 - F.col("i"))["h"])).otherwise(F.lit("="))
        path = F.when(F.col("n") > (1 << j), F.concat(F.array(step), "path")).otherwise(F.col("path"))
        rows = rows.select("grp", (F.col("rank") * 2 + F.col("i")).alias("rank"), "n", path.alias("path"), "top", "node")
    return rows.select("grp", "rank", F.col("node").alias("leaf"), "path", "top")


def _proofs(nodes: DataFrame, bits: int, above: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Rows (grp, rank, leaf, path, top) for nodes (grp, rank, n, node); ``above`` gives
    (grp, rank, path, top) for the roots (grp, node) of the groups.

    Blocks go up as the nodes of a tree a thousand times smaller. Paths come back down
    in a grouping by block of the blocks and the paths of their roots; no leaf is joined.
    """
    most = nodes.agg(F.max("n").alias("n")).first().n or 1
    bits = min(bits, (most - 1).bit_length())  # a smaller tree has fewer levels
    blocks = stored(_blocks(nodes, bits), f"{name}-blocks")
    tops = blocks.select("grp", F.col("block").alias("rank"), F.shiftright(F.col("n") + ((1 << bits) - 1), bits).alias("n"), "node.h")
    tops = tops.select("grp", "rank", "n", F.struct("h").alias("node"))
    if most > 1 << bits:
        upper = _proofs(tops, bits, above, name).select("grp", "rank", "path", "top")
    else:
        upper = above(tops.select("grp", "node"))
    both = blocks.select("grp", "block", "n", "node").unionByName(
        upper.select("grp", F.col("rank").alias("block"), "path", "top"), allowMissingColumns=True
    )
    met = both.groupBy("grp", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", "top")])
    return _leaves(met, bits)


def manifest(
    documents: DataFrame,
    fields: Sequence[Column],
    claimed: Sequence[Column] | None = None,
    key: str = "doc_id",
    group: str = "lang",
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Rows (key, leaf, claimed, subroot, root, path), one for each document.

    ``fields`` make a leaf. ``claimed`` are the fields of a copy to be checked against the
    manifest (by default the same); ``folded`` leads from its digest along the path to the
    root it would have. Leaves are in the order of key and leaf, NULL first, so equal rows
    may swap places without a change; a NULL group is one of its own, before all others. A
    table without rows gives none. Only digests are shuffled, never texts; a path has one
    step for each level of the trees. Equal rows, and groups of any size, are spread.
    """
    leaf = row_digest(fields)
    hashed = documents.select(
        column(documents, group).alias("grp"),
        column(documents, key).alias("key"),
        leaf.alias("h"),
        (row_digest(claimed) if claimed is not None else leaf).alias("claimed"),
        F.monotonically_increasing_id().alias("tie"),
    )
    leaves = ranked(stored(hashed, "leaves"), "grp", ["key", "h"], "ranked-leaves")
    nodes = leaves.select("grp", "rank", "n", F.struct("h", "key", "claimed").alias("node"))

    def root(tops: DataFrame) -> DataFrame:
        end = F.array().cast("array<string>").alias("path")
        return tops.select("grp", F.lit(0).cast("bigint").alias("rank"), end, F.struct(F.col("node.h").alias("root")).alias("top"))

    def whole(subroots: DataFrame) -> DataFrame:
        one = subroots.select(F.lit(0).alias("all"), "grp", "node.h", F.lit(0).alias("tie"))
        order = ranked(one, "all", ["grp"], "ranked-groups")
        roots = order.select(F.col("all").alias("grp"), "rank", "n", F.struct("h", F.col("grp").alias("key")).alias("node"))
        found = _proofs(roots, bits, root, "groups")
        top = F.struct(F.col("leaf.h").alias("subroot"), F.col("top.root").alias("root"))
        return found.select(F.col("leaf.key").alias("grp"), F.lit(0).cast("bigint").alias("rank"), "path", top.alias("top"))

    found = _proofs(nodes, bits, whole, "leaves")
    return found.select(F.col("leaf.key").alias(key), F.col("leaf.h").alias("leaf"), "leaf.claimed", "top.subroot", "top.root", "path")


def proof_digest(path: Column) -> Column:
    """H of the siblings of a path, from the leaf upwards."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.substr(s, F.lit(2))), ""), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest leads to along a path."""

    def up(h: Column, step: Column) -> Column:
        sibling = F.substr(step, F.lit(2))
        return F.sha2(F.when(F.left(step, F.lit(1)) == "<", F.concat(sibling, h)).otherwise(F.concat(h, sibling)), 256)

    return F.aggregate(path, digest, up)
