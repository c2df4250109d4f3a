"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root): every node of an edge and the smallest node it is linked to.

    Alternates large-star and small-star steps (Kiveris et al. 2014) until each node
    hangs on one root. All steps are minima counted before the shuffle and joins that can
    be split where a node has very many edges. A step is written to the shared folder,
    which ends its lineage. Loops and repeated edges do no harm, NULL ends are no edge.
    """
    edges = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter((F.col(a).isNotNull()) & (F.col(b).isNotNull()) & (F.col("u") != F.col("v")))
        .distinct()
    )
    edges = stored(edges, "edges")
    while not _is_forest_of_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(rest.unionByName(lowest.withColumnRenamed("m", "v")).distinct(), "edges")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Each node has one parent, and no parent has a parent."""
    up = edges.select(F.col("u").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs"))
    down = edges.select(F.col("v").alias("node"), F.lit(0).alias("ups"), F.lit(1).alias("downs"))
    nodes = up.unionByName(down).groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return nodes.filter("ups > 1 OR (ups > 0 AND downs > 0)").isEmpty()
