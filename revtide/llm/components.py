"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _signature(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))
        ).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge; the root is the smallest node.

    ``edges`` has two columns of one orderable type.  Loops, repeats and either
    direction are allowed; edges with a null end are ignored.  Each round is
    written to the shared scratch folder, and a component of any size is only
    ever aggregated, never gathered.
    """
    a, b = (F.col(f"`{name}`") for name in edges.columns)
    there = edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
    now = stored(there.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = _signature(now)
    while seen[0]:
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "stars")
        last, seen = seen, _signature(now)
        if seen == last:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
