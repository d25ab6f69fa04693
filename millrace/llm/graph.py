"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import has_rows
from millrace.session import Scratch, stored_rows


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a vertex is tied to the least vertex of that neighbourhood."""
    both = edges.union(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("m")).select(
        F.col("high").alias("u"), F.least("high", "m").alias("m")
    )
    return (
        both.where("low > high")
        .join(least, F.col("high") == F.col("u"))
        .where("low != m")
        .select(F.col("low").alias("high"), F.col("m").alias("low"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and all its lower neighbours are tied to the lowest of them."""
    least = edges.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
    lower = (
        edges.join(least, F.col("high") == F.col("u"))
        .where("low != m")
        .select(F.col("low").alias("high"), F.col("m").alias("low"))
    )
    return lower.union(least.select("u", "m")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every vertex of an edge; component is its least vertex.

    Alternates the two star steps until the edges are a forest of stars, which takes a
    number of rounds that grows with the logarithm of the graph. Minima are taken before
    the shuffle, so a vertex with very many edges is summed up in each task first; joins
    on it are split by adaptive execution. Each round is written to the shared folder.
    No edges give no rows; loops, repeated edges and edges with a null end are left out.
    """
    with Scratch(edges.sparkSession) as scratch:
        now = scratch.keep(
            edges.where(F.col(a) != F.col(b)).select(
                F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
            ).distinct()
        )
        while has_rows(now):
            now = scratch.keep(_small_star(_large_star(now)))
            twice = now.groupBy("high").count().where("count > 1").select("high")
            inner = now.select("high").join(now.select(F.col("low").alias("high")), "high", "left_semi")
            if not has_rows(twice.union(inner)):
                break
        leaves = now.select(F.col("high").alias("node"), F.col("low").alias("component"))
        roots = now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
        return stored_rows(leaves.union(roots))
