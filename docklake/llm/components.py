"""Connected components of an undirected graph whose edges are table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklake.llm.common import stored
from docklake.session import delete_path


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _smallest(edges: DataFrame) -> DataFrame:
    """Per node ``a`` the smallest of itself and its neighbours ``b``."""
    return edges.groupBy("a").agg(F.min("b").alias("smallest")).select(
        "a", F.least("a", "smallest").alias("smallest")
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges(a, b)``; the root is the smallest node reachable.

    Alternating large and small stars: each round links every neighbour to the smallest one it sees, first upwards,
    then downwards, until the edges are stars around the roots. The minimum of a node is an aggregate with map-side
    combine, so a node with very many neighbours is never gathered in one task; the join that hands the minimum
    back can be split by adaptive execution. Each round's edges are a table in the shared scratch folder, the round
    before is deleted. Self-loops, repeated edges and nulls are dropped; no edges give no rows.
    """
    spark = edges.sparkSession
    now = stored(edges.where("a != b").select("a", "b").distinct(), "edges")
    before = _digest(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_smallest(both), "a").where("b > a").select(
            F.col("b").alias("a"), F.col("smallest").alias("b")
        ).distinct()
        least = _smallest(large)
        small = (
            large.join(least, "a").where("b != smallest").select(F.col("b").alias("a"), F.col("smallest").alias("b"))
            .unionByName(least.select("a", F.col("smallest").alias("b")))
            .where("a != b").distinct()
        )
        after = stored(small, "edges")
        delete_path(spark, now.inputFiles()[0].rpartition("/")[0])
        now, digest = after, _digest(after)
        if digest == before:
            break
        before = digest
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
