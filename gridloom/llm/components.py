"""Connected components of an edge table, and roots of a forest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm._shared import Scratch


def _rewire(edges: DataFrame, large: bool) -> DataFrame:
    """Points the larger (or smaller) neighbours of each node at the least node of its neighbourhood.

    A hub's edges are met by one row in the join, so a large side can be split over tasks."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    out = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = out.where(F.col("u") > F.col("v")) if large else out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node either has smaller neighbours, and then just one, or larger ones."""
    up = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    nodes = up.unionByName(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up + down > 1").isEmpty()


def components(edges: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """id, comp for every node of an edge: comp is the least id of its component. Loops, repeats and nulls don't matter.

    Large-star and small-star steps alternate until only stars are left."""
    edges = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = scratch.keep(edges, "edges")
    while not _stars(edges):
        edges = scratch.keep(_rewire(_rewire(edges, True), False).distinct(), "edges")
    leaves = edges.select(F.col("u").alias("id"), F.col("v").alias("comp"))
    return leaves.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())


def roots(parents: DataFrame, child: str, parent: str, scratch: Scratch) -> DataFrame:
    """id, comp for every node of a forest, in which each child has one parent: comp is its tree's root.

    Each round doubles the steps that a pointer takes."""
    at = scratch.keep(parents.select(F.col(child).alias("id"), F.col(parent).alias("comp"), F.lit(True).alias("moved")), "forest")
    while not at.where("moved").isEmpty():
        over = at.select(F.col("id").alias("_id"), F.col("comp").alias("_comp"))
        next_ = at.join(over, F.col("comp") == F.col("_id"), "left")
        moved = F.col("_comp").isNotNull()
        at = scratch.keep(next_.select("id", F.coalesce("_comp", "comp").alias("comp"), moved.alias("moved")), "forest")
    return at.select("id", "comp").unionByName(at.select(F.col("comp").alias("id"), "comp").distinct())
