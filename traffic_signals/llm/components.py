"""Connected components of a graph of links by alternating large-star and small-star, as DataFrame joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _least(edges: DataFrame) -> DataFrame:
    """For each node the least node among itself and its neighbours; edges hold both directions."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.where(F.col("v") > F.col("u")).join(_least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select("u", F.col("m").alias("v"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(moved).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one edge down, or edges from others, never both or several: then every component is a star around its least."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("hub")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("hub")))
    seen = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.max("hub").alias("hub"))
    return seen.where("up > 1 or (up = 1 and hub = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links between longs -> (node, root): the least node that each linked node reaches, roots included.

    Links may repeat and come in either direction; loops are ignored. Nodes without a link have no row. Each round is written to the
    shared folder; rounds end when all components are stars.
    """
    edges = staged(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    while not _stars(edges):
        edges = staged(_small_star(_large_star(edges)), "cc")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
