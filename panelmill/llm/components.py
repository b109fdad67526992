"""Connected components of an edge table, as stars around the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import store
from panelmill.session import Stored


def _star(edges: DataFrame, large: bool) -> Stored:
    """One step on distinct edges with u > v: link neighbours of every node to the smallest of them and itself.

    ``large``: the larger neighbours are moved; else the smaller ones and the node itself. The smallest neighbour of a
    node is stored first, so that the join back has plain exchanges on both sides and a hub can be split.
    """
    near = edges.union(edges.select("v", "u").toDF("u", "v")) if large else edges
    least = store(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star-least")
    joined = near.join(least.df, "u")
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select("v", "m").toDF("u", "v").union(least.df.toDF("u", "v"))
    out = store(moved.where(F.col("u") != F.col("v")).distinct(), "star-edges")
    least.delete()
    return out


def _is_done(edges: DataFrame) -> bool:
    """Whether every node has one edge at most and none leads on from where it leads to."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame) -> Stored:
    """The stored table (u, v) with v the smallest node that u can reach, for every node of ``edges`` but those smallest ones.

    Alternates large-star and small-star steps on stored tables until only stars are left, about as many rounds as the
    logarithm of the longest path. Runs when called. No edges: an empty table.
    """
    now = store(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "star-edges")
    while not _is_done(now.df):
        large = _star(now.df, True)
        now.delete()
        now = _star(large.df, False)
        large.delete()
    return now
