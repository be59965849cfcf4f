"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.spool import discard, passing, spool


def _ragged(edges: DataFrame) -> bool:
    """Whether some node has a smaller neighbour and another neighbour besides. Without
    such a node every edge leads straight to the smallest node of its component."""
    both = edges.union(edges.select("v", "u"))
    ends = both.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most"))
    return ends.where("least < u and least < most").count() > 0


def _drawn_together(edges: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour to the larger ones, then to the smaller ones."""
    back = edges.selectExpr("v as u", "u as v")
    least = edges.union(back).groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    large = back.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
    return large.join(least, "u").select(F.explode(ends).alias("e")).select("e.u", "e.v").where("u <> v").distinct()


def stars(links: DataFrame) -> DataFrame:
    """Rows (``node``, ``component``) for the nodes of ``links`` (``a``, ``b``) that are
    not the smallest of their component, which is the component's name. ``links`` is
    read several times; stars found before may be among them, so that more links cost
    few rounds.

    Large and small stars alternate, in one job a round, until the edges are stars.
    Minima combine before the shuffle; the links of a node meet its minimum in one
    task. The number of rounds grows with the logarithm of the longest path.
    """
    with passing() as held:
        edges, found = links.selectExpr("greatest(a, b) as u", "least(a, b) as v").where("u <> v"), None
        while _ragged(edges):
            later = spool(_drawn_together(edges).toDF("node", "component"))
            if found is not None:
                discard(found)
            edges, found = later.toDF("u", "v"), later
        if found is None:
            found = spool(edges.distinct().toDF("node", "component"))
        held.append(found)
    return found


def components(links: DataFrame) -> DataFrame:
    """Rows (``node``, ``component``) for all nodes of ``links`` (``a``, ``b``); the
    component is its smallest node."""
    found = stars(links)
    return found.union(found.selectExpr("component as node", "component").distinct())
