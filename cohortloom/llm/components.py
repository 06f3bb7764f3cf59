"""Connected components of an edge table, by alternating large and small stars.

Each round hangs every node's larger neighbours, then its smaller ones, onto its smallest neighbour, until the edges are
stars around the smallest node of each component. A round is two joins on a node with an aggregate of its neighbours: no
group is collected, and a node with very many neighbours is split by the skew join. Rounds are cut by checkpoints in the
shared folder; their number grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.frames import cut


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the long columns ``a`` and ``b``; ``root`` is the smallest node reachable.

    Repeated edges, loops and either order of the ends are fine; edges with a null end are left out. A node that has only
    loops is in no row.
    """
    stars = cut(_downward(edges.select("a", "b")))
    seen = _digest(stars)
    while True:
        both = stars.select("a", "b").union(stars.select("b", "a")).toDF("u", "v")
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _downward(both.where("v > u").join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        stars = cut(_downward(small.select("a", F.col("m").alias("b")).union(small.select("b", "m"))))
        before, seen = seen, _digest(stars)
        if seen == before:
            break
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _downward(edges: DataFrame) -> DataFrame:
    ends = edges.toDF("a", "b").where("a != b")
    return ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _digest(edges: DataFrame) -> tuple:
    """Tells two sets of edges apart; the edges themselves stay in the cluster."""
    mixed = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mixed).first())
