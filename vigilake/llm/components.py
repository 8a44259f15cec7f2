"""Consolidating pairwise matches into groups: connected components by low-diameter decomposition.

One level: every vertex draws an exponential shift and starts as a candidate centre at time ``-shift``; clusters grow
hop by hop (a vertex joins the centre whose shifted distance is least) for ``hops`` rounds, then each cluster becomes
one super-vertex, edges inside clusters vanish and the level repeats on the edges between clusters. The assignments of
the levels are composed. A vertex only ever joins a centre that its edges lead to, so contraction never merges what isn't
connected, and the recursion ends when no edge is left, so nothing connected stays apart: the result doesn't depend on the
draws, only the number of levels does. Expected levels grow with the logarithm of the number of vertices.

Scale: vertices and edges live in tables; each level's edges, vertices and assignments are cut into ``spark.checkpoint.dir``. Distances travel as
partial minima (map-side combine), repeated edges are removed first, and the two sides of a hub's edges are spread by AQE's
skew join; after the first level the hub and its neighbours are one vertex.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.tables import cut


def links(decisions: DataFrame, threshold: float = 0.70) -> DataFrame:
    """``(a, b)``: the linking verdicts. A row links if ``same_issue`` is true and ``confidence`` at least ``threshold``,
    whatever other rows say of the pair; null verdicts, confidences or candidates don't link."""
    linking = decisions.where(F.col("same_issue") & (F.col("confidence") >= threshold))
    return linking.select(F.col("candidate_a").alias("a"), F.col("candidate_b").alias("b"))


def _edges(pairs: DataFrame) -> DataFrame:
    """Both directions of each pair once, without loops and nulls."""
    kept = pairs.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    once = kept.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return once.select(F.explode(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))).alias("e")).select("e.src", "e.dst")


def components(pairs: DataFrame, beta: float = 0.2, hops: int = 2, max_levels: int = 64, seed: int = 7) -> DataFrame:
    """``(id, group)`` for each vertex of at least one pair ``(a, b)``; ``group`` is the smallest id of its component.

    Ids are of any one orderable type. Loops and pairs with nulls are ignored, repeated pairs count once; an empty input
    gives an empty result. ``beta`` is the rate of the exponential shifts (mean ``1/beta`` hops), ``hops`` the rounds of growth.
    """
    edges = cut(_edges(pairs))
    # Composed assignment: original vertex -> its super-vertex so far. A super-vertex bears the id of its centre.
    assigned = None
    for level in range(max_levels):
        uniform = (F.abs(F.xxhash64("v", F.lit(seed + level))) % 1_000_003 + 1) / 1_000_004.0
        reach = edges.groupBy(F.col("src").alias("v")).agg(F.lit(1).alias("one")).select("v", F.struct((F.log(uniform) / beta).alias("at"), F.col("v").alias("centre")).alias("r"))
        for _ in range(hops):
            told = edges.join(reach, edges.src == reach.v).select(F.col("dst").alias("v"), F.struct((F.col("r.at") + 1).alias("at"), F.col("r.centre").alias("centre")).alias("r"))
            reach = reach.unionByName(told).groupBy("v").agg(F.min("r").alias("r"))
        cluster = cut(reach.select("v", F.col("r.centre").alias("centre")))
        if assigned is None:
            assigned = cluster.select(F.col("v").alias("id"), F.col("centre").alias("at"))
        else:
            moved = assigned.join(cluster, assigned["at"] == cluster["v"], "left")
            assigned = cut(moved.select("id", F.coalesce("centre", "at").alias("at")))
        left, right = cluster.select(F.col("v").alias("src"), F.col("centre").alias("s")), cluster.select(F.col("v").alias("dst"), F.col("centre").alias("d"))
        crossing = edges.join(left, "src").select("s", "dst").distinct().join(right, "dst").where(F.col("s") != F.col("d"))
        edges = cut(crossing.select(F.col("s").alias("src"), F.col("d").alias("dst")).distinct())
        if edges.isEmpty():
            break
    else:
        raise RuntimeError(f"edges are left after {max_levels} levels")
    names = assigned.groupBy("at").agg(F.min("id").alias("group"))
    return assigned.join(names, "at").select("id", "group")


def found(decisions: DataFrame) -> DataFrame:
    """``(group_id, issue_id)``: one row per issue linked to at least one other issue."""
    return components(links(decisions)).select(F.col("group").alias("group_id"), F.col("id").alias("issue_id"))
