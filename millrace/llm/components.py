"""Connected components of a table of links, by large-star and small-star rounds.

Each round is joins and grouped minima, whose partial aggregates and skew-split joins bear a node with
a large part of all links. Rounds are written to the shared folder, so that the lineage stays short
and lost executors cost one round at most. The number of rounds grows with the logarithm of the
longest path. Null ends and links of a node to itself are ignored; repeated links count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star links the larger neighbours of a node with its least one; small star the smaller ones and itself."""
    if large:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u <> v")


def connected(edges: DataFrame, work: Work, u: str = "u", v: str = "v", rounds: int = 60) -> DataFrame:
    """node and component (its least node), for every node that has a link."""
    now = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, before = work.write(now, "links"), None
    for _ in range(rounds):
        new = work.write(_star(_star(now, True), False).distinct(), "links")
        mark = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        work.drop(now)
        now = new
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
