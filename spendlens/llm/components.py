"""Connected components of a link table, without collecting any of it.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014).  Every round is aggregations and
joins on the links; the minimum of a node's neighbours is summed up before the
shuffle, and the join against it can be split by AQE, so a node with a large
share of all links does not land in one task.  Each round is written to the
shared checkpoint folder; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


#: A node with more than this share of all link ends is a hub; fewer nodes than its inverse can be.
HUB_SHARE = 0.001


def _beside_least(edges: DataFrame, least: DataFrame, ends: int) -> DataFrame:
    """``edges`` (a, b) with the value ``m`` of ``least`` (a, m, degree) beside each.
    The few hubs are joined by broadcast, so that no key of the shuffled join is hot."""
    hub = F.col("degree") > HUB_SHARE * ends
    hubs = F.broadcast(least.where(hub).select("a", "m"))
    return (edges.join(hubs, "a").select("a", "b", "m")
            .unionByName(edges.join(hubs.select("a"), "a", "left_anti").join(least.where(~hub).select("a", "m"), "a")
                         .select("a", "b", "m")))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b); the label is the
    smallest node of its component."""
    def oriented(df: DataFrame) -> DataFrame:
        return (df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    now = written(oriented(links), "links")
    mark = _mark(now)
    while mark[0]:
        ends = 2 * mark[0]
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degree = F.count(F.lit(1)).alias("degree")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), degree)
        large = _beside_least(both.where("b > a"), least, ends).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"), degree)
        small = (_beside_least(large, least, ends).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        now = written(oriented(small), "links")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
