"""Connected components of a distributed edge list by alternating large-star and small-star rounds.

Every round is a shuffle join on the current edges, written with checkpoint(); the number of rounds
grows with the logarithm of the longest path.  Hub nodes are handled by a pre-aggregated minimum and
a join that adaptive execution can split; nothing is collected but one count a round.  The rounds end
when every node hangs on one other that hangs on none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import work_dir


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b) with a > b.  large: each node hands its larger neighbours to its least one.

    The large star may repeat rows, two for an edge at most; the small star after it leaves none."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every a has one b and no b is an a: then b is the least node of its component."""
    below = edges.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    above = edges.select(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    roles = below.unionByName(above).groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return not roles.where("below > 1 or below = 1 and above = 1").count()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): every node that has an edge, with the least node of its component."""
    work_dir(edges.sparkSession)
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct().checkpoint()
    while not _settled(now):
        now = _star(_star(now, True), False).checkpoint()
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
