"""Connected components of a graph given by edges, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, drop_table


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node of ``edges`` (``a, b``, longs).

    Large-star and small-star in turn: every node hands its larger neighbours,
    then its smaller ones, to the smallest node it knows, until no edge changes.  A
    node's smallest neighbour is aggregated map-side; each round is written to the
    checkpoint folder and the one before it deleted.
    """
    now = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if not now.limit(1).count():
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        after = cut_lineage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        new = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        drop_table(now)
        now = after
        if (new.n, new.h) == state:
            break
        state = (new.n, new.h)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
