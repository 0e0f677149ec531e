"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, stored


def components(edges: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, label): the smallest node each node of an edge is connected to.

    Alternates large stars (each node hands its larger neighbours its smallest
    one) and small stars (its smaller ones) until nothing changes: a number of
    rounds that grows with the logarithm of the longest path. Edges are stored
    after each round, and the round before is deleted; nothing is collected but a count and a checksum. Null
    ends are left out, loops count as edges of their node; no edges, no rows.
    """
    ends = edges.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v")).where(F.col(first).isNotNull() & F.col(second).isNotNull())
    now = stored(ends.distinct(), "edges")
    every = now
    state = None
    while True:
        both = now.where("u <> v").select("u", "v").unionAll(now.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.join(lowest, F.col("u") == F.col("c")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        paired = large.join(lowest, F.col("u") == F.col("c"))
        small = paired.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(lowest.select(F.col("c").alias("u"), F.col("m").alias("v")))
        before, now = now, stored(small.where("u <> v").distinct(), "edges")
        if before is not every:
            discard(before)
        after = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 30)))).first()
        if tuple(after) == state:
            break
        state = tuple(after)
    nodes = every.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    labels = now.groupBy("u").agg(F.min("v").alias("label"))
    return nodes.join(labels, F.col("node") == F.col("u"), "left").select("node", F.coalesce("label", "node").alias("label"))
