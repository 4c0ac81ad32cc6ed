"""Connected components by alternating large-star and small-star steps, as joins of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import checkpoint


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node of an edge, label being the smallest node that links reach.

    Both steps shuffle edges only, never a node's whole neighbourhood; a hub's edges meet in joins, which
    adaptive execution may split. Null ends and loops are left out. Each round is checkpointed. No edges: no rows.
    """
    now = checkpoint(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        count = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1)))).first()
        if tuple(count) == seen or not count[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        seen = tuple(count)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # now each edge leads from its larger end down
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = checkpoint(small.where("a <> b").distinct())
