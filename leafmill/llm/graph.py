"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations and two joins on narrow edges, written to the shared folder, so lineage stays short. The
minimum of a node's neighbours is taken with partial aggregation first, then joined back: a node with very many
neighbours is spread over tasks by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.session import drop_scratch, materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b): root is the smallest node that it is connected with.

    Null ends are ignored, repeated edges and loops do no harm; without edges the result is empty.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u is not null and v is not null and u <> v").distinct()
    now = materialize(now, "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or state == before:
            break
        before = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        done, now = now, materialize(small.distinct(), "edges")
        drop_scratch(edges.sparkSession, done)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
