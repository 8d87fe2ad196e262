"""Connected components over an edge table, by alternating large and small stars.

Each step groups edges by one end, takes the smallest neighbour and hangs the
others on it; both halves are a grouped minimum (pre-aggregated before the
shuffle) and a join, so a vertex with very many edges isn't gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlex.llm.common import cut, narrow_join


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for every node of edges (a, b)
    of one orderable type. Loops and repeated edges do no harm."""
    own = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    nodes = own.select(F.col("a").alias("node")).union(own.select("b")).distinct()
    seen = None
    while True:
        both = own.union(own.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "large")
        large = cut(narrow_join(both.where("b > a"), least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), "small")
        joined = narrow_join(large, least, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        own = cut(small.distinct(), "edges")
        now = own.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    # every edge now leads from a node to its component's smallest
    return nodes.join(own.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("b", "node").alias("component"))
