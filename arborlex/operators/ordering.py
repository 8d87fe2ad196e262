"""Positions in a global order without a single-partition window.

Rows are range-partitioned, each partition's row count is added up over the few
partitions before it, and rows are numbered within their partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlex.operators.storage import cut


def with_index(df: DataFrame, *by: str | Column, name: str = "pos") -> DataFrame:
    """df with `name`: each row's 0-based place in the order `by`."""
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), "order")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(W.partitionBy("_part").orderBy(*keys))
    # one row for each partition
    out = ranged.withColumn("_own", own).join(F.broadcast(offsets), "_part")
    return out.withColumn(name, F.col("_before") + F.col("_own") - 1).drop("_part", "_own", "_before")
