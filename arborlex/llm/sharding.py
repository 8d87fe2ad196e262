"""Contiguous shards of near-equal byte size from global prefix sums (op3).

Each range partition's byte total is summed, the totals of all partitions before
it give its offset, and running sums within it give every row's place in the
whole corpus. The byte line is cut at equal targets; a row goes where its middle
byte falls. Nothing is collected: only one row for each partition is broadcast.

Defined results: null text has no bytes (size 1, CRC of nothing: 0); null keys
come first; equal keys are ordered by size, checksum and text hash, and rows
equal in these are interchangeable; an empty table gives an empty table; fewer
rows than shards leave shards empty; other columns are kept by `shard_documents`,
whose own columns win over clashing names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlex.llm.common import cut, global_order, numbered_copies, unused

SHARDS = 16


def place(narrow: DataFrame, order: list[str], shards: int = SHARDS) -> DataFrame:
    """`shard` and gapless `slot` for rows with a `size`, in the given order."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    # a number of their own parts equal rows among ranges
    apart = narrow.withColumn("_apart", F.monotonically_increasing_id())
    placed = global_order(apart, [*(F.col(c).asc_nulls_first() for c in order), F.col("_apart")], {"_before": "size"}, "shard").drop("_apart")
    middle = (2 * F.col("_before") + F.col("size")).cast("decimal(38,0)")
    cut_at = F.least(F.lit(shards - 1), F.floor(middle * shards / (2 * F.col("_before_all")).cast("decimal(38,0)")).cast("int"))
    sharded = placed.withColumn("shard", cut_at).drop("_before", "_before_all")
    # one row for each shard
    first = sharded.groupBy("shard").agg(F.min("_row").alias("_first"))
    return sharded.join(F.broadcast(first), "shard").withColumn("slot", F.col("_row") - F.col("_first")).drop("_row", "_first")


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size and checksums of each row: all that sharding looks at."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(body).alias("_tie"),
    )


def shard_digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    placed = place(digest(docs), ["doc_id", "size", "text_crc32", "_tie"], shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        F.col("shard").cast("int"), F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows themselves with `shard` and `slot`. Rows that agree in key, size
    and checksums share their places by their order within such a group."""
    order = ["doc_id", "size", "text_crc32", "_tie"]
    rows = docs.drop("shard", "slot")
    mine, copy = unused(rows.columns, "_mine", "_copy")
    body = F.coalesce(F.col(text), F.lit(""))
    digests = (F.col(key), (F.octet_length(body) + 1).cast("long"), F.crc32(body.cast("binary")).cast("long"), F.xxhash64(body))
    rows = rows.withColumn(mine, F.struct(*(c.alias(n) for n, c in zip(order, digests, strict=True))))
    rows = numbered_copies(rows, mine, copy)
    places = place(digest(docs, key, text), order, shards).select(F.struct(*order).alias("theirs"), "shard", "slot")
    places = numbered_copies(cut(places, "places"), "theirs", "copy")
    left, right = rows.alias("l"), places.alias("r")
    return left.join(right, F.col(f"l.{mine}").eqNullSafe(F.col("r.theirs")) & (F.col(f"l.{copy}") == F.col("r.copy"))).select("l.*", "r.shard", "r.slot").drop(mine, copy)
