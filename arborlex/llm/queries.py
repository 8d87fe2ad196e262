"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arborlex.llm.warc import archive_pages

    read = archive_pages(spark, _table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arborlex.llm.decontaminate import overlaps

    return overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), short_items=True)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arborlex.llm.sharding import shard_digest

    return shard_digest(_table(spark, sf_dir, "documents"))


def op4_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arborlex.llm.hnsw import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arborlex.llm.toxicity import toxicity

    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arborlex.llm.mixing import mix_digest

    return mix_digest(_table(spark, sf_dir, "documents"))


def op7_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arborlex.llm.chaining import shared_passages

    return shared_passages(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arborlex.llm.quality import score_quality

    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arborlex.llm.jaccard import similar_components

    return similar_components(_table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arborlex.llm.secrets import secret_digest

    return secret_digest(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_decontamination, op3_sharding, op4_hnsw, op5_toxicity, op6_mixing, op7_chaining, op8_quality, op9_jaccard, op10_secrets)}
