"""A training corpus from raw documents: five stages, each of which calls one of
the operators in arborlex.llm and hands its rows on as Parquet.

1. toxicity: documents with a score of 0.3 or more go (labels teach the scorer)
2. ngram_jaccard: of documents linked by 80 % of their word shingles, one stays
3. decontamination: documents that hold benchmark passages go
4. mixing: documents are dropped or repeated until sources weigh as they should
5. sharding: documents get a shard and a place in it

Null, empty and repeated rows are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arborlex.llm.common import cut
from arborlex.llm.decontaminate import drop_contaminated
from arborlex.llm.jaccard import one_of_each
from arborlex.llm.mixing import mix_documents
from arborlex.llm.sharding import shard_documents
from arborlex.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short_items=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The toxicity stage learns a model, which SQL doesn't express; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
