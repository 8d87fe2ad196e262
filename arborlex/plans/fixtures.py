"""What the registered queries run on: logs, pools and labels derived from the test
tables by rules that SQL can express, too (see the CTEs in oracles.py)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlex.functions import text as T
from arborlex.operators.labels_log import proposal_groups
from arborlex.operators.ordering import with_index

#: The 24 seed topics.
SEEDS = (
    "Adult Content", "Art & Design", "Software Development", "Crime & Law", "Education & Jobs", "Electronics & Hardware",
    "Entertainment", "Social Life", "Fashion & Beauty", "Finance & Business", "Food & Dining", "Games",
    "Health", "History & Geography", "Home & Hobbies", "Industrial", "Literature", "Politics",
    "Religion", "Science, Math & Technology", "Software", "Sports & Fitness", "Transportation", "Travel & Tourism",
)
DYNAMIC = (("L025", "Quantum computing"), ("L026", "Robotics"), ("L027", "Astronomy"), ("L028", "Linguistics"))
ALIASES = (("L029", "L027"), ("L030", "L029"), ("L031", "L003"))
MERGES = (("L026", "L025"), ("L028", "L003"))
CURSOR = 100


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"L{i:03d}", n, f"About {n}") for i, n in enumerate(SEEDS, 1)], "id string, name string, definition string")


def dynamic(spark: SparkSession) -> DataFrame:
    rows = [(i, n, f"About {n}", 2, 2) for i, n in DYNAMIC]
    return spark.createDataFrame(rows, "id string, name string, definition string, created_version long, last_modified_version long")


def aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ALIASES), "source string, target string")


def merges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MERGES), "source string, target string")


def top_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, tok, pos: each document's three most frequent words of six letters."""
    words = documents(spark, sf).select("doc_id", F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("tok")).where(F.length("tok") >= 6)
    counts = words.groupBy("doc_id", "tok").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("n"), "tok"))
    return counts.withColumn("pos", rank - 1).where("pos < 3").select("doc_id", "tok", "pos")


def sequenced(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, seq."""
    return with_index(documents(spark, sf).select("doc_id"), "doc_id").select("doc_id", (F.col("pos") + 1).alias("seq"))


def log(spark: SparkSession, sf: str) -> DataFrame:
    """seq, doc_id, taxonomy_version, assigned_label_ids."""
    d = F.col("doc_id")
    ids = F.array(T.label_code(d % 24 + 1), T.label_code(d % 7 + 25))
    more = F.when(d % 10 == 0, F.array_distinct(F.concat(ids, F.array(F.lit("L027"), F.lit("L029"))))).otherwise(ids)
    return sequenced(spark, sf).select("seq", d.cast("string").alias("doc_id"), (F.floor(F.col("seq") / 256) + 1).cast("long").alias("taxonomy_version"), more.alias("assigned_label_ids"))


def proposal_rows(spark: SparkSession, sf: str) -> DataFrame:
    """seq, doc_id, pos, name, definition."""
    rows = top_tokens(spark, sf).join(sequenced(spark, sf), "doc_id")
    return rows.select("seq", F.col("doc_id").cast("string").alias("doc_id"), "pos", F.concat(F.lit("Topic "), "tok").alias("name"), F.concat(F.lit("Documents about "), "tok").alias("definition"))


def groups(spark: SparkSession, sf: str) -> DataFrame:
    return proposal_groups(proposal_rows(spark, sf))


def named_pool(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates named by each document's top words together: group_id, name,
    definition, support_count."""
    names = top_tokens(spark, sf).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "tok"))), lambda x: x["tok"]), " ").alias("name"))
    rows = names.select(F.col("doc_id").alias("seq"), F.lit(0).alias("pos"), "name", F.concat(F.lit("About "), "name").alias("definition"))
    return proposal_groups(rows)


def decisions(pool: DataFrame) -> DataFrame:
    """A decision for each group, by its support."""
    action = F.element_at(F.array(F.lit("keep_candidate"), F.lit("discard_candidate"), F.lit("map_existing")), (F.col("support_count") % 3 + 1).cast("int"))
    return pool.select(F.col("group_id").alias("proposal_group_id"), action.alias("action"))


def assignments(pool: DataFrame) -> DataFrame:
    """group_id, rep: the smallest id among names whose word begins alike."""
    start = F.substring(F.regexp_replace("name", "^Topic ", ""), 1, 4)
    rows = pool.select("group_id", start.alias("start"))
    reps = rows.groupBy("start").agg(F.min("group_id").alias("rep"))
    return rows.join(reps, "start").select("group_id", "rep", "start")
