"""Operators over the discovery log: usage, proposals, integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlex.functions import text as T
from arborlex.operators.storage import narrow_join

LOG = "seq long, doc_id string, taxonomy_version long, assigned_label_ids array<string>, proposed_labels array<struct<proposal_id:string,name:string,definition:string>>"


def alias_closure(aliases: DataFrame) -> DataFrame:
    """source, target: every alias with the label at the end of its chain. The table
    is bounded by the label cap, so it is resolved by a recursive query over few rows.
    A chain that doesn't end (a cycle) leaves its source out."""
    spark = aliases.sparkSession
    aliases.createOrReplaceTempView("_aliases")
    return spark.sql("""
        WITH RECURSIVE walk(source, at, steps) AS (
            SELECT source, target, 1 FROM _aliases
            UNION ALL
            SELECT w.source, a.target, w.steps + 1 FROM walk w JOIN _aliases a ON a.source = w.at WHERE w.steps < 99
        )
        SELECT w.source, w.at AS target FROM walk w LEFT ANTI JOIN _aliases a ON a.source = w.at
    """)


def resolve(ids: DataFrame, aliases: DataFrame, column: str = "label_id") -> DataFrame:
    """ids with `resolved`: the label itself, or what its alias ends at."""
    ends = alias_closure(aliases).select(F.col("source").alias("_s"), F.col("target").alias("_t"))
    # as few rows as there are labels
    return narrow_join(ids, ends, F.col(column) == F.col("_s"), "left").withColumn("resolved", F.coalesce("_t", column)).drop("_s", "_t")


def raw_usage(log: DataFrame) -> DataFrame:
    """label_id, uses: assignments by the id that was written, to be kept by epoch:
    counts add up, and aliases are resolved when read."""
    return log.select(F.explode("assigned_label_ids").alias("label_id")).groupBy("label_id").agg(F.count(F.lit(1)).alias("uses"))


def usage_counts(log: DataFrame, dynamic: DataFrame, aliases: DataFrame) -> DataFrame:
    """id, usage_count of every dynamic label; assignments count, also twice in one
    record; unused labels have 0."""
    used = resolve(raw_usage(log), aliases).groupBy(F.col("resolved").alias("id")).agg(F.sum("uses").alias("usage_count"))
    return dynamic.select("id").join(used, "id", "left").select("id", F.coalesce("usage_count", F.lit(0)).alias("usage_count"))


def unknown_labels(log: DataFrame, active: DataFrame, aliases: DataFrame) -> DataFrame:
    """doc_id, label_id of assignments to ids that are neither active nor aliases."""
    known = known_ids(active, aliases)
    ids = log.select("doc_id", F.explode("assigned_label_ids").alias("label_id"))
    # as few rows as there are labels
    return narrow_join(ids, known.withColumnRenamed("id", "label_id"), "label_id", "left_anti").select("doc_id", "label_id")


def known_ids(active: DataFrame, aliases: DataFrame) -> DataFrame:
    return active.select("id").union(aliases.select("source")).distinct()


def proposals(log: DataFrame, after_seq: int = 0) -> DataFrame:
    """seq, doc_id, pos, proposal_id, name, definition of records beyond a cursor."""
    rows = log.where(F.col("seq") > after_seq)
    return rows.select("seq", "doc_id", F.posexplode("proposed_labels").alias("pos", "p")).select("seq", "doc_id", "pos", "p.*")


def proposal_groups(rows: DataFrame) -> DataFrame:
    """group_id, name, definition, support_count: of equal normalized text, the text
    seen first (by seq, then place)."""
    first = F.min(F.struct("seq", "pos", "name", "definition"))
    grouped = rows.groupBy(T.proposal_group_id("name", "definition").alias("group_id")).agg(first.alias("f"), F.count(F.lit(1)).alias("support_count"))
    return grouped.select("group_id", "f.name", "f.definition", "support_count")


def group_collisions(rows: DataFrame) -> DataFrame:
    """group_id, signatures: groups with more than one normalized text (none, unless
    hashes collide)."""
    signature = F.concat_ws("\0", T.normalize_text("name"), T.normalize_text("definition"))
    return rows.groupBy(T.proposal_group_id("name", "definition").alias("group_id")).agg(F.count_distinct(signature).alias("signatures")).where("signatures > 1")


def seq_gaps(log: DataFrame) -> DataFrame:
    """One row: whether seq runs 1, 2, ... without gaps or repeats."""
    return log.agg(
        F.coalesce(F.min("seq"), F.lit(1)).alias("first_seq"), F.coalesce(F.max("seq"), F.lit(0)).alias("latest_seq"),
        F.count(F.lit(1)).alias("records"), F.count_distinct("seq").alias("distinct_seqs"),
    ).withColumn("contiguous", (F.col("first_seq") == 1) & (F.col("latest_seq") == F.col("records")) & (F.col("distinct_seqs") == F.col("records")))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def pending(docs: DataFrame, done: DataFrame) -> DataFrame:
    return docs.join(done.select("doc_id"), "doc_id", "left_anti")


def orphans(done: DataFrame, docs: DataFrame) -> DataFrame:
    return done.select("doc_id").join(docs.select("doc_id"), "doc_id", "left_anti")


def coverage_mismatch(expected: DataFrame, returned: DataFrame) -> DataFrame:
    """id, problem ('missing' or 'unknown') of ids on one side only."""
    e, r = expected.select(F.col("id").alias("e")).distinct(), returned.select(F.col("id").alias("r")).distinct()
    both = e.join(r, F.col("e") == F.col("r"), "full_outer").where("e is null or r is null")
    return both.select(F.coalesce("e", "r").alias("id"), F.when(F.col("r").isNull(), "missing").otherwise("unknown").alias("problem"))


def empty_evidence(log: DataFrame) -> DataFrame:
    """Records without a label and without a proposal; they are kept and flagged."""
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    return log.withColumn("empty_evidence", none("assigned_label_ids") & none("proposed_labels"))


def duplicate_proposals(log: DataFrame) -> DataFrame:
    """doc_id of records that propose the same normalized text twice."""
    signature = F.transform("proposed_labels", lambda p: F.concat_ws("\0", T.normalize_text(p["name"]), T.normalize_text(p["definition"])))
    return log.where(F.size(signature) != F.size(F.array_distinct(signature))).select("doc_id")


def record_problems(log: DataFrame) -> DataFrame:
    """doc_id, problem of records that can't stand by themselves."""
    twice = lambda c: F.size(c) != F.size(F.array_distinct(c))
    signature = F.transform("proposed_labels", lambda p: F.concat_ws("\0", T.normalize_text(p["name"]), T.normalize_text(p["definition"])))
    problem = (
        F.when(F.coalesce(F.col("seq"), F.lit(0)) < 1, "seq is not positive").when(F.coalesce(F.col("doc_id"), F.lit("")) == "", "no doc_id")
        .when(F.coalesce(F.col("taxonomy_version"), F.lit(0)) < 1, "taxonomy_version is not positive")
        .when(F.col("assigned_label_ids").isNull() | F.col("proposed_labels").isNull(), "labels are missing").when(twice("assigned_label_ids"), "a label is assigned twice")
        .when(twice(F.col("proposed_labels.proposal_id")), "a proposal id occurs twice").when(twice(signature), "a label is proposed twice")
    )
    return log.select("doc_id", problem.alias("problem")).where("problem is not null")
