"""Label tables: active labels, merging, revision, prompts, numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlex.functions.text import normalize_text
from arborlex.operators.storage import narrow_join


def active_labels(seeds: DataFrame, dynamic: DataFrame) -> DataFrame:
    """id, name, definition, immutable: seeds and dynamic labels."""
    plain = lambda df, fixed: df.select("id", "name", "definition", F.lit(fixed).alias("immutable"))
    return plain(seeds, True).unionByName(plain(dynamic, False))


def label_problems(labels: DataFrame, expected: int) -> DataFrame:
    """One row: how many labels, ids and normalized names there are."""
    return labels.agg(
        F.count(F.lit(1)).alias("labels"), F.count_distinct("id").alias("ids"), F.count_distinct(normalize_text("name")).alias("names")
    ).withColumn("ok", (F.col("labels") == expected) & (F.col("ids") == expected) & (F.col("names") == expected))


def next_label_number(active: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row: the number after the largest in use."""
    ids = active.select("id").union(aliases.select("source"))
    number = F.regexp_extract("id", r"^L(\d+)\z", 1)
    return ids.where(number != "").agg((F.coalesce(F.max(number.cast("long")), F.lit(0)) + 1).alias("next_number"))


def name_collisions(new: DataFrame, active: DataFrame) -> DataFrame:
    return new.select(normalize_text("name").alias("name")).intersect(active.select(normalize_text("name").alias("name")))


def merge_labels(dynamic: DataFrame, merges: DataFrame, version: int) -> DataFrame:
    """Dynamic labels after merges (source, target): sources go, dynamic targets get
    their counts."""
    gone = narrow_join(dynamic, merges, dynamic["id"] == merges["source"])
    sums = gone.groupBy(F.col("target").alias("id")).agg(F.sum("usage_count").alias("_u"), F.sum("proposal_support_count").alias("_p"))
    left = narrow_join(dynamic, merges.select(F.col("source").alias("id")), "id", "left_anti").join(sums, "id", "left")
    return left.withColumns({
        "usage_count": F.col("usage_count") + F.coalesce("_u", F.lit(0)), "proposal_support_count": F.col("proposal_support_count") + F.coalesce("_p", F.lit(0)),
        "last_modified_version": F.when(F.col("_u").isNotNull(), F.lit(version)).otherwise(F.col("last_modified_version")),
    }).drop("_u", "_p")


def merge_aliases(aliases: DataFrame, merges: DataFrame) -> DataFrame:
    """Aliases after merges: those that led to a source lead to its target."""
    m = merges.select(F.col("source").alias("_s"), F.col("target").alias("_t"))
    moved = narrow_join(aliases, m, F.col("target") == F.col("_s"), "left").select("source", F.coalesce("_t", "target").alias("target"))
    return moved.unionByName(merges.select("source", "target"))


def revise_labels(dynamic: DataFrame, revisions: DataFrame, version: int) -> DataFrame:
    r = revisions.select(F.col("label_id").alias("id"), F.col("name").alias("_n"), F.col("definition").alias("_d"))
    return narrow_join(dynamic, r, "id", "left").withColumns({
        "name": F.coalesce("_n", "name"), "definition": F.coalesce("_d", "definition"),
        "last_modified_version": F.when(F.col("_n").isNotNull(), F.lit(version)).otherwise(F.col("last_modified_version")),
    }).drop("_n", "_d")


def prompt_lines(labels: DataFrame) -> DataFrame:
    """One row: a line for each label in id order. Bounded by the label cap."""
    line = F.concat("id", F.lit(" | "), "name", F.lit(": "), "definition")
    return labels.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", line.alias("line")))), lambda x: x["line"]), "\n").alias("prompt"))


def promotion_support(new: DataFrame, pool: DataFrame) -> DataFrame:
    """name, proposal_support_count of new labels (name, candidate_group_ids)."""
    ids = new.select("name", F.explode("candidate_group_ids").alias("group_id"))
    return ids.join(pool, "group_id").groupBy(ids["name"]).agg(F.sum("support_count").alias("proposal_support_count"))
