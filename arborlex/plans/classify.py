"""Classification against a frozen taxonomy, with exact resumption."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlex.operators.inference import Labeler, label_documents
from arborlex.operators.labels_log import orphans, pending, seq_gaps
from arborlex.operators.ordering import with_index
from arborlex.operators.storage import cut, exists
from arborlex.operators.taxonomy import Taxonomy, TaxonomyError
from arborlex.sources.sinks import append_epoch, ensure_metadata, epochs, read_log

RESULT = "seq long, doc_id string, taxonomy_version long, taxonomy_hash string, assigned_label_ids array<string>"


def classified(docs: DataFrame, labeler: Labeler, taxonomy: Taxonomy, first_seq: int = 1, **options) -> DataFrame:
    """Records of documents, in id order; raises if the labeler's output is wrong."""
    if not taxonomy.frozen:
        raise TaxonomyError("the taxonomy isn't frozen")
    done = cut(label_documents(docs.select("doc_id", "text"), labeler, taxonomy.active, False, **options), "labels")
    bad = F.raise_error(F.concat("doc_id", F.lit(": "), "problem")).cast("string")
    rows = done.withColumn("doc_id", F.when(F.col("problem").isNotNull(), bad).otherwise(F.col("doc_id")))
    return with_index(rows, "doc_id").select(
        (F.col("pos") + first_seq).alias("seq"), "doc_id", F.lit(taxonomy.schema_version).cast("long").alias("taxonomy_version"),
        F.lit(taxonomy.frozen_hash).alias("taxonomy_hash"), "assigned_label_ids",
    )


def run_classification(docs: DataFrame, labeler: Labeler, taxonomy: Taxonomy, output: str, source: str = "", max_documents: int | None = None, **options) -> int:
    """Adds records of the documents that have none yet to `output`; how many."""
    spark = docs.sparkSession
    taxonomy.checked()
    meta = {"source": source, "taxonomy_hash": taxonomy.frozen_hash, "taxonomy_version": taxonomy.schema_version, "labeler": type(labeler).__name__, "created_at_unix": int(time.time())}
    if epochs(output):
        if not exists(f"{output}.meta.json"):
            raise ValueError(f"{output} has results but no metadata")
    ensure_metadata(f"{output}.meta.json", meta)
    done = read_log(spark, output, RESULT)
    state = seq_gaps(done).first()
    if not state.contiguous and state.records:
        raise ValueError(f"{output}: seq isn't contiguous")
    if not done.where((F.col("taxonomy_hash") != taxonomy.frozen_hash) | (F.col("taxonomy_version") != taxonomy.schema_version)).isEmpty():
        raise ValueError(f"{output} has results of another taxonomy")
    if docs.isEmpty():
        raise ValueError("no documents")
    if max_documents is None and not orphans(done, docs).isEmpty():
        raise ValueError(f"{output} has results of documents that aren't in the input")
    todo = pending(docs, done)
    if max_documents is not None:
        todo = todo.orderBy("doc_id").limit(max(0, max_documents - state.records))
    new = cut(classified(todo, labeler, taxonomy, state.latest_seq + 1, **options), "records")
    n = new.count()
    if n:
        append_epoch(new, output, max(epochs(output), default=0) + 1)
    return n
