"""Batch classification with a pretrained classifier: sharded input, argmax label,
JSON out, resumption by id."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlex.operators.inference import argmax, compact, label_name, length_batches
from arborlex.operators.labels_log import pending
from arborlex.sources.documents import missing_fields, url_text


def predict(docs: DataFrame, logits: Callable[[Sequence[str]], np.ndarray], names: dict, with_url: bool = False, batch: int = 256, length_aware: bool = True, bucket: int = 4096) -> DataFrame:
    """docs with predicted_label. `logits` gives a row for each text; its batches hold
    texts of like length from buckets of rows as they come."""
    if bucket < batch:
        raise ValueError("a bucket must hold a batch")
    if (bad := missing_fields(docs).first()) is not None:
        raise ValueError(f"a document is without {bad.missing}")
    text = url_text(docs) if with_url and "url" in docs.columns else F.concat(F.lit("\n\n"), "text") if with_url else F.col("text")
    rows = docs.withColumn("_input", text)
    columns = [c for c in docs.columns if c != "_input"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = ((text, kept) for frame in batches for text, *kept in frame[["_input", *columns]].itertuples(index=False, name=None))
        buckets = length_batches(each, batch, bucket if length_aware else batch, lambda r: len(r[0]) if length_aware else 0)
        for part in buckets:
            out = np.asarray(logits([text for text, _ in part]), dtype=float)
            if len(out) != len(part):
                raise ValueError(f"{len(out)} predictions for {len(part)} texts")
            yield pd.DataFrame([kept for _, kept in part], columns=columns).assign(_logits=out.tolist())

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    scored = rows.mapInPandas(run, f"{kept}, _logits array<double>")
    return scored.withColumn("predicted_label", label_name(argmax("_logits"), names)).drop("_logits")


def classify_to(docs: DataFrame, output: str, logits: Callable[[Sequence[str]], np.ndarray], names: dict, short: bool = False, resume: bool = False, **options) -> None:
    """Writes predictions as JSON. An existing output is added to when resuming (ids
    that are in it are left out), and is an error otherwise."""
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(output)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    if there and not resume:
        raise ValueError(f"{output} exists")
    if there:
        docs = pending(docs, spark.read.schema("doc_id string").json(output))
    out = predict(docs, logits, names, **options)
    (compact(out) if short else out).write.mode("append").json(output)
