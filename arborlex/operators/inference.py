"""Document inference: labelers, output checks, the classifier's batch shape.

A labeler maps texts and the present labels to ids and proposals. It runs inside
mapInArrow with the labels as a snapshot; what it gives is written once before
anything is counted, as inference isn't to be repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlex.functions.text import fix_output, token_list
from arborlex.operators.ordering import with_index
from arborlex.operators.taxonomy import Label

OUTPUT = "assigned_label_ids array<string>, proposed_labels array<struct<name:string,definition:string>>, problem string"


class Labeler(Protocol):
    def __call__(self, texts: Sequence[str], labels: Sequence[Label], discover: bool) -> list[tuple[list[str], list[dict]]]:
        """For each text: label ids, and proposals if discovering."""


class LexicalLabeler:
    """Assigns labels whose trigger words occur; proposes the most frequent long
    words. triggers: label id -> words (by default the tokens of the label's name)."""

    def __init__(self, triggers: dict[str, Sequence[str]] | None = None, fallback: str | None = None, proposals: int = 3, length: int = 6) -> None:
        self.triggers, self.fallback, self.proposals, self.length = triggers, fallback, proposals, length

    def __call__(self, texts: Sequence[str], labels: Sequence[Label], discover: bool) -> list[tuple[list[str], list[dict]]]:
        import re

        words = {x.id: set((self.triggers or {}).get(x.id, token_list(x.name))) for x in labels}
        out = []
        for text in texts:
            tokens = re.findall(r"[a-z0-9]+", text.lower())
            have = set(tokens)
            ids = [i for i, w in words.items() if w & have] or ([self.fallback] if self.fallback else [])
            proposed = []
            if discover:
                counts = pd.Series([t for t in tokens if len(t) >= self.length], dtype=object).value_counts()
                top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: self.proposals]
                proposed = [{"name": f"Topic {t}", "definition": f"Documents about {t}"} for t, _ in top]
            out.append((ids, proposed))
        return out


class ReplayLabeler:
    """Gives recorded answers by text; raises for a text without one."""

    def __init__(self, answers: dict[str, tuple[list[str], list[dict]]]) -> None:
        self.answers = answers

    def __call__(self, texts: Sequence[str], labels: Sequence[Label], discover: bool) -> list[tuple[list[str], list[dict]]]:
        return [self.answers[t] for t in texts]


def check_output(ids: list[str], proposed: list[dict], valid: set[str], most_ids: int, most_proposed: int, least_ids: int) -> str | None:
    """What is wrong with a labeler's (mended) output."""
    if unknown := [i for i in ids if i not in valid]:
        return f"unknown label {unknown[0]}"
    if len(ids) > most_ids:
        return "too many labels"
    if len(ids) < least_ids:
        return "no label"
    if len(proposed) > most_proposed:
        return "too many proposals"
    return None


def label_documents(docs: DataFrame, labeler: Labeler, labels: Sequence[Label], discover: bool, batch: int = 512, most_ids: int = 5, most_proposed: int = 3, prepare: Callable[[str], str] | None = None) -> DataFrame:
    """docs (doc_id, text, and others) with the labeler's mended output and `problem`."""
    valid, snapshot = {x.id for x in labels}, list(labels)
    passed = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only `batch` texts at a time become Python strings."""
        proposal = pa.struct([("name", pa.string()), ("definition", pa.string())])
        kinds = (pa.list_(pa.string()), pa.list_(proposal), pa.string())
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                part = whole.slice(at, batch)
                texts = [prepare(t) if prepare else t for t in part.column("text").to_pylist()]
                rows = []
                for ids, proposed in labeler(texts, snapshot, discover):
                    ids, proposed = fix_output(ids, proposed)
                    rows.append((ids, proposed, check_output(ids, proposed, valid, most_ids, most_proposed if discover else 0, 0 if discover else 1)))
                if len(rows) != part.num_rows:
                    raise ValueError(f"{len(rows)} outputs for {part.num_rows} documents")
                out = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in passed), *out], names=[*passed, "assigned_label_ids", "proposed_labels", "problem"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(run, f"{kept}, {OUTPUT}")


# ------------------------------------------------------------ classification


def argmax(logits: str | Column) -> Column:
    """0-based place of the largest value, the first of equal ones."""
    c = F.col(logits) if isinstance(logits, str) else logits
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def label_name(predicted: str | Column, names: dict) -> Column:
    """The name under the id as a number, else under its text, else the text."""
    c = F.col(predicted) if isinstance(predicted, str) else predicted
    table = {str(k): v for k, v in names.items()} | {str(k): v for k, v in names.items() if isinstance(k, int)}
    if not table:
        return c.cast("string")
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c.cast("string")), c.cast("string"))


def compact(df: DataFrame) -> DataFrame:
    """Ids and prediction only."""
    return df.select("doc_id", *(["warc_record_id"] if "warc_record_id" in df.columns else []), "predicted_label")


def length_batches(rows: Iterator, batch: int, bucket: int, length=len) -> Iterator[list]:
    """Batches of like lengths. Rows are held until there are `bucket` of them; then the
    longest whole batches' worth of what is sorted goes out, shortest first, and what is
    left (less than a batch) waits with the next rows."""
    if bucket < batch:
        raise ValueError("a bucket must hold a batch")
    held: list = []

    def release(least: int) -> Iterator[list]:
        held.sort(key=length)
        at = 0
        while len(held) - at >= least:
            yield held[at : at + batch]
            at += batch
        del held[:at]

    for row in rows:
        held.append(row)
        if len(held) == bucket:
            yield from release(batch)
    yield from release(1)


def length_buckets(df: DataFrame, batch: int, bucket: int, by: str, length: str) -> DataFrame:
    """df with `batch`: rows in the order `by` fall into buckets, a bucket's rows are
    dealt in order of length. What length_batches does as rows pass, for a whole table;
    a bucket is whole batches, so none is left over."""
    if bucket < batch or bucket % batch:
        raise ValueError("a bucket must be whole batches")
    at = with_index(df, by, name="_at").withColumn("_bucket", F.floor(F.col("_at") / bucket))
    rank = F.row_number().over(W.partitionBy("_bucket").orderBy(length, "_at")) - 1  # within `bucket` rows
    return at.withColumn("batch", F.col("_bucket") * (bucket // batch) + F.floor(rank / batch)).drop("_at", "_bucket")
