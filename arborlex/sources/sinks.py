"""Sinks: epoch directories for logs, JSONL, CSV, sidecar metadata, shard checks."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from arborlex.operators.storage import child_names, exists, read_text, write_text


def append_epoch(log: DataFrame, folder: str, epoch: int) -> None:
    """One directory for each epoch: written again, it replaces itself."""
    log.write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")


def epochs(folder: str) -> list[int]:
    """Those written to the end, in whatever file system the folder is."""
    found = (n for n in child_names(folder) if n.startswith("epoch="))
    return sorted(int(n[6:]) for n in found if exists(f"{folder}/{n}/_SUCCESS"))


def read_log(spark: SparkSession, folder: str, schema: str, after: int | None = None, only: list[int] | None = None) -> DataFrame:
    """All finished epochs (those after `after`, or in `only`: the others aren't touched)."""
    paths = [f"{folder}/epoch={e}" for e in (epochs(folder) if only is None else only) if after is None or e > after]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def ensure_metadata(path: str | Path, expected: dict, ignore: tuple[str, ...] = ("created_at_unix",)) -> None:
    """Create the sidecar, or require that it says the same."""
    if not exists(path):
        write_text(path, json.dumps(expected, ensure_ascii=False, sort_keys=True, indent=2))
        return
    found = json.loads(read_text(path))
    differing = sorted(k for k in {*found, *expected} - {*ignore} if found.get(k) != expected.get(k))
    if differing:
        raise ValueError(f"{path} is from another run: {', '.join(differing)} differ")


def reconcile(shards: list[DataFrame]) -> DataFrame:
    """All shards as one; raises if rows were lost on the way."""
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s)
    counts = sum(s.count() for s in shards)
    if out.count() != counts:
        raise ValueError("the shards' rows don't add up")
    return out
