"""Strict document sources: JSONL, Parquet, hub datasets, id aliases, shards, fingerprints.

Lines are read as text and parsed as variants, as the JSON reader would drop blank
lines and turn numbers into strings. What is wrong with a row is in the column
`problem` (null if nothing); `strict` raises at the first such row it meets, in the
executors.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import NumericType, StringType

from arborlex.functions.text import is_blank
from arborlex.operators.ordering import with_index
from arborlex.operators.storage import cut

ID_KEYS = ("doc_id", "id", "warc_record_id")


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """doc_id, text, extra (the whole object), problem. The first of doc_id, id and
    warc_record_id that is there is the id, even if it is null."""
    v = F.try_parse_json(F.col(line))
    kind = F.schema_of_variant(v)
    rows = lines.withColumn("_v", v).withColumn("_kind", kind)
    # a key is there if the object's schema names it, whatever its value
    has = lambda k: F.coalesce(F.col("_kind").rlike(rf"(?:^OBJECT<|, ){k}: "), F.lit(False))
    kind_of = lambda k: F.schema_of_variant(F.try_variant_get("_v", f"$.{k}", "variant"))
    value = lambda k: F.when(kind_of(k) == "STRING", F.try_variant_get("_v", f"$.{k}", "string"))
    doc_id = F.when(has("doc_id"), value("doc_id")).when(has("id"), value("id")).when(has("warc_record_id"), value("warc_record_id"))
    any_id = has("doc_id") | has("id") | has("warc_record_id")
    text = value("text")
    problem = (
        F.when(is_blank(line), "blank line")
        .when(F.col("_v").isNull(), "not JSON, or a key twice")
        .when(~F.col("_kind").startswith("OBJECT"), "not an object")
        .when(~any_id, "no doc_id, id or warc_record_id")
        .when(doc_id.isNull(), "the id is not a string")
        .when(is_blank(doc_id), "blank doc_id")
        .when(text.isNull(), "text is missing or not a string")
        .when(is_blank(text), "blank text")
    )
    keep = [c for c in lines.columns if c != line]
    return rows.select(*keep, doc_id.alias("doc_id"), text.alias("text"), F.col("_v").alias("extra"), problem.alias("problem"))


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One row a line, with the file it is from."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return parse_lines(lines)


def count_lines(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()


def with_aliased_id(df: DataFrame, keys: Iterable[str] = ID_KEYS) -> DataFrame:
    """doc_id from the first of the keys that is a column, as a string."""
    key = next((k for k in keys if k in df.columns), None)
    if key is None:
        raise ValueError(f"none of {', '.join(keys)} is a column")
    return df.withColumn("doc_id", F.col(key).cast("string"))


def checked(df: DataFrame) -> DataFrame:
    """Adds `problem` for blank ids and texts."""
    return df.withColumn("problem", F.when(is_blank("doc_id"), "blank doc_id").when(is_blank("text"), "blank text"))


def strict(df: DataFrame) -> DataFrame:
    """Raises where a row has a problem; gives the others without the column."""
    where: Column = F.coalesce(F.col("file"), F.lit("")) if "file" in df.columns else F.lit("")
    bad = F.raise_error(F.concat(where, F.lit(": "), "problem")).cast("string")
    return df.withColumn("doc_id", F.when(F.col("problem").isNotNull(), bad).otherwise(F.col("doc_id"))).drop("problem", "file", "block")


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows)."""
    return df.where("problem is null").drop("problem"), df.where("problem is not null")


def missing_fields(df: DataFrame) -> DataFrame:
    """Rows without text, or without doc_id and warc_record_id: what is missing."""
    has = lambda c: F.col(c).isNotNull() if c in df.columns else F.lit(False)
    missing = F.when(~has("text"), "text").when(~(has("doc_id") | has("warc_record_id")), "doc_id or warc_record_id")
    return df.withColumn("missing", missing).where("missing is not null")


def shard(df: DataFrame, rank: int, world: int, *by: str, skip: int = 0) -> DataFrame:
    """The rows whose place in the order `by` is rank modulo world, without the first
    `skip` of them; blank rows are to be taken out before."""
    if not 0 <= rank < world:
        raise ValueError("rank must be from 0 to world - 1")
    indexed = with_index(df, *by, name="_at")
    return indexed.where((F.col("_at") % world == rank) & (F.col("_at") >= skip * world)).drop("_at")


def fingerprint(spark: SparkSession, path: str) -> tuple[str, int, int]:
    """(path, bytes, modification time in ns): of a local file as the system gives
    it, else summed and latest over what Spark lists, in whole ms."""
    if os.path.isfile(path):
        s = os.stat(path)
        return os.path.abspath(path), s.st_size, s.st_mtime_ns
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length", "modificationTime")
    row = files.agg(F.sum("length").alias("n"), F.max(F.unix_millis("modificationTime")).alias("t")).first()
    return path, row.n or 0, (row.t or 0) * 1_000_000


def url_text(df: DataFrame, url: str = "url", text: str = "text") -> Column:
    return F.concat(F.coalesce(F.col(url), F.lit("")), F.lit("\n\n"), F.coalesce(F.col(text), F.lit("")))


def renamed(df: DataFrame) -> DataFrame:
    """doc_id and text of rows that have `document` for text."""
    return df.select("doc_id", F.col("document").alias("text"))


# ------------------------------------------------------------- hub datasets


class HubDataset(DataSource):
    """Rows of a dataset that a hub streams. Options: name (and config), split, shards
    (each is a partition), and loader, `module:function`, which takes name, config and
    split and gives rows as mappings; by default the datasets library's."""

    @classmethod
    def name(cls) -> str:
        return "hub_dataset"

    def schema(self) -> str:
        return "file string, at long, value string"

    def reader(self, schema) -> DataSourceReader:
        return _HubReader(dict(self.options))


class _HubReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(int(self.options.get("shards", 1)))]

    def read(self, partition: InputPartition) -> Iterable[tuple]:
        import importlib
        import json

        o = self.options
        module, _, function = o.get("loader", "datasets:load_dataset").partition(":")
        rows = getattr(importlib.import_module(module), function)(o["dataset"], name=o.get("config"), split=o.get("split", "train"), streaming=True)
        shards = int(o.get("shards", 1))
        if shards > 1:
            rows = rows.shard(num_shards=shards, index=partition.value)
        for at, row in enumerate(rows, 1):
            if not isinstance(row, dict):
                raise ValueError(f"{o['dataset']}: row {at} is no mapping")
            yield f"{o['dataset']}, shard {partition.value}, row {at}", at, json.dumps(row, ensure_ascii=False, default=str)


def read_hub(spark: SparkSession, dataset: str, config: str | None = None, split: str = "train", shards: int = 1, loader: str | None = None) -> DataFrame:
    """Rows of a hub's dataset, parsed and checked like lines."""
    spark.dataSource.register(HubDataset)
    options = {"dataset": dataset, "config": config, "split": split, "shards": str(shards), "loader": loader}
    rows = spark.read.format("hub_dataset").options(**{k: v for k, v in options.items() if v is not None}).load()
    return parse_lines(rows.select("value", "file"))


def read_input(spark: SparkSession, jsonl: str | None = None, parquet: str | None = None, dataset: str | None = None, **hub) -> DataFrame:
    """doc_id and text of exactly one source; raises where a row has a problem."""
    if sum(x is not None for x in (jsonl, parquet, dataset)) != 1:
        raise ValueError("give exactly one of JSONL files, Parquet files and a dataset")
    if jsonl is not None:
        rows = read_jsonl(spark, jsonl)
    elif dataset is not None:
        rows = read_hub(spark, dataset, **hub)
    else:
        rows = checked(with_aliased_id(spark.read.parquet(parquet)))
    return strict(rows).select("doc_id", "text")


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed records, one a line; raises with file and line of the first that is blank,
    not an object of these fields with these types, or has a null in one of them."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    fields = spark.createDataFrame([], schema).schema
    v = F.try_parse_json("value")
    kinds = F.schema_of_variant(v)
    r = F.from_json("value", fields, {"mode": "PERMISSIVE"})
    own = ", ".join(sorted(f.name for f in fields))
    names = F.array_join(F.array_sort(F.json_object_keys("value")), ", ")
    gap = [r[f.name].isNull() for f in fields]
    number = {f.name for f in fields if isinstance(f.dataType, NumericType)}
    kind = lambda f: F.schema_of_variant(F.try_variant_get(v, f"$.{f.name}", "variant"))
    wrong = [(kind(f) != "BIGINT") if f.name in number else kind(f) != "STRING" for f in fields if f.name in number or isinstance(f.dataType, StringType)]
    problem = (
        F.when(is_blank("value"), "blank line").when(v.isNull(), "not JSON, or a key twice").when(~kinds.startswith("OBJECT"), "not an object")
        .when(names != own, F.concat(F.lit("fields are "), names)).when(reduce(Column.__or__, [*gap, *wrong]), "a field is null or of another type")
    )
    rows = cut(lines.select("file", "at", r.alias("r"), problem.alias("problem")), "records")
    bad = rows.where("problem is not null").orderBy("file", "at").first()
    if bad is not None:
        line = lines.where((F.col("file") == bad.file) & (F.col("at") <= bad.at)).count()
        raise ValueError(f"{bad.file}:{line}: {bad.problem}")
    return rows.select("r.*")
