"""Tables in the folder that driver and executors share, which cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, NumericType, StringType, StructField, StructType

#: Rows and bytes of a narrow side up to which it is broadcast; beyond either, the join
#: shuffles.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; set here only where unset, in local mode."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="arborlex-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def cut(df: DataFrame, tag: str = "cut") -> DataFrame:
    """Write df to the shared folder and read it back."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bytes(field: StructField) -> Column:
    """The bytes of a row's value: counted where they vary."""
    kind, c = field.dataType, F.col(f"`{field.name}`")
    if isinstance(kind, (StringType, BinaryType)):
        return 8 + F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, NumericType):
        return 8 + 8 * F.greatest(F.size(c), F.lit(0))
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return 8 + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return F.lit(8)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether df has at most `limit` rows and `size` bytes, counted (no more than
    limit + 1 rows of them)."""
    total = reduce(Column.__add__, map(_bytes, df.schema.fields))
    row = df.limit(limit + 1).select(total.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).first()
    return row.n <= limit and (row.b or 0) <= size


def narrow_join(big: DataFrame, small: DataFrame, on, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a narrow side: broadcast when counted small, else shuffled."""
    return big.join(F.broadcast(small) if fits_broadcast(small, limit) else small, on, how)


# ------------------------------------------------- small files in any file system


def _store(path: str | Path):
    """(file system, path) of Hadoop, or None and a local path: where Spark writes, too.
    Without a session paths are local."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return None, Path(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getScheme() == "file":
        return None, Path(jpath.toUri().getPath())
    return fs, jpath


def exists(path: str | Path) -> bool:
    fs, own = _store(path)
    return own.exists() if fs is None else fs.exists(own)


def child_names(folder: str | Path) -> list[str]:
    """Names in a folder; none where there is no folder."""
    fs, own = _store(folder)
    if fs is None:
        return sorted(p.name for p in own.iterdir()) if own.is_dir() else []
    return sorted(s.getPath().getName() for s in fs.listStatus(own)) if fs.exists(own) else []


def read_text(path: str | Path) -> str:
    fs, own = _store(path)
    if fs is None:
        return own.read_text(encoding="utf-8")
    stream = fs.open(own)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(path: str | Path, text: str) -> None:
    """Write beside the target, then put it in its place at once."""
    fs, own = _store(path)
    if fs is None:
        own.parent.mkdir(parents=True, exist_ok=True)
        beside = own.with_name(own.name + ".new")
        with beside.open("w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(beside, own)
        return
    spark = SparkSession.getActiveSession()
    hadoop = spark._jvm.org.apache.hadoop.fs
    beside = hadoop.Path(own.getParent(), own.getName() + ".new")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(own.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, own, how)


def remove(path: str | Path) -> None:
    """A file or folder with all in it, if it is there."""
    fs, own = _store(path)
    if fs is not None:
        fs.delete(own, True)
    elif own.is_dir():
        shutil.rmtree(own)
    else:
        own.unlink(missing_ok=True)
