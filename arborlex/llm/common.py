"""Helpers shared by the training-data operators: global order with prefix sums and a
vectorised tokenizer; tables that cut lineage and counted broadcasts come from the
library."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlex.operators.storage import BROADCAST_ROWS, cut, fits_broadcast, narrow_join, new_path, shared_dir

__all__ = [
    "BROADCAST_ROWS", "WORD", "block_count", "by_block", "chunks", "cut", "dealt", "fits_broadcast", "global_order", "mix", "narrow_join", "new_path", "numbered", "numbered_copies",
    "pack", "renamed", "shared_dir", "slices", "token_hashes", "union_all", "unpack", "unused", "windows",
]

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def global_order(df: DataFrame, by: list, sums: dict[str, str], tag: str = "order") -> DataFrame:
    """df with `_row` (0-based place in the order `by`) and, for each name -> column
    of sums, the sum over all rows before this one, and as `<name>_all` over all rows.

    Range partitions keep the order; each one's totals are added up over the few
    partitions, then every partition adds its own running sums. The ranges are
    written out first, so both uses see the same ones."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id()), tag)
    totals = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), *(F.sum(c).alias(f"_t_{k}") for k, c in sums.items()))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"), *(F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_t_{k}") for k in sums), *(F.sum(f"_t_{k}").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias(f"{k}_all") for k in sums))
    own = W.partitionBy("_part").orderBy(*by)
    prior = own.rowsBetween(W.unboundedPreceding, -1)
    run = ranged.withColumns({"_r": F.row_number().over(own).cast("long") - 1} | {f"_s_{k}": F.coalesce(F.sum(c).over(prior), F.lit(0)) for k, c in sums.items()})
    # one row for each partition: as many as spark.sql.shuffle.partitions at most
    out = run.join(F.broadcast(offsets), "_part")
    return out.withColumns({"_row": F.col("_n") + F.col("_r")} | {k: F.col(f"_t_{k}") + F.col(f"_s_{k}") for k in sums}).drop("_part", "_n", "_r", *(f"_t_{k}" for k in sums), *(f"_s_{k}" for k in sums))


def numbered_copies(rows: DataFrame, key: str, name: str, most: int = 4096) -> DataFrame:
    """rows with `name`: 1, 2, ... among those of equal key (a struct, which may hold
    nulls). Groups of more than `most` rows are parted at random, written, and numbered
    part by part, so that none is in one place."""
    of = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy(F.lit(0)))
    hot_key, hot_n, part, before = unused(rows.columns, "_hot", "_n", "_part", "_before")
    hot = cut(rows.groupBy(F.col(key).alias(hot_key)).agg(F.count(F.lit(1)).alias(hot_n)).where(F.col(hot_n) > most), "hot")
    if hot.isEmpty():
        return rows.withColumn(name, of(key))
    same = F.col(key).eqNullSafe(F.col(hot_key))
    usual = narrow_join(rows, hot, same, "left_anti").withColumn(name, of(key))
    dealt_out = F.floor(F.rand(5) * F.ceil(F.col(hot_n) / most)).cast("int")
    some = cut(narrow_join(rows, hot, same).withColumn(part, dealt_out).drop(hot_key, hot_n), "parts")
    sizes = some.groupBy(F.col(key).alias(hot_key), F.col(part).alias(hot_n)).agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy(hot_key).orderBy(hot_n).rowsBetween(W.unboundedPreceding, -1)
    sizes = cut(sizes.withColumn(before, F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"), "sizes")
    joined = narrow_join(some, sizes, same & (F.col(part) == F.col(hot_n)))
    return usual.unionByName(joined.withColumn(name, (F.col(before) + of(key, part)).cast("int")).select(*rows.columns, name))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------------- tokenizer

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: xor-shifts and odd multiplications."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * _MIX1
        h = (h ^ (h >> np.uint64(27))) * _MIX2
        return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** j and its inverse's powers, for j < n, modulo 2 ** 64."""
    global _POW
    if len(_POW[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _POW = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b)])) for b in (_BASE, inverse))
    return _POW


_POW = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def token_hashes(texts: list, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, one after the other, and where each
    text's words begin (one entry more than texts). None counts as no text.

    Words are found and hashed on the UTF-8 bytes as a whole: a word's hash is a
    polynomial of its bytes, from differences of running sums. Texts may be strings
    or UTF-8 bytes of any kind."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    ends_of_text = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64) if raw else np.zeros(0, np.int64)
    n = len(data)
    if lower:
        data = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    word = np.concatenate([[False], ~gap, [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, stop = edge[0::2], edge[1::2]
    up, down = _powers(n + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n])])
        h = (total[stop] - total[start]) * down[start]
    first = np.concatenate([[0], np.searchsorted(start, ends_of_text)]).astype(np.int64)
    return mix(h), first


def windows(tokens: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word windows of one run of word hashes, in order."""
    if len(tokens) < k:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = tokens[: len(tokens) - k + 1].copy()
        for i in range(1, k):
            h = h * _BASE + tokens[i : len(tokens) - k + 1 + i]
    return mix(h)


def slices(column) -> list[memoryview]:
    """The bytes of each value of an Arrow string or binary column, without copying;
    no bytes for nulls."""
    wide = np.int64 if str(column.type).startswith("large") else np.int32
    _, offsets, data = column.buffers()
    if data is None:
        return [memoryview(b"")] * len(column)
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].tolist()
    view = memoryview(data)
    return [view[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


# --------------------------------------------------------------- packed tables


def pack(columns: list[np.ndarray], widths: list[int]) -> bytes:
    """Integer columns in so many low bytes a value, byte by byte: equal high bytes
    lie side by side and vanish when compressed."""
    n = len(columns[0])
    parts = [c.astype("<i8").view(np.uint8).reshape(n, 8)[:, :w].T.tobytes() for c, w in zip(columns, widths, strict=True)]
    return b"".join([np.int64(n).tobytes(), *parts])


def unpack(parts: list, widths: list[int]) -> list[np.ndarray]:
    """The columns of all parts, as 64-bit integers (of fewer bytes: not negative)."""
    sizes = [int(np.frombuffer(p, "<i8", 1)[0]) for p in parts]
    out = []
    for k, w in enumerate(widths):
        column = np.zeros((sum(sizes), 8), np.uint8)
        row = 0
        for p, n in zip(parts, sizes, strict=True):
            column[row : row + n, :w] = np.frombuffer(p, np.uint8, n * w, 8 + n * sum(widths[:k])).reshape(w, n).T
            row += n
        out.append(column.view("<i8")[:, 0])
    return out


def dealt(key: np.ndarray, columns: list[np.ndarray], widths: list[int]) -> tuple[np.ndarray, list[bytes]]:
    """(keys, packed columns of each key), rows of a key in the order they came."""
    order = np.argsort(key, kind="stable")
    key, columns = key[order], [c[order] for c in columns]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]) if len(key) else np.zeros(1, np.int64)
    return key[edges[:-1]], [pack([c[a:b] for c in columns], widths) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def by_block(batches, key: str = "block", data: str = "data"):
    """(block, its packed data) from Arrow batches sorted by block."""
    at, parts = None, []
    for batch in batches:
        for block, part in zip(batch.column(key).to_pylist(), batch.column(data).to_pylist(), strict=True):
            if block != at and parts:
                yield at, parts
                parts = []
            at = block
            parts.append(part)
    if parts:
        yield at, parts


def block_count(spark, entries: int, each: int = 1_500_000) -> int:
    """Blocks of about `each` entries, and as many as there are shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // each))


# --------------------------------------------------------------- names and keys


def unused(taken, *names: str) -> list[str]:
    """Column names like these that `taken` doesn't hold, whatever the letters' case."""
    have = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out


def numbered(docs: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """(_n, the key as a whole number, and all columns; the names of the numbers).
    Numeric keys are their own numbers; of other keys, the place in their order."""
    n = unused(docs.columns, "_n")[0]
    if docs.schema[key].dataType.typeName() in ("byte", "short", "integer", "long"):
        return docs.withColumn(n, F.col(key).cast("long")), None
    names = cut(global_order(docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_name")).distinct(), [F.col("_name")], {}, "names"), "names")
    both = narrow_join(docs, names.select("_name", F.col("_row").alias(n)), docs[key] == F.col("_name"), "left")
    return both.select(*docs.columns, n), names


def renamed(out: DataFrame, names: DataFrame | None, *columns: str) -> DataFrame:
    """out with the numbers in these columns turned back into keys."""
    if names is None:
        return out
    for c in columns:
        key = names.select(F.col("_row").alias("_to"), F.col("_name").alias("_key"))
        rest = [F.col("_key").alias(c) if k == c else F.col(k) for k in out.columns]
        out = narrow_join(out, key, out[c] == key["_to"], "left").select(*rest)
    return out


def chunks(texts: list, chars: int = 300_000):
    """(from, to) ranges over texts with about so many characters each, so that the
    tokenizer's arrays stay small however the rows come in."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
