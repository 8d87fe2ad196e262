"""Exact Jaccard join of documents on word shingles (op9).

The document by shingle incidence matrix is multiplied with itself block by block,
a block being a range of shingles; only the entries that a link of 80 % or more
must touch take part, and pairs are dropped as soon as sizes or shared entries
rule them out. Every pair that stays is decided on the whole sets.

1. Documents with equal sets become one class (fingerprint and size).
2. Each class gives a prefix of its shingles in hash order: those of which linked
   sets must share one, and a reserve. Shingles are packed by block, each class
   once a batch, so copies cost nothing. A block keeps what two classes share.
3. Classes with too few shared entries for any partner are out.
4. Each class is checked against the most central class of its buckets (the one
   whose entries are shared most) that it shares most with; links found make
   components.
5. Only pairs across components are left. Classes that share enough listed entries
   with other components, and then 80 % of their whole sets, are put in order of how
   many pairs each shingle would make, rarest first; linked ones share one of the
   few that the prefix bound leaves. What sizes, places and bitmaps still allow is
   checked.
6. Components of all links found.

The order never changes the result; no pair is dropped but by a bound.

Defined results: null, empty and wordless texts have no set, n_shingles 0, and are
linked with nothing; texts of one to four words have one shingle, the sequence as
a whole; repeated rows are equal texts and linked; null ids never name a component
unless all its ids are null; an empty table gives an empty table; other columns are
kept by `one_of_each`. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlex.llm.common import block_count, by_block, chunks, cut, fits_broadcast, mix, narrow_join, slices, token_hashes, unused, windows
from arborlex.llm.components import components

WORDS = 5
RESERVE = 48
_FLUSH = 200_000
#: Entries of a block, of some 16 bytes each; and how many classes of one batch have to
#: list a shingle for it to be dealt by class.
BLOCK = 2_000_000
HOT = 64
_SHORT = np.uint64(0xD6E8FEB86659FD93)


# --------------------------------------------------------------------- sizes


def _needed(n):
    """Least size of the intersection for a set of n: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def _reserve(n, reserve: int):
    return max(reserve, (n - _needed(n) + 1) // 4)


def _listed(n, reserve: int):
    """How many of n shingles are listed: prefix and reserve."""
    return min(n, n - _needed(n) + 1 + _reserve(n, reserve))


# ---------------------------------------------------------------------- sets


def shingle_sets(texts: list) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; empty without words."""
    for a, b in chunks(texts):
        tokens, first = token_hashes(texts[a:b])
        for i in range(b - a):
            own = tokens[first[i] : first[i + 1]]
            if len(own) >= WORDS:
                yield np.unique(windows(own, WORDS))
            elif len(own):
                yield windows(own, len(own)) ^ np.uint64(int(_SHORT) * len(own) & (1 << 64) - 1)
            else:
                yield np.zeros(0, np.uint64)


def fingerprint(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = mix(s ^ _SHORT).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(mix(np.array([total]))[0].astype(np.int64))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [(fingerprint(s), len(s)) for s in shingle_sets(slices(batch.column("text")))]
        yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array([f for f, _ in sets], pa.int64()), pa.array([n for _, n in sets], pa.int64())], ["uid", "fp", "n"])


def document_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, n of every row."""
    rows = docs.select(F.col(key).cast("string").alias("uid"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(_classes, "uid string, fp long, n long").select(F.col("uid").cast(kind).alias("doc_id"), "fp", "n")


# -------------------------------------------------------------------- blocks


def _packer(blocks: int, reserve: int, most: int):
    """From texts (column text), or from sets (fp, s)."""

    def sets_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        if "s" in batch.schema.names:
            for f, x in zip(batch.column("fp").to_pylist(), slices(batch.column("s")), strict=True):
                yield f, np.frombuffer(x, np.uint64)
        else:
            for s in shingle_sets(slices(batch.column("text"))):
                yield (fingerprint(s) if len(s) else 0), s

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, meta, seen, size = [], [], set(), 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(x) for x in lists])
            h, of = np.concatenate(lists), np.repeat(np.arange(len(lists)), lengths)
            block = (h % np.uint64(blocks)).astype(np.int64)
            # what so many classes list is shared, whoever else lists it: dealt by class.
            # Two of them go the usual way, too, so that a single one elsewhere is met
            _, at, held = np.unique(h, return_inverse=True, return_counts=True)
            hot = np.flatnonzero(held[at] > most)
            if len(hot):
                by = hot[np.lexsort((of[hot], at[hot]))]
                starts = np.flatnonzero(np.concatenate([[True], at[by][1:] != at[by][:-1]]))
                two = np.concatenate([by[starts], by[starts + 1]])
                usual = np.ones(len(h), bool)
                usual[hot] = False
                usual[two] = True
                salted = blocks + (mix(np.array([m[0] for m in meta], np.int64).view(np.uint64))[of[hot]] % np.uint64(blocks)).astype(np.int64)
                h, of, block = np.concatenate([h[usual], h[hot]]), np.concatenate([of[usual], of[hot]]), np.concatenate([block[usual], salted])
            order = np.lexsort((of, block))
            h, of, block = h[order], of[order], block[order]
            fp, n = np.array([m[0] for m in meta], np.int64), np.array([m[1] for m in meta], np.int32)
            cut_at = np.flatnonzero(np.diff(block)) + 1
            rows = []
            for x, y, k in zip(np.split(h, cut_at), np.split(of, cut_at), block[np.concatenate([[0], cut_at])], strict=True):
                who, count = np.unique(y, return_counts=True)
                rows.append((int(k), np.int64(len(who)).tobytes() + fp[who].tobytes() + n[who].tobytes() + count.astype(np.int32).tobytes() + x.tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["block", "data"])

        for batch in batches:
            for f, s in sets_of(batch):
                if not len(s) or f in seen:
                    continue
                seen.add(f)
                lists.append(s[: int(_listed(len(s), reserve))].copy())
                meta.append((f, len(s)))
                size += len(lists[-1])
                if size >= _FLUSH:
                    yield flush()
                    lists, meta, seen, size = [], [], set(), 0
        if lists:
            yield flush()

    return pack


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = int(np.frombuffer(data, np.int64, 1)[0])
    fp = np.frombuffer(data, np.int64, k, 8)
    n = np.frombuffer(data, np.int32, k, 8 + 8 * k)
    count = np.frombuffer(data, np.int32, k, 8 + 12 * k)
    h = np.frombuffer(data, np.uint64, -1, 8 + 16 * k)
    return h, np.repeat(fp, count), np.repeat(n, count)


def _shared(parts: list[bytes], hot: bool) -> pd.DataFrame:
    """Entries of a block whose shingle two or more classes list: of a hot one, all."""
    h, fp, n = (np.concatenate(x) for x in zip(*map(_unpack, parts), strict=True))
    order = np.lexsort((fp, h))
    h, fp, n = h[order], fp[order], n[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (fp[1:] != fp[:-1])])
    h, fp, n = h[new], fp[new], n[new]
    same = h[1:] == h[:-1]
    keep = np.concatenate([[False], same]) | np.concatenate([same, [False]]) | hot
    return pd.DataFrame({"h": h[keep].astype(np.int64), "fp": fp[keep], "n": n[keep].astype(np.int64)})


def _multiply(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, parts in by_block(batches):
            yield pa.RecordBatch.from_pandas(_shared(parts, block >= blocks), preserve_index=False)

    return run


def shared_entries(source: DataFrame, reserve: int = RESERVE, entries: int = 0, hot: int = HOT) -> DataFrame:
    """h, fp, n: listed shingles that more than one class lists (those of hot shingles
    may come twice, which no bound minds: they ask for a least number of them). source: text, or fp
    and s (the whole set); entries: how many are listed, for the size of blocks."""
    blocks = block_count(source.sparkSession, entries, BLOCK)
    packed = source.mapInArrow(_packer(blocks, reserve, hot), "block int, data binary")
    dealt = packed.repartition(blocks, "block").sortWithinPartitions("block")
    return dealt.mapInArrow(_multiply(blocks), "h long, fp long, n long")


# ------------------------------------------------------------------ checking


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = slices(batch.column("text"))
        for a, b in chunks(texts):
            sets = [s for s in shingle_sets(texts[a:b]) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["fp", "n", "s"])


def class_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """fp, s (the whole set) of the wanted classes, from one document of each."""
    one = classes.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.min("doc_id").alias("_one"))
    ids = cut(one.select("_one").distinct(), "ids")
    side = F.broadcast(ids) if fits_broadcast(ids) else ids
    rows = docs.join(side, docs[key].eqNullSafe(side["_one"]), "left_semi").select(F.col(text).alias("text"))
    sets = rows.mapInArrow(_with_sets, "fp long, n long, s binary")
    return sets.dropDuplicates(["fp"]).join(wanted, "fp", "left_semi")


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for x, y in zip(slices(batch.column("s")), slices(batch.column("t")), strict=True):
            both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            linked.append(100 * shared >= 80 * (len(both) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def links_among(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of classes that are linked, on their whole sets."""
    named = cut(pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct(), "named")
    sets = narrow_join(sets, named, "fp", "left_semi")
    left = pairs.join(sets.select(F.col("fp").alias("a"), "s"), "a")
    both = left.join(sets.select(F.col("fp").alias("b"), F.col("s").alias("t")), "b")
    return both.select("a", "b", "s", "t").mapInArrow(_decide, "a long, b long")


# ---------------------------------------------------------------------- join


def _size_ok(a: str, b: str):
    return (5 * F.col(a) >= 4 * F.col(b)) & (5 * F.col(b) >= 4 * F.col(a))


def _sql_needed(n: str) -> str:
    return f"(4 * {n} + 4) div 5"


def _sql_reserve(n: str, reserve: int) -> str:
    return f"greatest({reserve}, ({n} - {_sql_needed(n)} + 1) div 4)"


def _sql_listed(n: str, reserve: int) -> str:
    return f"least({n}, {n} - {_sql_needed(n)} + 1 + {_sql_reserve(n, reserve)})"


def _fewest(reserve: int) -> str:
    """SQL: shared listed entries that a class of n has with any that it is linked with."""
    least_size = _sql_needed("n")
    return f"least({least_size}, 1 + {_sql_reserve(f'({least_size})', reserve)})"


def _grouped_packer(blocks: int):
    """Whole sets (fp, g, s) by block of shingles."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, gs = batch.column("fp").to_numpy(), batch.column("g").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in slices(batch.column("s"))]
            n = np.array([len(x) for x in sets], np.int32)
            begin = size = 0
            for i, x in enumerate(sets):
                size += len(x)
                if size >= _FLUSH or i + 1 == len(sets):
                    own = slice(begin, i + 1)
                    h, of = np.concatenate(sets[own]), np.repeat(np.arange(begin, i + 1), n[own])
                    yield _blobs((h % np.uint64(blocks)).astype(np.int64), (h, fps[of], gs[of], n[of]))
                    begin, size = i + 1, 0

    return pack


def _blobs(key: np.ndarray, columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    """One row for each key with the columns' values packed one after the other."""
    order = np.argsort(key, kind="stable")
    key, columns = key[order], [c[order] for c in columns]
    cut_at = np.flatnonzero(np.diff(key)) + 1
    first = np.concatenate([[0], cut_at]) if len(key) else np.zeros(0, np.int64)
    parts = zip(*(np.split(c, cut_at) for c in columns), strict=True)
    data = [b"".join([np.int64(len(p[0])).tobytes(), *(c.tobytes() for c in p)]) for p in parts] if len(key) else []
    return pa.RecordBatch.from_arrays([pa.array(key[first], pa.int32()), pa.array(data, pa.binary())], ["block", "data"])


def _unblob(parts: list[bytes], kinds: tuple) -> list[np.ndarray]:
    out: list[list[np.ndarray]] = [[] for _ in kinds]
    for data in parts:
        n, at = int(np.frombuffer(data, np.int64, 1)[0]), 8
        for k, kind in enumerate(kinds):
            out[k].append(np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(c) for c in out]


_ENTRY = (np.uint64, np.int64, np.int64, np.int32)


def _mixed(outs: int):
    """Of each block, entries whose shingle more than one group has, with the number
    of (ordered) pairs across groups that it would make; by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in by_block(batches):
            h, fp, g, n = _unblob(parts, _ENTRY)
            order = np.lexsort((fp, g, h))
            h, fp, g, n = h[order], fp[order], g[order], n[order]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (fp[1:] != fp[:-1])])
            h, fp, g, n = h[new], fp[new], g[new], n[new]
            starts = np.concatenate([[True], h[1:] != h[:-1]])
            shingle = np.cumsum(starts) - 1
            group = np.cumsum(starts | np.concatenate([[True], g[1:] != g[:-1]])) - 1
            size = np.bincount(group)
            square = np.bincount(shingle[np.concatenate([[True], group[1:] != group[:-1]])], weights=size.astype(float) ** 2)
            w = np.bincount(shingle).astype(float) ** 2 - square
            keep = w[shingle] > 0
            if keep.any():
                yield _blobs(fp[keep] % outs, (h[keep], fp[keep], g[keep], n[keep], w[shingle][keep]))

    return run


#: 64-bit words of a class's bitmap: a shingle of one class whose bit another lacks is
#: not in the other, which bounds what the two can share.
_WORDS = 16
_PREFIX = ["h", "fp", "n", "g", "m", "i", *(f"b{k}" for k in range(_WORDS))]


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each class with 80 % of its set in such entries, the rarest of them: what a
    linked class must share one of. What only one group has comes before all and
    matches nothing."""
    for _, parts in by_block(batches):
        h, fp, g, n, w = _unblob(parts, (*_ENTRY, np.float64))
        order = np.lexsort((h, w, fp))
        h, fp, g, n = h[order], fp[order], g[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
        m = np.diff(np.concatenate([first, [len(fp)]]))
        i = np.arange(len(fp)) - np.repeat(first, m) + 1
        m = np.repeat(m, m)
        who = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(fp)]])))
        bits = np.zeros((len(first), _WORDS), np.uint64)
        at = h % np.uint64(64 * _WORDS)
        np.bitwise_or.at(bits, (who, (at >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (at & np.uint64(63)))
        keep = (m >= _needed(n)) & (i <= m - _needed(n) + 1)
        columns = [x[keep].astype(np.int64) for x in (h.view(np.int64), fp, n, g, m, i)] + [bits[who[keep], k].view(np.int64) for k in range(_WORDS)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _PREFIX)


def across(entries: DataFrame, sets: DataFrame, groups: DataFrame, reserve: int) -> DataFrame:
    """Links (a, b) between classes of different groups, all of them."""
    named = cut(narrow_join(entries, groups, "fp", "left").select("h", "fp", "n", F.coalesce("g", "fp").alias("g")), "named")
    # a class that shares too few listed entries with other groups has no link to them
    several = cut(named.groupBy("h").agg(F.min("g").alias("a"), F.max("g").alias("b")).where("a < b").select("h"), "several")
    open_ = named.join(several, "h", "left_semi").groupBy("fp", "n", "g").agg(F.count(F.lit(1)).alias("m")).where(f"m >= {_fewest(reserve)}").select("fp", "g", "n")
    # of the others, whole sets
    open_ = cut(open_, "open")
    parts = block_count(sets.sparkSession, open_.agg(F.sum("n")).first()[0] or 0, BLOCK)
    whole = narrow_join(sets.select("fp", "s"), open_.select("fp", "g"), "fp").select("fp", "g", "s")
    dealt = lambda df: df.repartition(parts, "block").sortWithinPartitions("block")
    mixed = dealt(whole.mapInArrow(_grouped_packer(parts), "block int, data binary")).mapInArrow(_mixed(parts), "block int, data binary")
    rows = cut(dealt(mixed).mapInArrow(_prefixes, ", ".join(f"{c} long" for c in _PREFIX)), "prefix")
    side = lambda k: rows.select("h", *(F.col(c).alias(f"{k}_{c}") for c in _PREFIX[1:]))
    pairs = side("x").join(side("y"), "h").where((F.col("x_fp") < F.col("y_fp")) & (F.col("x_g") != F.col("y_g")) & _size_ok("x_n", "y_n"))
    # matches so far and those that may follow must reach 4/9 of both sizes
    overlap = "(4 * (x_n + y_n) + 8) div 9"
    pairs = pairs.where(f"least(x_i, y_i) + least(x_m - x_i, y_m - y_i) >= {overlap}")
    for a, b in (("x", "y"), ("y", "x")):
        lacking = " + ".join(f"bit_count({a}_b{k} & ~{b}_b{k})" for k in range(_WORDS))
        pairs = pairs.where(f"{a}_m - ({lacking}) >= {overlap}")
    rest = cut(pairs.select(F.col("x_fp").alias("a"), F.col("y_fp").alias("b")).distinct(), "pairs")
    return cut(links_among(rest, sets), "links")


def class_links(docs: DataFrame, classes: DataFrame, reserve: int = RESERVE, hot: int = HOT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Links (a, b) between classes: enough of them to give all components."""
    listed = classes.where("n > 0").agg(F.sum(F.expr(_sql_listed("n", reserve)))).first()[0] or 0
    entries = cut(shared_entries(docs.select(F.col(text).alias("text")), reserve, listed, hot), "entries")
    able = cut(entries.groupBy("fp", "n").agg(F.count(F.lit(1)).alias("c")).where(f"c >= {_fewest(reserve)}").select("fp"), "able")
    entries = cut(narrow_join(entries, able, "fp", "left_semi"), "entries")

    # each class against the most central one of its buckets: the one whose entries
    # are shared most (an original, rather than one of its copies). Tables by shingle
    # grow with the corpus: they are joined by shuffling, at every size.
    spread = cut(entries.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "spread")
    central = entries.join(spread, "h").groupBy("fp").agg((F.sum("c") / F.max(F.expr(_sql_listed("n", reserve)))).alias("v"))
    ranked = narrow_join(entries, cut(central, "central"), "fp")
    pivots = cut(ranked.groupBy("h").agg(F.max(F.struct("v", "fp", "n")).alias("p"), F.count(F.lit(1)).alias("c")).where("c > 1").select("h", F.col("p.fp").alias("b"), F.col("p.n").alias("bn")), "pivots")
    star = entries.join(pivots, "h").where((F.col("fp") != F.col("b")) & _size_ok("n", "bn"))
    star = star.groupBy("fp", "b").agg(F.count(F.lit(1)).alias("c")).groupBy("fp").agg(F.max_by("b", F.struct("c", -F.col("b"))).alias("b"))
    star = cut(star.select(F.col("fp").alias("a"), "b"), "star")
    sets = cut(class_sets(docs, classes, able, key, text), "sets")
    links = cut(links_among(star, sets), "links")
    groups = cut(components(links).withColumnsRenamed({"node": "fp", "component": "g"}), "groups")
    return links.union(across(entries, sets, groups, reserve))


def similar_components(docs: DataFrame, reserve: int = RESERVE, hot: int = HOT, key: str = "doc_id", text: str = "text", with_class: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row (and its class, fp)."""
    classes = cut(document_classes(docs, key, text), "classes")
    groups = cut(components(class_links(docs, classes, reserve, hot, key, text)), "groups").withColumnsRenamed({"node": "fp", "component": "g"})
    named = cut(narrow_join(classes, groups, "fp", "left").withColumn("g", F.coalesce("g", "fp")), "documents")
    first = named.where("n > 0").groupBy("g").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").select("g", "first", F.lit(True).alias("some"))
    out = narrow_join(named, cut(first, "first"), "g", "left")
    alone = F.col("some").isNull() | (F.col("n") == 0)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("first")).alias("component_id"), *(["fp"] if with_class else []))


def class_column(text: str = "text"):
    """A column with the class fingerprint of each row's text."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(s) for s in shingle_sets(texts.tolist())], dtype="int64")

    return fp(F.col(text))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component stays: the one that names it. Of rows that
    repeat both its id and its class, one stays."""
    found = cut(similar_components(docs, key=key, text=text, with_class=True, **options), "found")
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    by_id = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"), F.max(own).alias("stays"))
    id_, fp, class_ = unused(docs.columns, "_id", "_fp", "_class")
    gone = cut(by_id.where("not stays or c > 1").select(F.col("doc_id").alias(id_), (F.col("c") > 1).alias("again")), "gone")
    same = F.col(f"`{key}`").eqNullSafe(F.col(id_))
    kept = narrow_join(docs, gone.select(id_), same, "left_anti")
    again = gone.where("again").select(id_)
    if again.isEmpty():
        return kept
    stay = found.where(own).select(F.col("doc_id").alias(id_), F.col("fp").alias(fp)).join(again.select(F.col(id_).alias("_i")), F.col(id_).eqNullSafe(F.col("_i")), "left_semi").distinct()
    rows = narrow_join(docs, again, same, "left_semi").withColumn(class_, class_column(text))
    rows = narrow_join(rows, cut(stay, "stay"), same & (F.col(class_) == F.col(fp)), "left_semi")
    return kept.unionByName(rows.dropDuplicates([key, class_]).drop(class_))
