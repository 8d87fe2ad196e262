"""Benchmark decontamination with spaced seeds (op2).

Each fixed mask looks at some positions of a window of words and ignores the rest,
so a seed survives substitutions at the ignored ones. All windows of all documents
and items are hashed under every mask and joined on the hash. A hit gives a
diagonal (document position minus item position); on each diagonal the item is laid
over the document word by word and the stretch with the most matching words is
found, among those with at most one substitution to PENALTY matches. A document is
contaminated by an item when that stretch has MATCHED matching words, or 80 % of a
shorter item's.

DataFrame functions only. Items are counted: few enough window hashes are
broadcast, more are met by a shuffled join. The texts of documents without a hit
are read once and go nowhere; one with hits is cut to a slice for each diagonal, and
sent once for every CROWD of them.

Words are runs of letters, digits, marks and underscores, in lower case; seeds see
them as 64-bit hashes, overlaps as text. Defined results: null and
empty texts and items hold no words; items under SHORTEST words take no part, or with
`short_items` count where all their words stand in a row (one or two words: where they
are the whole document); items with the same words count as the one with the smallest
id; repeated rows give one row; null ids are kept apart from others and match each
other; empty tables give no rows; other columns are kept by `drop_contaminated`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborlex.llm.common import cut, fits_broadcast, narrow_join, unused

MASKS = ("111111", "1110111", "11011011", "11100111")
SHORTEST = 6
MATCHED = 13
PENALTY = 3
#: Diagonals of a document that are looked at with one copy of its text.
CROWD = 4096
_SPLIT = r"(?U)\W+"


def words(text: str) -> Column:
    """The words of a text."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _SPLIT), "")


def hashed(w: Column) -> Column:
    """Words as numbers: rows of numbers are far cheaper to take apart than strings."""
    return F.transform(w, lambda x: F.xxhash64(x))


def seed_hashes(df: DataFrame, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """at, h0, h1, ... for every window start of the column `w`: null where a mask's
    window runs over the end. Neighbours are laid side by side before the array is
    taken apart, so that no row carries it whole."""
    span = max(map(len, masks))
    # a mask's own number is hashed with its words
    padded = F.arrays_zip(F.col("w").alias("c0"), *(F.slice("w", i + 1, F.size("w")).alias(f"c{i}") for i in range(1, span)))
    keep = [c for c in df.columns if c != "w"]
    rows = df.where(F.size("w") >= min(map(len, masks))).select(*keep, padded.alias("z"))
    rows = rows.select(*keep, F.posexplode("z").alias("at", "z"))

    def one(k: int, mask: str) -> Column:
        seen = [F.col(f"z.c{i}") for i, bit in enumerate(mask) if bit == "1"]
        return F.when(F.col(f"z.c{len(mask) - 1}").isNotNull(), F.xxhash64(F.lit(k), *seen))

    return rows.select(*keep, "at", *(one(k, m).alias(f"h{k}") for k, m in enumerate(masks)))


def _long(rows: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    keep = [c for c in rows.columns if c not in {f"h{k}" for k in range(len(masks))}]
    return rows.select(*keep, F.explode(F.array(*(f"h{k}" for k in range(len(masks))))).alias("h")).where("h is not null")


def hits(docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """Distinct (doc, item, n, diagonal) where some mask's hash agrees. docs: doc, w;
    items: item, n (words), w (words, or their hashes). A mask shorter than SHORTEST is
    for items of just its length, the others for longer ones."""
    hashes = seed_hashes(items, masks)
    for k, m in enumerate(masks):
        own = F.col("n") == len(m) if len(m) < SHORTEST else F.col("n") >= SHORTEST
        hashes = hashes.withColumn(f"h{k}", F.when(own, F.col(f"h{k}")))
    seeds = cut(_long(hashes, masks).select("h", "item", "n", F.col("at").alias("item_at")).distinct(), "seeds")
    rows = seed_hashes(docs, masks)
    if fits_broadcast(seeds):
        # first whether any mask hits at all, without taking the hashes apart
        keys = seeds.select("h").distinct()
        marks = []
        for k in range(len(masks)):
            own = F.broadcast(keys.select(F.col("h").alias(f"k{k}")))
            rows = rows.join(own, F.col(f"h{k}") == F.col(f"k{k}"), "left")
            marks.append(F.col(f"k{k}").isNotNull())
        rows = rows.where(reduce(Column.__or__, marks)).drop(*(f"k{k}" for k in range(len(masks))))
        found = _long(rows, masks).join(F.broadcast(seeds), "h")
    else:
        found = _long(rows, masks).join(seeds, "h")
    return found.select("doc", "item", "n", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()


def slices(docs: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """doc, item, n, diagonal, whole (the document's words), dw: the words beside the
    item on each diagonal."""
    count = cut(found.groupBy("doc").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > CROWD).select(F.col("doc").alias("crowd"), "c"), "crowds")
    part = F.coalesce(F.pmod(F.xxhash64("item", "diagonal"), F.ceil(F.col("c") / CROWD)), F.lit(0))
    sets = narrow_join(found, count, F.col("doc").eqNullSafe(F.col("crowd")), "left").groupBy("doc", part.alias("part")).agg(F.collect_list(F.struct("item", "n", "diagonal")).alias("hits"))
    sets = cut(sets.select(F.col("doc").alias("d"), "hits"), "sets")
    texts = docs.select(F.col(key).alias("doc"), F.col(text).alias("_t"))
    rows = narrow_join(texts, sets, texts["doc"].eqNullSafe(sets["d"])).select("doc", words("_t").alias("w"), "hits")
    beside = "transform(hits, h -> named_struct('item', h.item, 'n', h.n, 'diagonal', h.diagonal, 'whole', size(w), 'dw', slice(w, greatest(1, h.diagonal + 1), h.n)))"
    return rows.select("doc", F.explode(F.expr(beside)).alias("h")).select("doc", "h.*")


def best_stretch(penalty: int = PENALTY) -> Column:
    """Of `same` (an array of 0 and 1 along a diagonal) the stretch with the most ones
    among those with at most one 0 to `penalty` ones: matched words, its first and last
    place.

    Matches count 1 and substitutions -penalty; a stretch qualifies when its sum isn't
    negative. For every end the longest one begins where the running sum was first as
    low: f holds that place, and the matches before it, for each level from 0 down."""
    s, m = f"t.s + IF(x = 1, 1, -{penalty})", "t.m + x"
    low = f"IF(-({s}) >= size(t.f), concat(t.f, array_repeat(named_struct('i', t.i + 1, 'm', {m}), -({s}) - size(t.f) + 1)), t.f)"
    step = f"""transform(array(named_struct('s', {s}, 'm', {m}, 'f', {low})), n -> named_struct('s', n.s, 'm', n.m, 'f', n.f, 'b', n.f[greatest(-n.s, 0)]))[0]"""
    go = f"""transform(array({step}), n -> named_struct(
        'i', t.i + 1, 's', n.s, 'm', n.m, 'f', n.f, 'bm', greatest(t.bm, n.m - n.b.m),
        'ba', IF(n.m - n.b.m > t.bm, n.b.i, t.ba), 'bb', IF(n.m - n.b.m > t.bm, t.i, t.bb)))[0]"""
    empty = "named_struct('i', 0, 's', 0, 'm', 0, 'f', array(named_struct('i', 0, 'm', 0)), 'bm', 0, 'ba', 0, 'bb', -1)"
    first = "t.ba + greatest(cast(array_position(slice(same, t.ba + 1, size(same)), 1) as int) - 1, 0)"
    return F.expr(f"aggregate(same, {empty}, (t, x) -> {go}, t -> named_struct('matched', t.bm, 'first', {first}, 'last', t.bb))")


def overlaps(docs: DataFrame, bench: DataFrame, masks: tuple[str, ...] = MASKS, matched: int = MATCHED, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", short_items: bool = False) -> DataFrame:
    """doc_id, item_id, matched, words, doc_from, doc_to, identity: the best stretch
    of every contaminated document and item; positions are words, ends exclusive."""
    items = bench.select(F.col(item_key).alias("item"), words(item_text).alias("w")).where(F.size("w") >= (1 if short_items else SHORTEST))
    items = cut(items.groupBy("w").agg(F.min("item").alias("item")).select("w", "item", F.size("w").alias("n")), "items")
    # at most SHORTEST - 1 rows
    short = sorted(r.n for r in items.where(F.col("n") < SHORTEST).select("n").distinct().collect())
    texts = docs.select(F.col(key).alias("doc"), hashed(words(text)).alias("w"))
    found = cut(hits(texts, items.select("item", "n", hashed(F.col("w")).alias("w")), (*masks, *("1" * n for n in short))), "hits")
    beside = slices(docs, found, key, text)
    item_words = items.select(F.col("item").alias("i"), F.col("w").alias("iw"))
    laid = narrow_join(beside, item_words, F.col("item").eqNullSafe(F.col("i"))).where((F.col("n") > 2) | (F.col("whole") == F.col("n")))
    laid = laid.withColumn("skip", F.greatest(F.lit(0), -F.col("diagonal")))
    same = F.expr("transform(iw, (x, j) -> IF(j >= skip AND get(dw, j - skip) = x, 1, 0))")
    scored = laid.select("doc", "item", "diagonal", "n", same.alias("same")).withColumn("b", best_stretch())
    enough = F.when(F.col("n") < SHORTEST, F.col("n")).otherwise(F.least(F.lit(matched), F.ceil(F.col("n") * 0.8).cast("int")))
    kept = scored.where(F.col("b.matched") >= enough).select("doc", "item", F.struct(F.col("b.matched").alias("matched"), -F.col("diagonal"), F.col("n").alias("n"), (F.col("diagonal") + F.col("b.first")).alias("a"), (F.col("diagonal") + F.col("b.last") + 1).alias("z")).alias("r"))
    best = kept.groupBy("doc", "item").agg(F.max("r").alias("r"))
    return best.select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("r.matched").alias("matched"), F.col("r.n").alias("words"),
        F.col("r.a").alias("doc_from"), F.col("r.z").alias("doc_to"), F.round(F.col("r.matched") / (F.col("r.z") - F.col("r.a")), 4).alias("identity"),
    )


def drop_contaminated(docs: DataFrame, bench: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The documents that no item contaminates, as they came."""
    id_ = unused(docs.columns, "_bad")[0]
    bad = cut(overlaps(docs, bench, key=key, **options).select(F.col("doc_id").alias(id_)).distinct(), "bad")
    return narrow_join(docs, bad, F.col(f"`{key}`").eqNullSafe(F.col(id_)), "left_anti")
