"""Mixing sources to target weights by pivotal dependent rounding (op6).

A source with target t and size s takes every document t/s times: the whole part
surely, the fraction by rounding. Fractions are rounded in pairs: mass (words) is
moved at random from one document to the other until one of them is integral, in
the direction that keeps each one's expectation. The survivor meets the next
document. Buckets of about FAN documents do so side by side; the one fractional
document that each leaves goes up a tree, FAN buckets to a node, until each source
has one left, which is rounded by its fraction. Words are kept at every step, so
a source misses its target by less than one document.

Randomness is a hash of the seed and the documents met: reruns agree.

Defined results: null and wordless texts have size 0 and are taken 0 words; a
source without words has target 0; null sources are one source, last in order;
repeated rows are told apart by a running number and may be taken differently
often; an empty table gives an empty table; null ids are allowed; ids may be of any
type that has an order; all columns are kept by `mix_documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlex.llm.common import WORD, cut, global_order, narrow_join, numbered, numbered_copies, renamed, union_all, unused

FAN = 128
MOST = 3
SEED = 17
WEIGHTS = (1, 2, 3)
#: A document on its way through the tree: sort key first (large ones meet first,
#: so that the last survivor tends to be small).
_ITEM = "struct<big:bigint,doc_id:bigint,tie:bigint,copy:int,size:bigint,p:double>"


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """skey, source, source_size, n, target: shares of all words by weight, none
    above `most` times its source's size; the excess is shared again by weight
    among the others until none is above."""
    by_source = sizes.groupBy("skey", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ordered = global_order(by_source, [F.col("source").asc_nulls_last()], {}, "sources")
    table = cut(ordered.select("skey", "source", "source_size", "n", F.element_at(F.array(*map(F.lit, weights)), (F.col("_row") % len(weights) + 1).cast("int")).alias("weight"), (F.col("source_size") * most).alias("cap")), "sources")
    share = 0.0
    while True:  # a source once capped stays so: the share of a unit of weight only grows
        capped = F.col("cap") <= share * F.col("weight")
        row = table.agg(F.sum("source_size").alias("t"), F.sum(F.when(capped, F.col("cap"))).alias("c"), F.sum(F.when(~capped, F.col("weight"))).alias("w")).first()
        if not row.w:
            break
        now = ((row.t or 0) - (row.c or 0)) / row.w
        if now <= share:
            break
        share = now
    return table.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(share) * F.col("weight")))


def _uniform(*cols: str) -> str:
    return f"((xxhash64({', '.join(cols)}, {SEED}L) & 9007199254740991L) / 9007199254740992D)"


def _fold(items: str) -> str:
    """SQL: {cur, done} after the documents of `items` met one after the other.
    done: structs of a document and whether it takes one more copy."""
    empty = f"named_struct('cur', cast(null as {_ITEM}), 'done', cast(array() as array<struct<it:{_ITEM},up:int>>))"
    a, b = "s.cur", "b"
    # what can move up in one is what can move down in the other, in words
    let = f"""named_struct('up', least((1D - {a}.p) * {a}.size, {b}.p * {b}.size), 'dn', least({a}.p * {a}.size, (1D - {b}.p) * {b}.size), 'u', {_uniform("s.cur.doc_id", "s.cur.tie", "s.cur.copy", "b.doc_id", "b.tie", "b.copy")})"""
    moved = f"""transform(array({let}), d -> CASE WHEN d.u * (d.up + d.dn) < d.dn
        THEN named_struct('pa', CASE WHEN (1D - {a}.p) * {a}.size <= {b}.p * {b}.size THEN 1D ELSE {a}.p + d.up / {a}.size END,
                          'pb', CASE WHEN (1D - {a}.p) * {a}.size >= {b}.p * {b}.size THEN 0D ELSE {b}.p - d.up / {b}.size END)
        ELSE named_struct('pa', CASE WHEN {a}.p * {a}.size <= (1D - {b}.p) * {b}.size THEN 0D ELSE {a}.p - d.dn / {a}.size END,
                          'pb', CASE WHEN {a}.p * {a}.size >= (1D - {b}.p) * {b}.size THEN 1D ELSE {b}.p + d.dn / {b}.size END) END)[0]"""
    put = lambda x, p: f"cast(named_struct('big', {x}.big, 'doc_id', {x}.doc_id, 'tie', {x}.tie, 'copy', {x}.copy, 'size', {x}.size, 'p', {p}) as {_ITEM})"
    whole = lambda x, p: f"cast(array(named_struct('it', {put(x, p)}, 'up', cast({p} as int))) as array<struct<it:{_ITEM},up:int>>)"
    none = f"cast(null as {_ITEM})"
    met = f"""transform(array({moved}), m -> named_struct(
        'cur', CASE WHEN m.pa > 0D AND m.pa < 1D THEN {put(a, "m.pa")} WHEN m.pb > 0D AND m.pb < 1D THEN {put(b, "m.pb")} ELSE {none} END,
        'done', concat(s.done, CASE WHEN m.pa <= 0D OR m.pa >= 1D THEN {whole(a, "m.pa")} ELSE array() END,
                               CASE WHEN m.pb <= 0D OR m.pb >= 1D THEN {whole(b, "m.pb")} ELSE array() END)))[0]"""
    state = f"struct<cur:{_ITEM},done:array<struct<it:{_ITEM},up:int>>>"
    return f"""aggregate({items}, {empty}, (s, b) -> cast(CASE
        WHEN b.p <= 0D OR b.p >= 1D THEN named_struct('cur', s.cur, 'done', concat(s.done, {whole("b", "b.p")}))
        WHEN s.cur IS NULL THEN named_struct('cur', {put("b", "b.p")}, 'done', s.done)
        ELSE {met} END as {state}))"""


def round_fractions(rows: DataFrame, fan: int = FAN) -> DataFrame:
    """it (document), up (0 or 1) for rows of skey, n and an item with fraction p."""
    most = rows.agg(F.max("n")).first()[0] or 0
    own = F.greatest(F.lit(1), F.ceil(F.col("n") / fan)).cast("long")
    level = rows.withColumn("node", F.pmod(F.xxhash64("it.doc_id", "it.tie", "it.copy", F.lit(SEED)), own))
    done, nodes = [], -(-most // fan)
    while True:
        folded = level.groupBy("skey", "node").agg(F.array_sort(F.collect_list("it")).alias("items")).select("skey", "node", F.expr(_fold("items")).alias("s"))
        step = cut(folded.select("skey", "node", "s.cur", "s.done"), "mix")
        done.append(step.select(F.explode("done").alias("d")).select("d.it", "d.up"))
        left = step.where("cur is not null").select("skey", F.floor(F.col("node") / fan).cast("long").alias("node"), F.col("cur").alias("it"))
        if nodes <= 1:
            break
        level, nodes = left, -(-nodes // fan)
    # one document a source is still between 0 and 1
    last = F.expr(_uniform("it.doc_id", "it.tie", "it.copy", "-1L")) < F.col("it.p")
    return union_all([*done, left.select("it", last.cast("int").alias("up"))])


def mix_sizes(narrow: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, fan: int = FAN) -> DataFrame:
    """doc_id, tie, copy, size, source, source_size, target, copies for rows of
    doc_id, tie, size, source. copy numbers rows that agree in all of these."""
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    same = cut(narrow.withColumn("skey", key).groupBy("skey", "source", "doc_id", "tie", "size").agg(F.count(F.lit(1)).cast("int").alias("m")), "sizes")
    rows = same.withColumn("copy", F.explode(F.sequence(F.lit(1), "m"))).drop("m")
    targets = cut(source_targets(rows, weights, most), "targets")
    joined = narrow_join(rows, targets.drop("source"), "skey")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    part = F.when((F.col("size") > 0) & (rate < most), rate - F.floor(rate)).otherwise(F.lit(0.0))
    items = joined.select("skey", "n", F.struct((-F.col("size")).alias("big"), F.col("doc_id").cast("long").alias("doc_id"), "tie", "copy", "size", part.alias("p")).alias("it"))
    ups = round_fractions(items.withColumn("it", F.col("it").cast(_ITEM)), fan).select(F.col("it.doc_id").alias("d"), F.col("it.tie").alias("t"), F.col("it.copy").alias("c"), F.col("it.size").alias("z"), "up")
    on = joined.doc_id.cast("long").eqNullSafe(ups.d) & (joined.tie == ups.t) & (joined["copy"] == ups.c) & (joined["size"] == ups.z)
    return joined.join(ups, on).select("doc_id", "tie", "copy", "size", "source", "source_size", "target", F.least(F.lit(most), F.floor(rate).cast("int") + F.col("up")).alias("copies"))


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    # the source and all columns that could tell rows apart are in the tie
    return docs.select(F.col(key).alias("doc_id"), F.xxhash64(body, F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))).alias("tie"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"), F.col(source).alias("source"))


def mix_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    rows, names = numbered(docs.select(*dict.fromkeys((key, text, source))), key)
    m = mix_sizes(sized(rows, rows.columns[-1], text, source), **options)
    out = m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "source", "copies")
    return renamed(out, names, "doc_id")


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: every row as often as it is taken (0 to 3 times), with the
    columns it came with. Rows equal in key, text and source share their number of
    copies by a running number within such a group."""
    rows, _ = numbered(docs, key)
    number = rows.columns[-1]
    tie, copy, again = unused(rows.columns, "_tie", "_copy", "_again")
    copies = mix_sizes(sized(rows, number, text, source), **options).where("copies > 0").select(F.col("doc_id").alias("k"), F.col("tie").alias("t"), F.col("copy").alias("c"), F.col("copies").alias("times"))
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")))
    rows = numbered_copies(rows.withColumn(tie, F.struct(F.col(number).alias("k"), mark.alias("t"))), tie, copy).alias("l")
    joined = rows.join(copies.alias("r"), F.col(f"l.{tie}.k").eqNullSafe(F.col("r.k")) & (F.col(f"l.{tie}.t") == F.col("r.t")) & (F.col(f"l.{copy}") == F.col("r.c")))
    return joined.select(*(F.col(f"l.`{c}`") for c in docs.columns), F.explode(F.sequence(F.lit(1), "r.times")).alias(again)).drop(again)
