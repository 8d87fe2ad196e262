"""The candidate pool: accumulation, screening, blocking, neighbourhoods, promotion."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlex.functions import text as T
from arborlex.operators.ordering import with_index
from arborlex.operators.storage import cut, narrow_join

GROUP = "group_id string, name string, definition string, support_count long"
MAX_GROUP, MIN_SIMILARITY = 12, 0.80


def split_new(groups: DataFrame, pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pool with the support of exact repeats added, groups to screen)."""
    new = groups.select("group_id", F.col("support_count").alias("_more"))
    grown = pool.join(new, "group_id", "left").withColumn("support_count", F.col("support_count") + F.coalesce("_more", F.lit(0))).drop("_more")
    return grown, groups.join(pool.select("group_id"), "group_id", "left_anti")


def apply_screening(pool: DataFrame, groups: DataFrame, decisions: DataFrame) -> DataFrame:
    """The pool after decisions (proposal_group_id, action): kept groups come in,
    mapped and discarded ones go, whether they were new or in the pool."""
    d = decisions.select(F.col("proposal_group_id").alias("group_id"), "action")
    keep = groups.join(d.where("action = 'keep_candidate'").select("group_id"), "group_id", "left_semi")
    stay = pool.join(d.where("action <> 'keep_candidate'").select("group_id"), "group_id", "left_anti")
    return stay.unionByName(keep.join(pool.select("group_id"), "group_id", "left_anti").select(pool.columns))


def apply_consolidation(pool: DataFrame, assignments: DataFrame) -> DataFrame:
    """The pool after assignments (group_id, rep): each representative stands for all
    that are assigned to it, with their support; others stay as they are."""
    joined = pool.join(assignments, "group_id")
    support = joined.groupBy(F.col("rep").alias("group_id")).agg(F.sum("support_count").alias("support_count"))
    reps = pool.drop("support_count").join(support, "group_id").select(pool.columns)
    return reps.unionByName(pool.join(assignments.select("group_id"), "group_id", "left_anti"))


def eligible(pool: DataFrame, least: int) -> DataFrame:
    return pool.where(F.col("support_count") >= least)


def top_eligible(pool: DataFrame, least: int, most: int, slots: int) -> DataFrame:
    """The groups that are promoted next: those with most support, ties by id."""
    return eligible(pool, least).orderBy(F.desc("support_count"), "group_id").limit(max(0, min(most, slots)))


def screening_chunks(groups: DataFrame, size: int) -> DataFrame:
    """groups with chunk and prompt_id (P001, ... within its chunk), in id order."""
    indexed = with_index(groups, "group_id")
    number = (F.col("pos") % size + 1).cast("int")
    return indexed.withColumns({"chunk": F.floor(F.col("pos") / size).cast("long"), "prompt_id": F.format_string("P%03d", number)}).drop("pos")


# ----------------------------------------------------------------- similarity


#: Holders of a key that one part of its self-join has on either side, and pairs that one
#: task makes: what is read is small, so tasks are dealt by what they make.
PART, TASK_PAIRS = 2048, 4_000_000


def _meet(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Pairs of the rows (group_id, key, and others) of a key, left_id < right_id: key, and
    the columns as left_ and right_. A key's rows are dealt by id into parts of at most
    PART, each two of them meet in a part of the join, and as many tasks share these as
    the pairs ask for; pairs are not shuffled."""
    spark = rows.sparkSession
    own = W.partitionBy(key)
    place = F.row_number().over(own.orderBy("group_id"))
    dealt = rows.withColumns({"_part": F.floor((place - 1) / PART).cast("int"), "_last": F.floor((F.count(F.lit(1)).over(own) - 1) / PART).cast("int")})
    dealt = cut(dealt, "meet")
    pairs = dealt.groupBy(key).agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.sum(F.col("n") * F.col("n") / 2)).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -int(-pairs // TASK_PAIRS))
    side = lambda df, k: df.select(key, "_i", "_j", *(F.col(c).alias(f"{k}_{c.removeprefix('group_')}") for c in columns)).repartition(tasks, key, "_i", "_j")
    left = side(dealt.withColumns({"_i": F.col("_part"), "_j": F.explode(F.sequence("_part", "_last"))}), "left")
    right = side(dealt.withColumns({"_j": F.col("_part"), "_i": F.explode(F.sequence(F.lit(0), "_part"))}), "right")
    return left.hint("merge").join(right, [key, "_i", "_j"]).where("left_id < right_id").drop("_i", "_j")


def _named(pool: DataFrame) -> DataFrame:
    return pool.select("group_id", "name", T.name_tokens("name").alias("tokens"))


def _blocked(pool: DataFrame, least: float = 0.0) -> DataFrame:
    """left_ and right_ id, name and tokens of candidates that share an informative
    token (left < right), each pair once: at the first token it shares. Those whose
    lengths or tokens rule out a score of `least` are dropped inside the join."""
    own = _named(pool)
    if least > 0:
        own = own.withColumns({"size": F.length(F.array_join("tokens", " ")), "plain": T.normalize_text("name")})
    rows = own.select("*", F.posexplode("tokens").alias("_at", "token")).withColumn("before", F.slice("tokens", 1, F.col("_at"))).drop("_at")
    both = _meet(rows, "token", [*own.columns, "before"])
    if least > 0:
        lengths = 2 * F.least("left_size", "right_size") / (F.col("left_size") + F.col("right_size")) >= least
        both = both.where(lengths | (T.overlap_score("left_tokens", "right_tokens") >= least) | (F.col("left_plain") == F.col("right_plain")))
        both = both.drop("left_size", "left_plain", "right_size", "right_plain")
    both = both.where((F.size("left_before") == 0) | (F.size("right_before") == 0) | ~F.arrays_overlap("left_before", "right_before"))
    return both.drop("token", "left_before", "right_before")


def block_pairs(pool: DataFrame) -> DataFrame:
    """left_id, right_id (left < right) of candidates that share an informative token."""
    return _blocked(pool).select("left_id", "right_id")


def token_pairs(pool: DataFrame) -> DataFrame:
    """left_id, right_id of the same pairs, and their tokens (left, right)."""
    return _blocked(pool).select("left_id", "right_id", F.col("left_tokens").alias("left"), F.col("right_tokens").alias("right"))


def scored_pairs(pool: DataFrame, excluded: DataFrame | None = None, least: float = 0.0) -> DataFrame:
    """left_id, left_name, right_id, right_name, scores and shared tokens of blocked
    pairs, each scored once with the smaller id first; only those of at least `least`."""
    both = _blocked(pool, least)
    if excluded is not None:
        both = both.join(excluded, ["left_id", "right_id"], "left_anti")
    both = both.withColumn("s", T.name_similarity("left_name", "right_name", least)).where(F.col("s.score") >= least)
    return both.select("left_id", "left_name", "right_id", "right_name", "s.score", "s.sequence_score", "s.overlap_score", F.array_sort(F.array_intersect("left_tokens", "right_tokens")).alias("shared_tokens"))


def reviewed_pairs(history: DataFrame, pool: DataFrame) -> DataFrame:
    """left_id, right_id of current candidates that one consolidation told apart, each
    pair once: at the first entry where their representatives differ. history:
    entry_id, group_id, rep."""
    now = history.select("entry_id", "group_id", "rep").where("entry_id is not null and rep is not null").join(pool.select("group_id"), "group_id", "left_semi")
    entries = now.groupBy("group_id", "entry_id").agg(F.array_sort(F.collect_set("rep")).alias("reps")).withColumn("one", F.struct("entry_id", "reps"))
    # as many as there were consolidations with it
    rows = entries.withColumn("entries", F.array_sort(F.collect_list("one").over(W.partitionBy("group_id")))).drop("one")
    both = _meet(rows, "entry_id", ["group_id", "reps", "entries"])
    apart = lambda x, y: (F.size(x) > 1) | (F.size(y) > 1) | (x[0] != y[0])
    told = F.filter("left_entries", lambda x: F.exists("right_entries", lambda y: (x["entry_id"] == y["entry_id"]) & apart(x["reps"], y["reps"])))
    once = (F.size("left_entries") == 1) | (F.size("right_entries") == 1) | (F.col("entry_id") == F.get(told, F.lit(0))["entry_id"])
    return both.where(apart(F.col("left_reps"), F.col("right_reps")) & once).select("left_id", "right_id")


def _components(edges: DataFrame) -> DataFrame:
    """group_id, component: smallest id reachable; labels sink along edges until
    none changes."""
    both = cut(edges.select(F.col("left_id").alias("a"), F.col("right_id").alias("b")).union(edges.select("right_id", "left_id")), "edges")
    labels = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), F.col("label").alias("l")), "b").groupBy("a").agg(F.min("l").alias("l"))
        new = labels.join(near, "a").select("a", F.least("label", "l").alias("label"), (F.col("l") < F.col("label")).alias("moved"))
        # and one step up, so that long chains take few rounds
        up = new.select(F.col("a").alias("label"), F.col("label").alias("above"))
        new = cut(new.join(up, "label", "left").select("a", F.coalesce("above", "label").alias("label"), "moved"), "labels")
        labels = new.select("a", "label")
        if new.where("moved").isEmpty():
            return labels.select(F.col("a").alias("group_id"), F.col("label").alias("component"))


def greedy_cliques(rows: list[tuple[str, str]], scores: dict[tuple[str, str], float], blocked: set[tuple[str, str]], excluded: set[tuple[str, str]], threshold: float, most: int) -> list[list[str]]:
    """Disjoint groups of mutually similar candidates, seeds in id order; a seed's
    neighbours by score, then id; a seed alone is used up."""
    names = dict(rows)

    def score(a: str, b: str) -> float:
        key = (a, b) if a < b else (b, a)
        if key not in scores:
            scores[key] = T.similarity(names[key[0]], names[key[1]])[0]
        return scores[key]

    def fits(a: str, b: str) -> bool:
        key = (a, b) if a < b else (b, a)
        return key not in excluded and score(a, b) >= threshold

    near: dict[str, set[str]] = {g: set() for g in names}
    for a, b in blocked:
        near[a].add(b)
        near[b].add(a)
    free, out = set(names), []
    for seed in sorted(names):
        if seed not in free:
            continue
        group = [seed]
        for other in sorted((o for o in near[seed] & free if o != seed and fits(seed, o)), key=lambda o: (-score(seed, o), o)):
            if len(group) == most:
                break
            if all(fits(other, g) for g in group):
                group.append(other)
        free -= set(group)
        if len(group) > 1:
            out.append(group)
    return out


MEMBER = "threshold double, seed_id string, member_pos int, group_id string, min_similarity double, mean_similarity double"
#: Links that one task works on at once (some 150 bytes each).
COMPONENT_LINKS = 400_000
_LINK = ["left_id", "left_name", "right_id", "right_name", "score"]


def neighbourhoods(pool: DataFrame, thresholds: list[float], most: int = MAX_GROUP, excluded: DataFrame | None = None, pairs: DataFrame | None = None, limit: int = COMPONENT_LINKS) -> DataFrame:
    """Members of the groups of mutually similar candidates, for each threshold.

    A seed meets only candidates it is linked with by a blocked pair of at least the
    threshold, so components of the links of the lowest threshold don't touch each
    other. Those of up to `limit` links are gone through in one task each; larger ones
    in rounds of as many seeds as have that many links."""
    if most < 2:
        raise ValueError("most must be at least 2")
    if not all(0 <= t <= 1 for t in thresholds):
        raise ValueError("thresholds must be between 0 and 1")
    least = min(thresholds)
    pairs = cut(scored_pairs(pool, excluded, least) if pairs is None else pairs.where(F.col("score") >= least), "pairs")
    parts = cut(_components(pairs), "components")
    own = parts.select(F.col("group_id").alias("left_id"), "component")
    links = cut(pairs.select(*_LINK).join(own, "left_id"), "links")
    apart = cut(excluded.join(own, "left_id").select("component", "left_id", "right_id"), "apart") if excluded is not None else None
    large = cut(links.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("component"), "large")
    if large.isEmpty():
        return _turns(links, apart, thresholds, most)
    out = _turns(narrow_join(links, large, "component", "left_anti"), apart, thresholds, most)
    many = cut(narrow_join(links, large, "component", "left_semi"), "links")
    for t in thresholds:
        out = out.unionByName(_in_rounds(many.where(F.col("score") >= t), apart, t, most, limit))
    return out


def _turns(links: DataFrame, apart: DataFrame | None, thresholds: list[float], most: int, seeds: bool = False) -> DataFrame:
    """MEMBER rows of the groups that each component's seeds form: all candidates in
    turn, or (if `seeds`) only those on the left of a link, groups of one included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own, told in zip(batch.column("links"), batch.column("told"), strict=True):
                left, left_name, right, right_name, score = (c.to_pylist() for c in own.values.flatten())
                names = dict(zip(left, left_name, strict=True)) | dict(zip(right, right_name, strict=True))
                scores = dict(zip(zip(left, right, strict=True), score, strict=True))
                excluded = {(x["left_id"], x["right_id"]) for x in told.as_py() or []}
                blocked, turn = dict(scores), set(left) if seeds else None
                for t in thresholds:
                    for group in greedy_cliques(list(names.items()), scores, {k for k, s in blocked.items() if s >= t}, excluded, t, most):
                        if turn is not None and group[0] not in turn:
                            continue
                        s = [scores[min(a, b), max(a, b)] for i, a in enumerate(group) for b in group[i + 1 :]]
                        rows += [(t, group[0], k, g, min(s), sum(s) / len(s)) for k, g in enumerate(group)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = (pa.float64(), pa.string(), pa.int32(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in MEMBER.split(", ")])

    rows = links.groupBy("component").agg(F.collect_list(F.struct(*_LINK)).alias("links"))
    if apart is None:
        rows = rows.withColumn("told", F.lit(None).cast("array<struct<left_id:string,right_id:string>>"))
    else:
        rows = rows.join(apart.groupBy("component").agg(F.collect_list(F.struct("left_id", "right_id")).alias("told")), "component", "left")
    return rows.select("links", "told").mapInArrow(run, MEMBER)


def _in_rounds(links: DataFrame, apart: DataFrame | None, threshold: float, most: int, limit: int) -> DataFrame:
    """What greedy_cliques gives, a stretch of seeds at a time. When a seed has its turn
    all smaller candidates are gone, so it only needs its links with larger ones. In each
    round the smallest candidates of each component, as many as have `limit` links
    together (one at least), have their turns in one task; they and what they took are
    out for the next."""
    left, found = cut(links, "links"), []
    before = W.partitionBy("component").orderBy("left_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    while not left.isEmpty():
        sizes = left.groupBy("component", "left_id").agg(F.count(F.lit(1)).alias("n")).withColumns({"sum": F.sum("n").over(before), "row": F.row_number().over(W.partitionBy("component").orderBy("left_id"))})
        seeds = cut(sizes.where((F.col("sum") <= limit) | (F.col("row") == 1)).select("left_id"), "seeds")
        own = left.join(seeds, "left_id", "left_semi")
        groups = cut(_turns(own, apart, [threshold], most, True), "groups")
        found.append(groups)
        gone = cut(seeds.select(F.col("left_id").alias("id")).union(groups.select("group_id")).distinct(), "gone")
        here = lambda c: gone.select(F.col("id").alias(c))  # noqa: B023, E731
        left = cut(left.join(here("left_id"), "left_id", "left_anti").join(here("right_id"), "right_id", "left_anti").select(links.columns), "links")
    return reduce(DataFrame.union, found) if found else links.sparkSession.createDataFrame([], MEMBER)


def worth_reviewing(members: DataFrame, pool: DataFrame, least: int) -> DataFrame:
    """Members of those groups whose candidates have enough support together."""
    w = W.partitionBy("threshold", "seed_id")
    joined = members.join(pool.select("group_id", "support_count"), "group_id").withColumn("combined_support", F.sum("support_count").over(w))
    return joined.where(F.col("combined_support") >= least)
