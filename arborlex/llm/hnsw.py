"""Approximate nearest neighbours by a navigable small-world graph for each shard (op4).

Vectors that are equal are one point of the index, with the smallest ids that a
result can hold. Points are dealt to cells by the nearest of some centroids, fitted on
a bounded sample, and cells to shards of at most SHARD_POINTS points by a hash, so a
crowded cell is several shards. Each shard builds a hierarchical graph, kept as flat
arrays (levels, an offset for each level, and fixed-width neighbour rows) in a table
with its vectors. A query visits the shards of its nearest cells, in blocks of queries;
their nearest are merged.

How many cells that takes is measured: the exact neighbours of CALIBRATE queries are
looked up among all points, and as many cells are visited as hold COVERED of them.
Vectors in clusters need few; those without any structure need nearly all, and get them.

Inner product is searched as cosine: each shard adds one coordinate that gives all
of its points the same length, which keeps the order of inner products. Points are
inserted in batches, each batch searching the graph of those before, all its
members at once; so are queries. Scores are inner products of the original vectors
in double precision.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do those whose length isn't the most frequent one's;
rows of equal vectors are ranked by id; a query's row isn't its own candidate, but other
rows with its id or vector are; null ids take no part; repeated rows (id and vector)
are one candidate; fewer than k candidates give fewer rows; an empty table gives an
empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlex.llm.common import cut, mix, narrow_join

#: Most points of a shard (its arrays take some 700 bytes a point at 64 dimensions).
SHARD_POINTS = 8_192
CELLS_LEAST, CELLS_MOST = 8, 1_024
#: Vectors on which centroids are fitted, and queries on which the visits are measured.
SAMPLE, CALIBRATE, COVERED = 16_384, 64, 0.99
M, EF_BUILD, EF_SEARCH = 16, 80, 128
#: The beam is at least this part of a shard's points.
BEAM_PART = 32
QUERY_BLOCK = 4_096


# --------------------------------------------------------------------- graph


class Graph:
    """Points on the unit sphere with neighbour rows for each level; -1 is no one."""

    def __init__(self, points: np.ndarray, m: int = M, ef: int = EF_BUILD) -> None:
        self.x, self.m, n = points, m, len(points)
        u = (mix(np.arange(n, dtype=np.uint64) + np.uint64(77)) >> np.uint64(11)).astype(float) / 2**53
        self.level = np.minimum((-np.log(np.maximum(u, 1e-12)) / np.log(m)).astype(np.int64), 5)
        self.rows: list[np.ndarray] = []  # for each level: point -> its row, or -1
        self.links: list[np.ndarray] = []
        for lv in range(int(self.level.max(initial=0)) + 1):
            members = np.flatnonzero(self.level >= lv)
            row = np.full(n, -1, np.int64)
            row[members] = np.arange(len(members))
            self.rows.append(row)
            self.links.append(np.full((len(members), 2 * m if lv == 0 else m), -1, np.int32))
        order = np.argsort(-self.level, kind="stable")  # highest first: each level's entry is there
        self.entry = int(order[0]) if n else -1
        done = 1
        while done < n:
            # a batch grows with the graph, so that few of its members miss each other
            size = max(1, min(done, 256, n - done))
            self._insert(order[done : done + size], ef)
            done += size

    def neighbours(self, level: int, ids: np.ndarray) -> np.ndarray:
        return self.links[level][self.rows[level][ids]]

    def _descend(self, q: np.ndarray, level: int, at: np.ndarray) -> np.ndarray:
        """Greedy walk of every query on one level."""
        best = np.einsum("ij,ij->i", q, self.x[at])
        active = np.arange(len(q))
        while len(active):
            near = self.neighbours(level, at[active])
            s = np.einsum("ij,ikj->ik", q[active], self.x[np.maximum(near, 0)])
            s[near < 0] = -np.inf
            top = s.argmax(1)
            value = s[np.arange(len(active)), top]
            better = value > best[active] + 1e-12
            moved = active[better]
            at[moved] = near[better, top[better]]
            best[moved] = value[better]
            active = moved
        return at

    def search(self, q: np.ndarray, ef: int, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every query, the ef best points of a level (-1 where fewer) and their
        scores, best first: a beam whose best unexpanded point is expanded, all
        queries in step."""
        b, n = len(q), len(self.x)
        ids = np.full((b, ef), -1, np.int64)
        score = np.full((b, ef), -np.inf, np.float32)
        opened = np.ones((b, ef), bool)
        seen = np.zeros((b, n), bool)
        rows = np.arange(b)
        ids[:, 0], score[:, 0], opened[:, 0] = at, np.einsum("ij,ij->i", q, self.x[at]), False
        seen[rows, at] = True
        active = rows
        while len(active):
            waiting = np.where(opened[active], -np.inf, score[active])
            k = waiting.argmax(1)
            more = np.isfinite(waiting[np.arange(len(active)), k])
            active, k = active[more], k[more]
            if not len(active):
                break
            opened[active, k] = True
            near = self.neighbours(level, ids[active, k])
            fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
            r, c = np.nonzero(fresh)
            seen[active[r], near[r, c]] = True
            s = np.full(near.shape, -np.inf, np.float32)
            s[r, c] = np.einsum("ij,ij->i", q[active[r]], self.x[near[r, c]])
            s[s <= score[active, -1][:, None]] = -np.inf  # can't enter the beam
            gain = np.isfinite(s).any(1)
            some = active[gain]
            if len(some):
                all_s = np.concatenate([score[some], s[gain]], 1)
                all_i = np.concatenate([ids[some], near[gain].astype(np.int64)], 1)
                all_o = np.concatenate([opened[some], np.zeros(near[gain].shape, bool)], 1)
                best = np.argsort(-all_s, 1, kind="stable")[:, :ef]
                score[some] = np.take_along_axis(all_s, best, 1)
                ids[some] = np.take_along_axis(all_i, best, 1)
                opened[some] = np.take_along_axis(all_o, best, 1) | ~np.isfinite(score[some])
                ids[some] = np.where(np.isfinite(score[some]), ids[some], -1)
        return ids, score

    def _select(self, ids: np.ndarray, score: np.ndarray, width: int) -> np.ndarray:
        """Of sorted candidates, those nearer to the point than to one chosen before,
        filled up with the others."""
        keep, rest = [], []
        cand = ids[ids >= 0]
        s = score[: len(cand)]
        g = self.x[cand] @ self.x[cand].T
        for i in range(len(cand)):
            (keep if all(g[i, j] < s[i] for j in keep) else rest).append(i)
            if len(keep) == width:
                break
        chosen = (keep + rest)[:width]
        out = np.full(width, -1, np.int32)
        out[: len(chosen)] = cand[chosen]
        return out

    def _insert(self, batch: np.ndarray, ef: int) -> None:
        q = self.x[batch]
        at = np.full(len(batch), self.entry)
        top = int(self.level[self.entry])
        for lv in range(top, -1, -1):
            here = np.flatnonzero(self.level[batch] >= lv)
            if len(here):
                ids, score = self.search(q[here], ef, lv, at[here].copy())
                width = self.links[lv].shape[1]
                back: dict[int, list[int]] = {}
                for i, p in enumerate(batch[here]):
                    mine = self._select(ids[i], score[i], self.m)
                    row = self.links[lv][self.rows[lv][p]]
                    row[: self.m] = mine
                    for other in mine[mine >= 0]:
                        back.setdefault(int(other), []).append(int(p))
                at[here] = np.where(ids[:, 0] >= 0, ids[:, 0], at[here])
                for other, new in back.items():
                    row = self.links[lv][self.rows[lv][other]]
                    have = row[row >= 0].astype(np.int64)
                    both = np.concatenate([have, new])
                    if len(both) > width:
                        s = self.x[both] @ self.x[other]
                        by = np.argsort(-s, kind="stable")
                        row[:] = self._select(both[by], s[by], width)
                    else:
                        row[: len(both)] = both
            rest = np.flatnonzero(self.level[batch] < lv)
            if len(rest):
                at[rest] = self._descend(q[rest], lv, at[rest])

    def nearest(self, q: np.ndarray, k: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.x):
            return np.full((len(q), 0), -1), np.zeros((len(q), 0))
        at = np.full(len(q), self.entry)
        for lv in range(int(self.level[self.entry]), 0, -1):
            at = self._descend(q, lv, at)
        ids, score = self.search(q, max(ef, k), 0, at)
        return ids[:, :k], score[:, :k]

    def to_arrays(self) -> dict[str, bytes]:
        return {"levels": self.level.astype(np.int8).tobytes(), "links": b"".join(x.tobytes() for x in self.links)}

    @classmethod
    def from_arrays(cls, points: np.ndarray, levels: bytes, links: bytes, m: int = M) -> Graph:
        g = cls.__new__(cls)
        g.x, g.m = points, m
        g.level = np.frombuffer(levels, np.int8).astype(np.int64)
        g.rows, g.links, at = [], [], 0
        for lv in range(int(g.level.max(initial=0)) + 1):
            members = np.flatnonzero(g.level >= lv)
            row = np.full(len(g.level), -1, np.int64)
            row[members] = np.arange(len(members))
            width = 2 * m if lv == 0 else m
            g.rows.append(row)
            g.links.append(np.frombuffer(links, np.int32, len(members) * width, at).reshape(-1, width))
            at += len(members) * width * 4
        g.entry = int(np.argsort(-g.level, kind="stable")[0]) if len(g.level) else -1
        return g


def unit(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors scaled to a ball of radius 1 and lifted onto the sphere."""
    v = vectors / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", v, v)))
    return np.hstack([v, rest[:, None]]).astype(np.float32)


# ----------------------------------------------------------------- operators


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (array of doubles) of rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(key).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(key).cast("long").alias("vec_id"), F.transform(v, lambda x: x + F.lit(0.0)).alias("v"))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (common.d if common else 0))


def points(rows: DataFrame, k: int) -> DataFrame:
    """rep, v, ids: distinct vectors with a number of their own, and the k + 1 smallest of
    their ids: no result can hold more of them."""
    w = W.partitionBy("v").orderBy("vec_id")
    return rows.distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).groupBy("v").agg(F.xxhash64(F.min("vec_id"), "v").alias("rep"), F.array_sort(F.collect_list("vec_id")).alias("ids"))


def centroids(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Means of the sample's points on the sphere, each point with its nearest mean."""
    c = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)]
    for _ in range(rounds):
        own = _nearest_cells(sample, c, 1)[:, 0]
        size = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, sample)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], c)
    return c


def _nearest_cells(points: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centroids of each point, nearest first."""
    far = (c * c).sum(1)[None, :] - 2 * points.astype(np.float64) @ c.T
    return np.argsort(far, 1, kind="stable")[:, :k]


def _lifted(queries: np.ndarray) -> np.ndarray:
    """Queries of length 1, on the sphere's equator."""
    return np.hstack([queries / np.linalg.norm(queries, axis=1, keepdims=True), np.zeros((len(queries), 1))]).astype(np.float32)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def in_cells(pts: DataFrame, c: np.ndarray, longest: float) -> DataFrame:
    """pts with the cell of each."""

    @F.pandas_udf("int")
    def cell(v: pd.Series) -> pd.Series:
        return pd.Series(_nearest_cells(unit(_matrix(v), longest), c, 1)[:, 0].astype(np.int32) if len(v) else [], dtype="int32")

    return pts.withColumn("cell", cell("v"))


def cells_needed(pts: DataFrame, queries: np.ndarray, c: np.ndarray, k: int, covered: float = COVERED) -> int:
    """As many nearest cells as hold this part of the exact neighbours of the queries:
    all points are compared with them, each partition gives its best."""

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            s = queries @ _matrix(batch["v"]).T
            top = np.argsort(-s, 1, kind="stable")[:, : k + 1]  # the query's own point is one of them
            q = np.repeat(np.arange(len(queries)), top.shape[1])
            yield pd.DataFrame({"q": q, "s": np.take_along_axis(s, top, 1).ravel(), "cell": batch["cell"].to_numpy()[top].ravel()})

    rows = pts.select("v", "cell").mapInPandas(best, "q int, s double, cell int")
    w = W.partitionBy("q").orderBy(F.desc("s"))
    near = rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).select("q", "cell").collect()  # CALIBRATE x (k + 1) rows
    place = np.argsort(_nearest_cells(_lifted(queries), c, len(c)), 1)
    ranks = np.sort([place[r.q, r.cell] for r in near])
    return int(ranks[min(len(ranks) - 1, int(np.ceil(covered * len(ranks))) - 1)]) + 1 if len(ranks) else len(c)


def build(spread: DataFrame, shards: int) -> DataFrame:
    """One row for each shard: its points and graph as flat arrays. Shards are few bytes
    and much work, so they aren't merged into a few tasks."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        v = _matrix(pdf["v"])
        longest = float(np.sqrt(np.einsum("ij,ij->i", v, v)).max())
        g = Graph(unit(v, longest))
        ids = pdf["ids"].tolist()
        row = {"shard": int(pdf["shard"].iloc[0]), "dim": v.shape[1], "longest": longest, "vectors": v.tobytes(), "reps": pdf["rep"].to_numpy(np.int64).tobytes(), "id_counts": np.array([len(i) for i in ids], np.int32).tobytes(), "ids": np.concatenate(ids).astype(np.int64).tobytes()}
        return pd.DataFrame([row | g.to_arrays()])

    schema = "shard int, dim int, longest double, vectors binary, reps binary, id_counts binary, ids binary, levels binary, links binary"
    return spread.repartition(shards, "shard").groupBy("shard").applyInPandas(one, schema)


def search(index: DataFrame, queries: DataFrame, k: int, shards: int, blocks: int = 1, ef: int = EF_SEARCH) -> DataFrame:
    """query (its rep), vec_id, own (whether of the query's own vector), score: for each
    query vector the k + 1 nearest ids of every shard it is sent to. queries: rep, v,
    shard. A shard meets its queries in blocks."""

    def visit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["query", "vec_id", "own", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in columns}).astype({"query": "int64", "vec_id": "int64", "own": "bool", "score": "float64"})
        s = left.iloc[0]
        v = np.frombuffer(s["vectors"], np.float64).reshape(-1, int(s["dim"]))
        g = Graph.from_arrays(unit(v, s["longest"]), s["levels"], s["links"])
        reps = np.frombuffer(s["reps"], np.int64)
        counts = np.frombuffer(s["id_counts"], np.int32)
        ids, first = np.frombuffer(s["ids"], np.int64), np.concatenate([[0], np.cumsum(counts)])
        found = []
        step = max(16, min(256, 32_000_000 // max(1, len(v))))  # bounds the table of visited points
        for at in range(0, len(right), step):
            part = right.iloc[at : at + step]
            q = _matrix(part["v"])
            near, _ = g.nearest(_lifted(q), k + 1, max(ef, len(v) // BEAM_PART))
            for rep, own, row in zip(part["rep"], q, near, strict=True):
                row = row[row >= 0]
                exact = (v[row] * own).sum(1)
                flat_s = np.repeat(exact, counts[row])
                flat_i = np.concatenate([ids[first[p] : first[p + 1]] for p in row]) if len(row) else np.zeros(0, np.int64)
                best = np.lexsort((flat_i, -flat_s))[: k + 1]
                found.append((np.full(len(best), rep), flat_i[best], np.repeat(reps[row] == rep, counts[row])[best], flat_s[best]))
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(columns, zip(*found, strict=True), strict=True)})

    tasks = queries.withColumn("block", F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int"))
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    apart = lambda df: df.repartition(shards * blocks, "shard", "block").groupBy("shard", "block")
    return apart(copies).cogroup(apart(tasks)).applyInPandas(visit, "query long, vec_id long, own boolean, score double")


def _sent(queries: DataFrame, c: np.ndarray, visits: int, first: list[int], parts: list[int]) -> DataFrame:
    """queries (rep, v) with each shard of their nearest cells. A cell's shards are
    numbered from `first`, `parts` of them."""

    @F.pandas_udf("array<int>")
    def shards(v: pd.Series) -> pd.Series:
        near = _nearest_cells(_lifted(_matrix(v)), c, visits) if len(v) else []
        return pd.Series([[first[x] + i for x in row for i in range(parts[x])] for row in near], dtype=object)

    return queries.withColumn("shard", F.explode(shards("v")))


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding", shard_points: int = SHARD_POINTS, ef: int = EF_SEARCH, covered: float = COVERED) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for every row whose
    id is divisible by `every`."""
    rows = cut(usable(vectors, key, vector), "vectors")
    pts = cut(points(rows, k), "points")
    size = pts.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("longest")).first()
    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    reps = pts.select(F.col("v").alias("pv"), "rep")
    named = cut(narrow_join(asked, reps, F.col("v") == F.col("pv"), limit=100_000).select("vec_id", "rep"), "asked")
    wanted = cut(named.select("rep").distinct(), "wanted")
    if not size.n or not (count := wanted.count()):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = cut(narrow_join(pts.select("rep", "v"), wanted, "rep", "left_semi"), "queries")
    some = lambda df, n: np.array([r.v for r in df.orderBy(F.xxhash64("rep"), "rep").limit(n).select("v").collect()])
    # SAMPLE and CALIBRATE vectors on the driver
    c = centroids(unit(some(pts, SAMPLE), size.longest), min(CELLS_MOST, max(CELLS_LEAST, -(-size.n // shard_points))))
    placed = cut(in_cells(pts, c, size.longest), "cells")
    held = {r.cell: r.n for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # CELLS_MOST rows
    parts = [-(-held.get(x, 0) // shard_points) for x in range(len(c))]
    first = np.concatenate([[0], np.cumsum(parts)]).astype(int).tolist()
    at = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cell") + 1)
    index = cut(build(placed.withColumn("shard", (at(first) + F.pmod(F.xxhash64("rep"), at(parts))).cast("int")), first[-1]), "index")
    visits = cells_needed(placed, some(queries, CALIBRATE), c, k, covered)
    sent = cut(_sent(queries, c, visits, first, parts), "sent")
    blocks = max(1, -(-count * visits // (len(c) * QUERY_BLOCK)))
    found = search(index, sent, k, first[-1], blocks, ef)
    w = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
    best = cut(best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "own", "score"))).alias("near")), "best")
    joined = narrow_join(named, best, F.col("rep") == F.col("query"), limit=100_000)
    # the query's own row, and no other, is left out
    other = F.slice(F.filter("near", lambda x: ~(x["own"] & (x["vec_id"] == F.col("vec_id")))), 1, k)
    out = joined.select(F.col("vec_id").alias("query_id"), F.posexplode(other).alias("pos", "c"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("c.vec_id").alias("vec_id"), F.col("c.score").alias("score"))
