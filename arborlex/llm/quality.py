"""Document quality by hierarchical empirical Bayes (op8).

A document's own evidence is a logistic classifier on counts of its text. Sites
and their paths add theirs: the sums of document probabilities of each host and
each path are shrunk, paths toward their host, hosts toward the corpus, with
strengths estimated from the spread between groups (method of moments). A sparse
site thus keeps close to the global prior, a large one to its own mean. The path's
posterior odds against the corpus' odds shift the document's.

The classifier is fitted on at most SAMPLE labelled rows whose crc32(doc_id as text)
mod 4 is not 2; everything else covers all rows. Group sums are aggregated before
they are shuffled, and joined back by broadcast only when counted small.

Defined results: null and empty texts have all counts 0; null hosts and paths are
groups of their own; with no labelled rows of both classes all documents get the
smoothed rate; repeated rows count as often as they occur; an empty table gives an
empty table; `keep_good` returns rows with the columns they came with.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborlex.llm.common import cut, narrow_join, unused

SAMPLE = 20_000
THRESHOLD = 0.5


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def text_counts(text: str = "text") -> dict[str, Column]:
    """Features of a text, all between 0 and a few units."""
    t = F.coalesce(F.col(text), F.lit(""))
    chars = F.greatest(F.lit(1), F.length(t)).cast("double")
    left = lambda pattern: F.length(F.regexp_replace(t, pattern, ""))
    split = F.split(t, r"[\x20\x09-\x0D]+")
    n = F.greatest(F.lit(1), F.size(split)).cast("double")
    return {
        "length": F.log1p(n) / 10,
        "upper": (chars - left("[A-Z]")) / chars,
        "pipes": F.least(F.lit(1.0), 10 * (chars - F.length(F.replace(t, F.lit("|"), F.lit("")))) / chars),
        "shouts": F.least(F.lit(1.0), 10 * (chars - F.length(F.replace(t, F.lit("!"), F.lit("")))) / chars),
        "symbols": F.least(F.lit(1.0), 10 * (chars - left("[#$%&*@~^]")) / chars),
        "digits": (chars - left("[0-9]")) / chars,
        "distinct": F.size(F.array_distinct(split)) / n,
        "word": F.least(F.lit(3.0), chars / n / 10),
    }


def _newton(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 50) -> np.ndarray:
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    ridge = np.full(a.shape[1], l2 * len(y) ** 0.5)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(ridge), a.T @ (p - y) + ridge * w)
        w = w - np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _expanded(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, x * x])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Weights of the features, of their squares, and the bias."""
    own = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).groupBy(key).agg(F.min(label).cast("int").alias("_y"))
    own = own.orderBy(F.xxhash64(key), key).limit(sample).withColumnRenamed(key, "_key")
    counts = text_counts("_text")
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(own), F.col("_id") == F.col("_key"))
    rows = rows.select("_key", F.struct("_y", *(c.alias(f"f_{k}") for k, c in counts.items())).alias("r"))
    # one row for each id: at most `sample`, here and on the driver
    rows = rows.groupBy("_key").agg(F.min("r").alias("r")).select("r.*").toPandas()
    y = (rows["_y"].to_numpy() > 0).astype(float)
    if not len(y) or y.min() == y.max():
        bias = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        return np.array([0.0] * 2 * len(counts) + [bias])
    return _newton(_expanded(rows[[f"f_{k}" for k in counts]].to_numpy(float)), y)


def document_evidence(w: np.ndarray, text: str = "text") -> Column:
    """The classifier's log odds of a row's text."""
    cols = list(text_counts(text).values())
    z = F.lit(float(w[-1]))
    for c, a, b in zip(cols, w[: len(cols)], w[len(cols) : -1], strict=True):
        z = z + F.lit(float(a)) * c + F.lit(float(b)) * c * c
    return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))


def _strength(groups: DataFrame, mean: Column) -> float:
    """Prior observations m of groups (k of n) around `mean`, by moments:
    E[(k/n - mean)^2] = mean (1 - mean) (1/n + (1 - 1/n) / (m + 1)), weighted by n."""
    v = mean * (1 - mean)
    row = groups.agg(F.sum(F.col("n") * (F.col("k") / F.col("n") - mean) ** 2).alias("s"), F.sum(v).alias("a"), F.sum((F.col("n") - 1) * v).alias("b")).first()
    if not row.b or row.s is None or row.s <= row.a:
        return 1e6  # no more spread than chance gives
    return min(1e6, max(0.5, row.b / (row.s - row.a) - 1))


def site_posteriors(scored: DataFrame, host: str = "host", path: str = "path", p: str = "p") -> tuple[DataFrame, float]:
    """host, path, host_mean, path_mean for each path, and the corpus' mean."""
    paths = cut(scored.groupBy(host, path).agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("k")), "paths")
    hosts = cut(paths.groupBy(host).agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    mean = min(1 - 1e-6, max(1e-6, (total.k or 0.5) / (total.n or 1)))
    m = _strength(hosts, F.lit(mean))
    shrunk = cut(hosts.select(F.col(host).alias("_host"), ((F.col("k") + m * mean) / (F.col("n") + m)).alias("host_mean")), "hosts")
    joined = narrow_join(paths, shrunk, F.col(host).eqNullSafe(F.col("_host"))).drop("_host")
    m = _strength(joined, F.col("host_mean"))
    return cut(joined.select(F.col(host).alias("_host"), F.col(path).alias("_path"), "host_mean", ((F.col("k") + m * F.col("host_mean")) / (F.col("n") + m)).alias("path_mean")), "paths"), mean


def site_columns(docs: DataFrame, host: str | None = None, path: str | None = None, url: str = "url") -> tuple[Column, Column]:
    """Host and path of each row: the columns named, or else those of its url (the host
    in lower case, without user, port and a leading www; the first part of the path), or
    else, in a table without urls, its source for host and its language for path: the
    sites within which documents are alike there. What a table hasn't is null."""
    if url in docs.columns and not (host or path):
        at = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)
        return F.nullif(at, F.lit("")), F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]*)", 1), F.lit(""))
    own = lambda c, other: F.col(c or other) if (c or other) in docs.columns else F.lit(None).cast("string")
    return own(host, "source"), own(path, "lang")


def score_quality(docs: DataFrame, labels: DataFrame, host: str | None = None, path: str | None = None, label: str = "quality", sample: int = SAMPLE, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, evidence, host_mean, path_mean, score, keep of every row."""
    w = fit(docs, labels, label, sample, key, text)
    z = document_evidence(w, text)
    where, below = site_columns(docs, host, path)
    narrow = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), where.alias("host"), below.alias("path"), z.alias("z"))
    narrow = cut(narrow.withColumn("p", 1 / (1 + F.exp(-F.col("z")))), "scored")
    sites, mean = site_posteriors(narrow)
    logit = lambda c: F.log(c / (1 - c))
    safe = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("path_mean")))
    both = narrow_join(narrow, sites, narrow["host"].eqNullSafe(sites["_host"]) & narrow["path"].eqNullSafe(sites["_path"]))
    scored = both.withColumn("score", 1 / (1 + F.exp(-(F.col("z") + logit(safe) - math.log(mean / (1 - mean))))))
    return scored.select("doc_id", "held_out", F.col("p").alias("evidence"), "host_mean", "path_mean", "score", (F.col("score") >= threshold).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows with an id that is to be kept (rows that repeat an id go together,
    and stay if one of them is to be kept)."""
    id_ = unused(docs.columns, "_gone")[0]
    gone = score_quality(docs, labels, key=key, **options).groupBy("doc_id").agg(F.max("keep").alias("k")).where("not k").select(F.col("doc_id").alias(id_))
    return narrow_join(docs, cut(gone, "gone"), F.col(f"`{key}`").eqNullSafe(F.col(id_)), "left_anti")
