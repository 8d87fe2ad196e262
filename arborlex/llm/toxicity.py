"""Toxicity by a weighted finite-state pattern grammar (op5).

Words become classes (abusive, violent, intent, target, negation, reporting verb,
other). Five small transducers read a clause's classes, each the output of the one
before: insults (an abusive word, or one that follows another closely), threats (a
violent word, or one under an intent), negation, reported speech and targets. They are
composed once into a single table. Targets also count when they follow ("kill you"):
the same transducer reads the marked clause once more from its end. A clause's matches,
weighted by the lexicon, add up by kind and outcome (plain, targeted, negated,
reported), and a logistic layer over these sums gives the score. So a match counts for
what its clause makes of it, and how much each outcome counts is learned, not assumed.

What is learned comes from labelled rows whose crc32(doc_id as text) mod 4 is not
2, at most SAMPLE of them (those with the smallest hashes), each text once: the
insult lexicon (whole words and word beginnings, picked and weighted by an
L1-penalised logistic regression on document occurrence; few labelled rows have most
insults only two or three times, so two occurrences are enough) and the logistic layer.
Scores read the text alone, all of it.

Defined results: null and empty texts get the score of a text without matches;
equal texts get equal scores; of a labelled id that repeats, one text teaches; rows with a null id are not held out; with no
labelled rows, or none of one class, every score is the smoothed rate; other
columns are kept and not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlex.llm.common import cut, unused

SAMPLE = 20_000
THRESHOLD = 0.3
MIN_DOCS, MIN_WEIGHT, PENALTY, PREFIXES = 2, 1.5, 1.0, (5, 6, 7)

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;\n]+(?:\s|$)|\n")

# Small closed classes of the four languages of the corpus.
THREAT = frozenset("kill hurt destroy punch strangle töten schlagen umbringen vernichten tuer frapper détruire matar golpear destruir".split())
INTENT = frozenset("will shall gonna going want must should werde werden will sollen müssen vais va allons veux doit faut voy va vamos quiero debe".split())
TARGET = frozenset("you your yours he she they them him her du dich dir ihr euch sie er tu te toi vous ton votre il ils elle elles usted ustedes tú ti vosotros él ella ellos".split())
NEGATION = frozenset("not no never nobody neither without isn aren wasn don doesn nicht kein keine keinen nie niemals ne pas jamais sans nunca jamás sin ni".split())
REPORT = frozenset("said says saying quoted quote wrote writes reported claimed alleged called sagte sagt schrieb behauptete zitierte dit disait écrivait cita dijo dice escribió afirmó citó".split())


# ---------------------------------------------------------------- transducers


class Fst(NamedTuple):
    """A deterministic transducer: arcs map (state, symbol) to (state, output)."""

    start: int
    arcs: dict[tuple[int, str], tuple[int, str]]

    def symbols(self) -> set[str]:
        return {s for _, s in self.arcs}

    def outputs(self) -> set[str]:
        return {o for _, o in self.arcs.values()}

    def read(self, symbols: list[str]) -> list[str]:
        state, out = self.start, []
        for s in symbols:
            state, o = self.arcs[state, s]
            out.append(o)
        return out


#: Word classes: other, abusive (i), violent (h), intent (w), target, negation, reporting.
_INPUT = frozenset("oihwtnr")
#: Rewritten: insult, insult upon insult, violence, violence that is intended; in
#: upper case with a target.
_MATCH = "ijhkIJHK"


def _marker(symbols: frozenset[str] | set[str], trigger: str, reach: int, matches: str, mark) -> Fst:
    """Rewrites matches up to `reach` words after a trigger (0: to the clause's end)."""
    arcs = {}
    for state in range(max(1, reach) + 1):
        for s in symbols:
            to = max(1, reach) if s[0] == trigger else state if not reach else max(0, state - 1)
            arcs[state, s] = (to, mark(s) if state and s[0] in matches else s)
    return Fst(0, arcs)


def insult_fst(symbols=_INPUT, reach: int = 3) -> Fst:
    """Abusive words are insults (i); those up to `reach` words after another, insult
    upon insult (j)."""
    return _marker(symbols, "i", reach, "i", lambda s: "j")


def threat_fst(symbols, reach: int = 4) -> Fst:
    """Violent words up to `reach` words after an intent are threats (k)."""
    return _marker(symbols, "w", reach, "h", lambda s: "k")


def negation_fst(symbols, reach: int = 3) -> Fst:
    """Marks matches up to `reach` words after a negation with '-'."""
    return _marker(symbols, "n", reach, _MATCH, lambda s: s + "-")


def report_fst(symbols) -> Fst:
    """Marks matches after a reporting verb of the clause with a quote."""
    return _marker(symbols, "r", 0, _MATCH, lambda s: s + '"')


def target_fst(symbols, reach: int = 4) -> Fst:
    """Raises matches up to `reach` words after a target to upper case."""
    return _marker(symbols, "t", reach, _MATCH, str.upper)


def compose(a: Fst, b: Fst) -> Fst:
    """The transducer that feeds a's output to b."""
    ids, arcs, todo = {(a.start, b.start): 0}, {}, [(a.start, b.start)]
    while todo:
        pair = todo.pop()
        for s in a.symbols():
            to_a, middle = a.arcs[pair[0], s]
            to_b, out = b.arcs[pair[1], middle]
            if (to_a, to_b) not in ids:
                ids[to_a, to_b] = len(ids)
                todo.append((to_a, to_b))
            arcs[ids[pair], s] = (ids[to_a, to_b], out)
    return Fst(0, arcs)


def grammar() -> Fst:
    """All five, composed."""
    whole = insult_fst()
    for part in (threat_fst, negation_fst, report_fst, target_fst):
        whole = compose(whole, part(whole.outputs()))
    return whole


_KINDS = ("insult", "threat")
_OUTCOMES = ("plain", "targeted", "negated", "reported")
OUTCOMES = (*(f"{k}, {o}" for k in _KINDS for o in _OUTCOMES), "stacked", "intended", "clauses", "strongest", "share")


def outcome(symbol: str) -> int:
    """Which sum a rewritten match belongs to: reported before negated before targeted."""
    o = 3 if '"' in symbol else 2 if "-" in symbol else 1 if symbol[0].isupper() else 0
    return o + (len(_OUTCOMES) if symbol[0] in "hkHK" else 0)


def read_clause(tokens: list[str], insult, forth: Fst, back: Fst) -> list[tuple[str, float]]:
    """(rewritten symbol, weight) of the clause's matches, last first."""
    classes, weights = [], []
    for w in tokens:
        weight = insult(w)
        classes.append("i" if weight > 0 else "h" if w in THREAT else "n" if w in NEGATION else "r" if w in REPORT else "t" if w in TARGET else "w" if w in INTENT else "o")
        weights.append(weight if weight > 0 else 1.0)
    read = back.read(forth.read(classes)[::-1])
    return [(s, w) for s, w in zip(read, weights[::-1], strict=True) if s[0] in _MATCH]


class Model(NamedTuple):
    words: dict[str, float]  # insults, whole words
    stems: dict[str, float]  # insults, word beginnings
    weights: list[float]  # of the outcomes
    bias: float


class Scorer:
    """A model made ready: finds lexicon matches, reads only their clauses."""

    def __init__(self, model: Model) -> None:
        import ahocorasick

        self.model, self.forth = model, grammar()
        self.back = target_fst(self.forth.outputs())
        self.find = ahocorasick.Automaton()
        for w in {*model.words, *model.stems, *THREAT}:
            self.find.add_word(w, w)
        if len(self.find):
            self.find.make_automaton()

    def insult(self, word: str) -> float:
        m = self.model
        return max([m.words.get(word, 0.0), *(m.stems.get(word[:k], 0.0) for k in PREFIXES if len(word) >= k)])

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(len(OUTCOMES))
        if not text or not len(self.find):
            return out
        low = text.lower()
        if next(self.find.iter(low), None) is None:
            return out
        words = 0
        begin = 0
        for end in [*(m.end() for m in _CLAUSE.finditer(low)), len(low)]:
            clause = low[begin:end]
            begin = end
            tokens = _WORD.findall(clause)
            words += len(tokens)
            if next(self.find.iter(clause), None) is None:
                continue
            strength = 0.0
            for symbol, weight in read_clause(tokens, self.insult, self.forth, self.back):
                out[outcome(symbol)] += weight
                out[8] += weight * (symbol[0] in "jJ")
                out[9] += weight * (symbol[0] in "kK")
                strength += weight
            if strength:
                out[10] += 1
                out[11] = max(out[11], strength)
        out[12] = 10 * out[:4].sum() / max(words, 1)
        out[:12] = np.log1p(out[:12])
        return out

    def score(self, text: str | None) -> float:
        x = float(self.features(text) @ np.asarray(self.model.weights)) + self.model.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


# -------------------------------------------------------------------- fitting


def terms(text: str) -> set[str]:
    """Words, and beginnings of longer words (written with a star)."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """_text and _y of at most `sample` labelled rows that aren't held out, each
    text once. An id labelled more than once counts with its largest label."""
    own = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).groupBy(key).agg(F.max(label).cast("int").alias("_y"))
    own = own.orderBy(F.xxhash64(key), key).limit(sample).withColumnRenamed(key, "_key")
    rows = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # at most `sample` ids, and of each the one text that is largest by hash
    rows = rows.join(F.broadcast(own), F.col("_id") == F.col("_key")).groupBy("_key").agg(F.max_by(F.struct("_text", "_y"), F.xxhash64("_text")).alias("r")).select("r.*")
    return rows.groupBy(F.xxhash64("_text").alias("_h")).agg(F.max(F.struct("_y", "_text")).alias("r")).select("r._y", "r._text")


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _logistic(rows: list[np.ndarray], cols: int, y: np.ndarray, l1: float, steps: int) -> tuple[np.ndarray, float]:
    """L1-penalised logistic regression on 0/1 incidence, by proximal gradient with
    momentum. rows: the columns that are 1 in each row."""
    n = len(y)
    at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    of = np.repeat(np.arange(n), [len(r) for r in rows])
    base = math.log((y.sum() + 1) / (n - y.sum() + 1))
    w, b = np.zeros(cols), base
    v, c, t = w.copy(), b, 1.0
    rate = 4.0 / max(1.0, np.bincount(of, minlength=n).max(initial=1)) * 1.0
    for _ in range(steps):
        z = np.bincount(of, weights=v[at], minlength=n) + c
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.bincount(at, weights=g[of], minlength=cols)
        scale = rate / max(1.0, np.sqrt(n))
        w2 = np.maximum(0.0, v - scale * (grad + l1))
        b2 = c - rate * g.mean()
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w, b


def _dense_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 60) -> tuple[np.ndarray, float]:
    """Newton's method with a small ridge."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    w[-1] = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    ridge = np.full(a.shape[1], l2)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge * w
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge)
        step = np.linalg.solve(h, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    rows = cut(labelled_sample(docs, labels, label, sample), "toxic")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            for t, y in zip(batch["_text"], batch["_y"], strict=True):
                for term in terms(t):
                    seen[term][y > 0] += 1
        yield pd.DataFrame({"term": list(seen), "clean": [v[0] for v in seen.values()], "toxic": [v[1] for v in seen.values()]})

    sizes = rows.agg(F.count_if(F.col("_y") > 0).alias("t"), F.count_if(F.col("_y") <= 0).alias("c")).first()
    if not sizes.t or not sizes.c:
        return Model({}, {}, [0.0] * len(OUTCOMES), math.log((sizes.t + 0.5) / (sizes.c + 0.5)) if sizes.t + sizes.c else -4.0)
    counts = rows.mapInPandas(count, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (sizes.t + 1)) - F.log((F.col("clean") + 0.5) / (sizes.c + 1))
    # bounded by the sample: each of its texts supports only so many terms
    names = sorted(r.term for r in counts.where((F.col("toxic") >= MIN_DOCS) & (odds >= MIN_WEIGHT)).select("term").collect())
    index = {t: i for i, t in enumerate(names)}

    def incidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"y": batch["_y"], "at": [sorted(index[t] for t in terms(x) if t in index) for x in batch["_text"]]})

    got = rows.mapInPandas(incidence, "y int, at array<int>").toPandas()
    y = (got["y"].to_numpy() > 0).astype(float)
    w, _ = _logistic([np.asarray(a, dtype=np.int64) for a in got["at"]], len(names), y, l1=PENALTY, steps=300)
    words = {t: float(x) for t, x in zip(names, w, strict=True) if x > 0.05 and not t.endswith("*")}
    stems = {t[:-1]: float(x) for t, x in zip(names, w, strict=True) if x > 0.05 and t.endswith("*")}
    lexicon = Model(words, stems, [0.0] * len(OUTCOMES), 0.0)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(lexicon)
        for batch in batches:
            yield pd.DataFrame({"y": batch["_y"], "x": [scorer.features(t).tolist() for t in batch["_text"]]})

    got = rows.mapInPandas(measure, "y int, x array<double>").toPandas()
    x, y = np.array(got["x"].tolist()), (got["y"].to_numpy() > 0).astype(float)
    weights, bias = _dense_logistic(x, y)
    return Model(words, stems, weights.tolist(), bias)


# ------------------------------------------------------------------ operators


def score_column(model: Model, text: str = "text"):
    """A column with the score of each row's whole text."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for batch in batches:
            yield pd.Series([scorer.score(t) for t in batch], dtype="float64")

    return score(F.col(text))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = fit(docs, labels, sample=sample)
    scored = docs.select("doc_id", held_out().alias("held_out"), score_column(model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def reject_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is below the threshold, as they came."""
    model = fit(docs, labels, sample=sample)
    score = unused(docs.columns, "_toxic_score")[0]
    return docs.withColumn(score, score_column(model)).where(F.col(score) < threshold).drop(score)
