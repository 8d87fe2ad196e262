"""Label text: normalization, tokens, identity hashes, validity, repair, similarity.

Column functions stay in the JVM. The Ratcliff-Obershelp ratio and the repair of
label text have no built-in and run as Arrow-batched functions over few rows.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

# Fixed values of the label domain.
STOPWORDS = ("a", "an", "and", "for", "in", "of", "on", "or", "the", "to", "with")
NAME_MAX, DEFINITION_MAX = 80, 500
LABEL_PATTERN = r"^[A-Za-z][A-Za-z0-9 .,()'&/+\-:;]*$"
_SCORES = StructType().add("score", DoubleType()).add("sequence_score", DoubleType()).add("overlap_score", DoubleType())
_LABEL = re.compile(r"[A-Za-z][A-Za-z0-9 .,()'&/+\-:;]*")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------- columns


def normalize_text(c: str | Column) -> Column:
    """Lower case, white space collapsed. Exact for label text, which is ASCII."""
    return F.trim(F.regexp_replace(F.lower(_col(c)), r"(?U)\s+", " "))


def name_tokens(c: str | Column) -> Column:
    """Sorted distinct informative tokens of a name."""
    plain = F.regexp_replace(F.replace(F.lower(_col(c)), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")
    words = F.array_remove(F.split(plain, " "), "")
    return F.array_sort(F.array_distinct(F.array_except(words, F.array(*map(F.lit, STOPWORDS)))))


def is_blank(c: str | Column) -> Column:
    return F.coalesce(~_col(c).rlike(r"(?U)\S"), F.lit(True))


def strip(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+\z", "")


def valid_label(name: str | Column, definition: str | Column) -> Column:
    """Whether both, stripped, have an allowed length and only allowed characters."""
    pattern = LABEL_PATTERN[:-1] + r"\z"
    n, d = strip(name), strip(definition)
    return F.coalesce(n.rlike(pattern) & d.rlike(pattern) & (F.length(n) <= NAME_MAX) & (F.length(d) <= DEFINITION_MAX), F.lit(False))


def _digest(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\0", *parts), 256), 1, 20))


def proposal_id(doc_id: str | Column, index: str | Column, name: str | Column, definition: str | Column) -> Column:
    """Identity of one proposal: of its document, place and raw text."""
    return _digest("P_", _col(doc_id).cast("string"), _col(index).cast("string"), _col(name), _col(definition))


def proposal_group_id(name: str | Column, definition: str | Column) -> Column:
    """Identity of what is proposed: of the normalized text."""
    return _digest("G_", normalize_text(name), normalize_text(definition))


def threshold_label(c: str | Column) -> Column:
    """Three decimals without trailing zeros."""
    return F.regexp_replace(F.format_string("%.3f", _col(c).cast("double")), r"\.?0+\z", "")


def format_duration(seconds: str | Column) -> Column:
    """1h 2m 3s; leading units that are 0 are left out."""
    s = F.greatest(F.lit(0), _col(seconds).cast("long"))
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return (
        F.when(h > 0, F.format_string("%dh %dm %ds", h, m, s % 60))
        .when(m > 0, F.format_string("%dm %ds", m, s % 60))
        .otherwise(F.format_string("%ds", s % 60))
    )


def label_code(number: str | Column) -> Column:
    return F.format_string("L%03d", _col(number).cast("int"))


def overlap_score(left: str | Column, right: str | Column) -> Column:
    """Shared tokens over the smaller token set; 0 below two shared ones."""
    shared = F.size(F.array_intersect(_col(left), _col(right)))
    least = F.least(F.size(_col(left)), F.size(_col(right)))
    return F.when(shared >= 2, shared / least).otherwise(F.lit(0.0))


# -------------------------------------------------------------------- python


def normalized(value: str) -> str:
    return " ".join(value.casefold().split())


def token_list(value: str) -> list[str]:
    return sorted(set(re.findall(r"[a-z0-9]+", value.casefold().replace("&", " and "))) - set(STOPWORDS))


def _matched(a: str, b: str) -> int:
    """Letters in the matching blocks of two strings: the longest block that both have
    (the first in a, then the first in b), and the same on both sides of it. Whether
    there is a block of a length is asked of the string search, by bisection."""
    low, high, at = 0, min(len(a), len(b)), 0
    while low < high:
        size = (low + high + 1) // 2
        found = next((i for i in range(len(a) - size + 1) if a[i : i + size] in b), -1)
        if found < 0:
            high = size - 1
        else:
            low, at = size, found
    if not low:
        return 0
    there = b.index(a[at : at + low])
    return low + _matched(a[:at], b[:there]) + _matched(a[at + low :], b[there + low :])


def ratio(a: str, b: str) -> float:
    """The Ratcliff-Obershelp ratio, as difflib has it. From 200 letters on difflib sets
    frequent letters aside, so such strings are left to it."""
    if len(b) >= 200:
        return SequenceMatcher(None, a, b).ratio()
    return 2.0 * _matched(a, b) / (len(a) + len(b)) if a or b else 1.0


def similarity(left: str, right: str) -> tuple[float, float, float]:
    """(score, sequence score, overlap score) of two names, in this order: the
    sequence ratio isn't symmetric."""
    a, s, x = _prepared(left)
    b, t, y = _prepared(right)
    if a == b:
        return 1.0, 1.0, float(bool(s and t))
    if not s or not t:
        near = ratio(a, b)
        return near, near, 0.0
    near, shared = ratio(x, y), len(s & t)
    overlap = shared / min(len(s), len(t)) if shared > 1 else 0.0
    return max(near, overlap), near, overlap


@lru_cache(1 << 15)
def _prepared(name: str) -> tuple[str, frozenset[str], str]:
    """A name's plain text, its tokens, and these as text: each name is in many pairs."""
    tokens = token_list(name)
    return normalized(name).replace("&", " and "), frozenset(tokens), " ".join(tokens)


#: Letters of tokens joined by blanks; a name of up to 64 of them fits one word of bits.
_ALPHABET, _BITS = b"abcdefghijklmnopqrstuvwxyz0123456789 ", 64
_CODES = np.full(256, len(_ALPHABET), np.uint8)
_CODES[np.frombuffer(_ALPHABET, np.uint8)] = np.arange(len(_ALPHABET))


def _many_matched(texts: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """_matched(texts[a], texts[b]) of many pairs at once. Bit j of a place i says that a
    run of letters ends at i in one text and j in the other; runs of one letter more are
    those that follow a run. All stretches left of all pairs take a step together."""
    size = np.array([len(t) for t in texts])
    wide = int(size.max(initial=1))
    codes = _CODES[np.frombuffer(b"".join(t.encode().ljust(wide, b"\0") for t in texts), np.uint8).reshape(len(texts), wide)]
    has = np.zeros((len(texts), len(_ALPHABET) + 1), np.uint64)
    every = np.arange(len(texts))
    for j in range(wide):
        has[every, codes[:, j]] |= np.uint64(1 << j)
    has[:, -1] = 0
    one, total = np.uint64(1), np.zeros(len(a), np.int64)
    low_bits = np.concatenate([(one << np.arange(_BITS, dtype=np.uint64)) - one, [~np.uint64(0)]])  # the lowest k
    pair, from_a, to_a, from_b, to_b = np.arange(len(a)), np.zeros(len(a), np.int64), size[a], np.zeros(len(a), np.int64), size[b]
    while len(pair):
        width = to_a - from_a
        order = np.argsort(width, kind="stable")
        pair, from_a, to_a, from_b, to_b, width = (x[order] for x in (pair, from_a, to_a, from_b, to_b, width))
        length, last_a, last_b = (np.zeros(len(pair), np.int64) for _ in range(3))
        cuts = [0, *np.searchsorted(width, (4, 8, 12, 16, 20, 24, 28, 32, 40, 48), "right"), len(pair)]
        for k, z in zip(cuts, cuts[1:], strict=False):
            if k == z:
                continue
            places = from_a[k:z, None] + np.arange(width[z - 1])
            letters = codes[a[pair[k:z]][:, None], np.minimum(places, wide - 1)]
            letters[places >= to_a[k:z, None]] = len(_ALPHABET)
            single = has[b[pair[k:z]][:, None], letters] & (low_bits[to_b[k:z]] & ~low_bits[from_b[k:z]])[:, None]
            rows, run, now, long = np.arange(k, z), single, single, 0
            while len(rows):
                alive = now.any(axis=1)
                if not alive.all():
                    gone = np.flatnonzero(~alive)
                    if long:
                        ends = run[gone]
                        first = (ends != 0).argmax(axis=1)
                        ends = ends[np.arange(len(gone)), first]
                        length[rows[gone]], last_a[rows[gone]] = long, first
                        last_b[rows[gone]] = np.frexp((ends & (~ends + one)).astype(np.float64))[1] - 1
                    rows, now, single = rows[alive], now[alive], single[alive]
                run, long = now, long + 1
                now = np.zeros_like(run)
                np.bitwise_and(single[:, 1:], run[:, :-1] << one, out=now[:, 1:])
        some = np.flatnonzero(length)
        pair, from_a, to_a, from_b, to_b, length = (x[some] for x in (pair, from_a, to_a, from_b, to_b, length))
        end_a, end_b = from_a + last_a[some] + 1, last_b[some] + 1
        np.add.at(total, pair, length)
        both = [np.concatenate(x) for x in ((pair, pair), (from_a, end_a), (end_a - length, to_a), (from_b, end_b), (end_b - length, to_b))]
        left = (both[1] < both[2]) & (both[3] < both[4])
        pair, from_a, to_a, from_b, to_b = (x[left] for x in both)
    return total


def _common_letters(texts: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Letters that texts[a] and texts[b] share in any order: no fewer than match."""
    own = np.array([np.bincount(_CODES[np.frombuffer(t.encode(), np.uint8)], minlength=len(_ALPHABET)) for t in texts], np.uint8)
    return np.minimum(own[a], own[b]).sum(axis=1, dtype=np.int64)


def similarities(names: list[str], left: np.ndarray, right: np.ndarray, least: float = 0.0) -> np.ndarray:
    """similarity(names[left], names[right]) of many pairs: a row for each of the three.
    Pairs whose letters, whatever their order, rule out a score of `least` have -1."""
    plain, tokens, joined = zip(*map(_prepared, names), strict=True) if names else ((), (), ())
    index = {t: i for i, t in enumerate({t for own in tokens for t in own})}
    most = max(map(len, tokens), default=0)
    held = np.full((len(names), most), -1, np.int64)
    for i, own in enumerate(tokens):
        held[i, : len(own)] = [index[t] for t in own]
    count, size = np.array([len(t) for t in tokens], np.int64), np.array([len(x) for x in joined], np.int64)
    texts = {t: i for i, t in enumerate(dict.fromkeys(plain))}
    same = np.array([texts[t] for t in plain], np.int64)
    short = (count > 0) & (size <= _BITS)
    quick = short[left] & short[right] & (same[left] != same[right])
    out = np.empty((3, len(left)))
    a, b = left[quick], right[quick]
    if len(a):
        texts = [x if ok else "" for x, ok in zip(joined, short, strict=True)]
        shared = sum(((held[a, k, None] == held[b]) & (held[a, k, None] >= 0)).any(axis=1).astype(np.int64) for k in range(most))
        overlap = np.where(shared > 1, shared / np.minimum(count[a], count[b]), 0.0)
        near = np.full(len(a), -1.0)
        open_ = np.flatnonzero((overlap >= least) | (2.0 * _common_letters(texts, a, b) / (size[a] + size[b]) >= least)) if least > 0 else np.arange(len(a))
        near[open_] = 2.0 * _many_matched(texts, a[open_], b[open_]) / (size[a[open_]] + size[b[open_]])
        out[:, quick] = np.where(near < 0, -1.0, np.maximum(near, overlap)), near, np.where(near < 0, -1.0, overlap)
    for i in np.flatnonzero(~quick):
        out[:, i] = similarity(names[left[i]], names[right[i]])
    return out


def name_similarity(left: str | Column, right: str | Column, least: float = 0.0) -> Column:
    """score, sequence_score and overlap_score; -1 where a score of `least` is ruled out."""

    @F.arrow_udf(_SCORES)
    def scores(left: pa.Array, right: pa.Array) -> pa.Array:
        coded = pa.concat_arrays([left, right]).dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        rows = similarities(coded.dictionary.to_pylist(), at[: len(left)], at[len(left) :], least)
        return pa.StructArray.from_arrays([pa.array(r) for r in rows], ["score", "sequence_score", "overlap_score"])

    return scores(left, right)


def repair_label_text(value: object, most: int, least: int = 1) -> str | None:
    """Text that fits the label pattern, or None. One character whose removal mends
    the text goes (the first such); where none does, the leading one goes, again
    and again."""
    if not isinstance(value, str):
        return None
    text = value.strip()[:most]
    while len(text) >= least and not _LABEL.fullmatch(text):
        shorter = (text[:i] + text[i + 1 :] for i in range(len(text)))
        text = next((t for t in shorter if len(t) >= least and _LABEL.fullmatch(t)), text[1:])
    return text if len(text) >= least and _LABEL.fullmatch(text) else None


@F.pandas_udf(StringType())
def repair_name(values: pd.Series) -> pd.Series:
    return values.map(lambda v: repair_label_text(v, NAME_MAX))


def fix_output(assigned: list[str] | None, proposed: list[dict] | None) -> tuple[list[str], list[dict]]:
    """A labeler's output with repeated ids, unmendable proposals and proposals of
    the same normalized text taken out (the first stays)."""
    seen: set[tuple[str, str]] = set()
    kept = []
    for p in proposed or []:
        if not isinstance(p, dict):
            raise TypeError("a proposed label must be an object")
        name = repair_label_text(p.get("name"), NAME_MAX)
        definition = repair_label_text(p.get("definition"), DEFINITION_MAX)
        if name is None or definition is None or set(p) - {"name", "definition"}:
            continue
        signature = normalized(name), normalized(definition)
        if signature not in seen:
            seen.add(signature)
            kept.append({"name": name, "definition": definition})
    return list(dict.fromkeys(assigned or [])), kept


def seconds_text(seconds: float) -> str:
    s = max(0, int(seconds))
    h, m = s // 3600, s % 3600 // 60
    return f"{h}h {m}m {s % 60}s" if h else f"{m}m {s % 60}s" if m else f"{s}s"


def threshold_text(value: float) -> str:
    return f"{value:.3f}".rstrip("0").rstrip(".")


def truncate(text: str, limit: int, encode=str.split, decode=" ".join, cost=len, budget: int | None = None, suffix: str = "\n[TRUNCATED]") -> str:
    """The text if it has at most `limit` tokens and fits the budget; else its
    longest beginning of tokens that does (found by bisection), and a suffix."""
    tokens = encode(text)
    fits = lambda t: budget is None or cost(t) <= budget
    if len(tokens) <= limit and fits(tokens):
        return text
    low, high = 0, min(limit, len(tokens))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if fits(tokens[:middle]) else (low, middle - 1)
    if low == 0:
        raise ValueError("not even one token fits the prompt")
    return decode(tokens[:low]) + suffix
