"""Secrets in texts: fixed patterns plus a token-efficiency test (op10).

Random strings take far more tokens than words: under a byte-pair vocabulary prose
has some four characters to a token, a random key less than two. Candidates are
long runs of key characters; known digests, UUIDs, numbers and what splits into
words (by case, dash, underscore or slash) are set aside, and those with few
characters to a token become spans of kind `random`, beside those of the fixed
patterns. Where a run as a whole doesn't, its densest stretches are tried, so that a
path before a key doesn't hide it.

Defined results: null and empty texts have no spans; positions are code points,
ends exclusive; spans that are equal to or within one of the fixed patterns' are
not given again; rows are independent, so repeated rows give repeated results;
only doc_id and text are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: The patterns of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MAX_CHARS_PER_TOKEN = 2.0
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
_HEX_ANY = re.compile(r"[0-9a-fA-F]+")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_SET_ASIDE = re.compile(rf"(?<![A-Za-z0-9])(?:{_UUID.pattern}|[0-9a-fA-F]+)(?![A-Za-z0-9])")
_SEPARATORS = "/_=+-"
SHORTEST = 20


def default_vocabulary() -> str:
    """The file in the folder of public vocabularies; any other path can be given."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_vocabulary(path: str) -> tuple[bytes, str]:
    """A .tiktoken file's bytes and the pattern that splits texts before it."""
    import public_tokenizers

    with open(path, "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def encoding(vocabulary: tuple[bytes, str]):
    """How many tokens a string takes under these ranks."""
    import tiktoken

    data, pattern = vocabulary
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str):
    return encoding(read_vocabulary(path))


def known(run: str, tokens, most: float = MAX_CHARS_PER_TOKEN) -> bool:
    """Digests, UUIDs, numbers and words however joined."""
    if _HEX_ANY.fullmatch(run) and len(run) in _DIGEST_LENGTHS or _UUID.fullmatch(run):
        return True
    if not any(c.isalpha() for c in run):
        return True
    if sum(c.isdigit() for c in run) > 4:
        return False
    words = [w.lower() for w in _WORDS.findall(run)]
    return sum(map(len, words)) > most * sum(len(tokens.encode_ordinary(w)) for w in words)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns, leftmost and non-overlapping for each kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def dense_stretches(run: str, tokens, most: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int]]:
    """Stretches of a run with few characters to a token: those of the best sum when a
    token counts `most` less its characters, then those on either side of them."""
    lengths = [len(tokens.decode_single_token_bytes(t)) for t in tokens.encode_ordinary(run)]
    at = [0]
    for n in lengths:
        at.append(at[-1] + n)
    out, todo = [], [(0, len(lengths))]
    while todo:
        lo, hi = todo.pop()
        if at[hi] - at[lo] < SHORTEST:
            continue
        total, begin, best, a, z = 0.0, lo, 0.0, lo, lo
        for i in range(lo, hi):
            if total <= 0:
                total, begin = 0.0, i
            total += most - lengths[i]
            if total > best:
                best, a, z = total, begin, i + 1
        if best <= 0:
            continue
        todo += [(lo, a), (z, hi)]
        # to the borders of the pieces it lies in, where that stays dense
        s, e = at[a], at[z]
        while s < e and run[s] in _SEPARATORS:
            s += 1
        left = max(run.rfind(c, at[lo], s) for c in _SEPARATORS) + 1
        right = min([p for c in _SEPARATORS if (p := run.find(c, e, at[hi])) >= 0], default=at[hi])
        for x, y in ((max(left, at[lo]), right), (max(left, at[lo]), e), (s, right), (s, e)):
            piece = run[x:y]
            x, y = x + len(piece) - len(piece.lstrip(_SEPARATORS)), y - (len(piece) - len(piece.rstrip("/_+-")))
            if y - x >= SHORTEST and y - x <= most * len(tokens.encode_ordinary(run[x:y])):
                if not known(run[x:y].strip(_SEPARATORS), tokens, most):
                    out.append((x, y))
                break
    return sorted(out)


def random_spans(text: str, base: list[tuple[int, int, str]], tokens, most: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int, str]]:
    found = []
    for m in CANDIDATE.finditer(text):
        run = m[0].strip(_SEPARATORS)
        if len(run) < SHORTEST or known(run, tokens, most) and _SET_ASIDE.fullmatch(run):
            continue
        if any(a <= m.start() and m.end() <= b for a, b, _ in base):
            continue
        # digests and UUIDs within a run part it
        cuts, begin = [], 0
        for k in _SET_ASIDE.finditer(m[0]):
            if known(k[0], tokens, most) and not k[0].isdigit() and len(k[0]) >= SHORTEST:
                cuts.append((begin, k.start()))
                begin = k.end()
        if not cuts and not known(run, tokens, most) and len(m[0]) <= most * len(tokens.encode_ordinary(m[0])):
            found.append((m.start(), m.end(), "random"))
            continue
        for a, b in [*cuts, (begin, len(m[0]))]:
            for x, y in dense_stretches(m[0][a:b], tokens, most):
                x, y = m.start() + a + x, m.start() + a + y
                if not any(p <= x and y <= q for p, q, _ in base):
                    found.append((x, y, "random"))
    return found


def scan_secrets(docs: DataFrame, vocabulary: str | None = None, most: float = MAX_CHARS_PER_TOKEN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans: an array of (kind, start, end, value) in order of start."""
    # the driver reads the file: the functions below carry it
    words = read_vocabulary(vocabulary or default_vocabulary())

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = encoding(words)
        for batch in batches:
            out = []
            for t in batch["text"]:
                t = t or ""
                base = base_spans(t)
                both = sorted([*base, *random_spans(t, base, tokens, most)], key=lambda s: (s[0], KINDS.index(s[2])))
                out.append([{"kind": k, "start": a, "end": b, "value": t[a:b]} for a, b, k in both])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": out})

    rows = docs.selectExpr(f"cast(`{key}` as string) doc_id", f"`{text}` text")
    found = rows.mapInPandas(scan, "doc_id string, spans array<struct<kind:string,start:long,end:long,value:string>>")
    return found.selectExpr(f"cast(doc_id as {docs.schema[key].dataType.simpleString()}) doc_id", "spans")


def secret_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (as text)."""
    found = scan_secrets(docs, **options)
    written = lambda spans: f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    count = lambda k: f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint) n_{k}"
    return found.selectExpr("doc_id", count("assign"), count("access"), count("hex"), f"sha2({written("filter(spans, s -> s.kind <> 'random')")}, 256) base_sha256", f"{written('spans')} spans", count("random"))
