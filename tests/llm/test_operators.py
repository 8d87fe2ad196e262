"""Small fixtures for every operator: nulls, empty and long texts, ties, repeated
rows, empty tables, clashing columns; results against brute force."""

import io
import itertools
import random
import re
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborlex.llm import chaining, common, decontaminate, hnsw, jaccard, mixing, quality, secrets, sharding, toxicity, warc
from arborlex.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, fp string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def changed(rng, text, every):
    w = text.split()
    for i in range(0, len(w), every):
        w[i] = prose(rng, 1)
    return " ".join(w)


def corpus(seed=3, n=12):
    """Originals, exact and near copies, and odd rows."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        t = prose(rng, rng.randint(8, 90))
        texts += [t, t.upper()] + [changed(rng, t, k) for k in (7, 40, 60)]
    texts += [None, "", " \t\n", "one", "one", "One  two three", "one two three", "x " * 300, "y " * 5, prose(rng, 3000)]
    rows = [(i, t, "en", f"s{i % 3}" if i % 11 else None, len(t or ""), "own", "own") for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[-10], (None, texts[0], "en", "s0", 0, "own", "own")]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def texts_frame(spark, texts):
    return frame(spark, [(i, t, "en", "s", 0, "own", "own") for i, t in enumerate(texts)])


# ------------------------------------------------------------------- common


def test_tokenizer_finds_the_words():
    texts = ["A b\tC", None, "", "  x\x0bé y ", "b"]
    h, at = common.token_hashes(texts)
    words = [WORD.findall((t or "").replace("A", "a").replace("C", "c")) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(h)) for j in range(len(h)))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ----------------------------------------------------------------- sharding


def test_shards(spark):
    rows = corpus()
    out = sharding.shard_digest(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in sorted(out, key=lambda r: (r.shard, r.slot)):
        by.setdefault(r.shard, []).append(r)
    assert all([r.slot for r in rs] == list(range(len(rs))) for rs in by.values())
    order = [-1 if r.doc_id is None else r.doc_id for s in sorted(by) for r in by[s]]
    assert order == sorted(order)
    total, largest = sum(r.size for r in out), max(r.size for r in out)
    assert all(abs(sum(r.size for r in by.get(s, [])) - total / 16) <= largest for s in range(16))
    full = sharding.shard_documents(frame(spark, rows))
    assert full.count() == len(rows) and full.where("shard is null").count() == 0
    assert sharding.shard_digest(empty(spark)).count() == 0 == sharding.shard_documents(empty(spark)).count()


# ------------------------------------------------------------------- mixing


def targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    capped, left = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= most * sizes[s]]
        if not over:
            return capped | share
        for s in over:
            capped[s] = float(most * sizes[s])
        left = sum(sizes.values()) - sum(capped.values())


def test_mix(spark):
    rows = corpus(n=40) + [(900 + i, "few words here", "en", "tiny", 0, "own", "own") for i in range(3)]
    out = mixing.mix_digest(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    again = mixing.mix_digest(frame(spark, rows).repartition(3)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    want = targets(sizes)
    for s, size in sizes.items():
        own = [r for r in out if r.source == s]
        assert {r.source_size for r in own} == {size}
        assert all(abs(r.target - want[s]) < 1e-6 * max(1, want[s]) for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= max(r.size for r in own)
    assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in out)
    mixed = mixing.mix_documents(frame(spark, rows)).where("text is not null")
    assert mixed.columns == frame(spark, rows).columns
    assert sum(len(WORD.findall(r.text)) for r in mixed.collect()) == sum(r.taken for r in out)
    assert mixing.mix_digest(empty(spark)).count() == 0


def test_rounding_keeps_words_and_expectations(spark):
    taken = np.zeros(60)
    rows = [(i, "w " * (i % 7 + 1), "en", f"s{i % 2}", 0, "", "") for i in range(60)]
    for seed in range(6):
        mixing.SEED = seed
        taken += [r.copies for r in mixing.mix_digest(frame(spark, rows), fan=8).orderBy("doc_id").collect()]
    mixing.SEED = 17
    mean = taken.reshape(30, 2).mean(0) / 6
    assert abs(mean[0] - 2 / 3) < 0.1 and abs(mean[1] - 4 / 3) < 0.1


# --------------------------------------------------------------------- warc


def reader(data):
    return lambda offset, n: data[offset : offset + n]


@pytest.mark.parametrize("zip64", [False, True])
def test_directory_of_other_writers(zip64):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        with z.open(zipfile.ZipInfo("a/x.bin"), "w", force_zip64=zip64) as f:
            f.write(b"hello")
        z.writestr("é.txt", "b" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 in a comment"
    data = out.getvalue()
    a, b = warc.members(reader(data), len(data))
    at = warc.data_offset(reader(data), a)
    assert (a.name, b.name, data[at : at + a.stored]) == ("a/x.bin", "é.txt", b"hello")
    with pytest.raises(ValueError, match="compressed"):
        warc.data_offset(reader(data), b)
    with pytest.raises(ValueError, match="no end"):
        warc.members(reader(data[: len(data) - 60]), len(data) - 60)


def test_zip64_directory():
    """More than 65,535 members: the end record overflows into its ZIP64 form."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(65_540):
            z.writestr(zipfile.ZipInfo(f"{i}"), b"")
    data = out.getvalue()
    found = warc.members(reader(data), len(data))
    assert len(found) == 65_540 and found[-1].name == "65539"


def test_archives_round_trip(spark):
    pages = [(1, "http://a", "same"), (5, "http://b", "same"), (3, None, "same"), (2, "u", None), (4, "u\r\nX: y", ""), (6, "é", "ü" * 50_000), (7, "x", "x"), (7, "x", "x"), (None, "n", "null id")]
    df = spark.createDataFrame([(*p, "own") for p in pages], "page_id long, url string, html string, payload string")
    out = warc.archive_pages(spark, df).collect()
    assert len(out) == len(pages)
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in out), key=str)
    want = [(1, "revisit", 5), (5, "response", None), (3, "revisit", 5), (2, "revisit", 4), (4, "response", None), (6, "response", None), (7, "response", None), (7, "revisit", 7), (None, "response", None)]
    assert got == sorted(want, key=str)
    html = {p[0]: (p[2] or "").encode() for p in pages}
    for r in out:
        assert (r.payload_bytes, r.payload_digest) == (len(html[r.page_id]), warc.sha1_base32(html[r.page_id]))
        assert r.payload is None or bytes(r.payload) == html[r.page_id]
    assert warc.archive_pages(spark, df.limit(0)).count() == 0


# ------------------------------------------------------------------ secrets


def test_secrets(spark):
    key = "q7Zx9Kp2Vb4Nc8Lm3Rt6Yw1Qs5Hd0Jf"
    texts = [None, "", f"é token = \"{'a1' * 20}\" end", "AKIA" + "Z" * 12 + " AKIAZ", "token=secret: 12345678", "Password:abcdefgh passwd = short", f"see {key} here", "0123456789abcdef0123456789abcdef01234567", "a_long_identifier_name_2024 1b4e28ba-2fa1-11d2-883f-0016d3cca427", "Thequickbrownfoxjumpsoverlazydogs", key]
    rows = secrets.secret_digest(texts_frame(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_assign, r.n_access, r.n_hex, r.n_random) for r in rows] == [(0, 0, 0, 0)] * 2 + [(1, 0, 1, 0), (0, 1, 0, 0), (0, 0, 0, 0), (1, 0, 0, 0), (0, 0, 0, 1), (0, 0, 1, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 1)]
    assert rows[2].spans == "assign:2:51,hex:11:51" and rows[6].spans == f"random:4:{4 + len(key)}"
    assert secrets.secret_digest(empty(spark)).count() == 0


def _random_share(make, n=200):
    tokens, rng, hit = secrets.encoder(secrets.default_vocabulary()), random.Random(4), 0
    for _ in range(n):
        before, key = make(rng)
        spans = secrets.random_spans(f"see {before}{key} here", [], tokens)
        a = 4 + len(before)
        # most of the key is covered
        hit += any(min(y, a + len(key)) - max(x, a) >= 0.8 * len(key) for x, y, _ in spans)
    return hit / n


ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


@pytest.mark.parametrize("path", ["services/internal/production/config/", "/var/lib/application/storage/customers/documents/", "callback/session/identifier/"])
def test_keys_behind_a_path(path):
    assert _random_share(lambda rng: (path, "".join(rng.choices(ALNUM, k=24)))) >= 0.95


@pytest.mark.parametrize("n", [20, 32])
def test_keys_of_letters(n):
    assert _random_share(lambda rng: ("", "".join(rng.choices(ALNUM[:52], k=n)))) >= 0.95
    assert _random_share(lambda rng: ("", "".join(rng.choices(ALNUM[26:52], k=n)))) >= 0.9
    tokens = secrets.encoder(secrets.default_vocabulary())
    for words in ("services/internal/production/config/documents", "INTERNATIONALIZATION_SETTINGS", "getDefaultApplicationContextFactory", "/users/1b4e28ba-2fa1-11d2-883f-0016d3cca427/documents"):
        assert secrets.random_spans(words, [], tokens) == []


# ----------------------------------------------------------------- toxicity


def test_grammar():
    def read(kinds):
        state, out = 0, []
        for k in kinds:
            state, symbol = toxicity.grammar().arcs[state, k]
            out.append(symbol)
        return out

    assert read("oi") == ["o", "i"]
    assert read("toi") == ["t", "o", "I"]
    assert read("ni") == ["n", "i-"]
    assert read("nooooi")[-1] == "i"
    assert read("roooooi")[-1] == 'i"'
    assert read("tnri")[-1].startswith("I") and toxicity.outcome(read("tnri")[-1]) == 3


def test_clauses_by_brute_force():
    forth = toxicity.grammar()
    back = toxicity.target_fst(forth.outputs())
    rng = random.Random(5)
    for _ in range(400):
        kinds = [rng.choice("ooooihwtnr") for _ in range(rng.randint(0, 14))]
        got = back.read(forth.read(kinds)[::-1])[::-1]
        for i, (k, symbol) in enumerate(zip(kinds, got, strict=True)):
            if k not in "ih":
                assert symbol == k
                continue
            near = lambda c, n: c in kinds[max(0, i - n) : i]  # noqa: B023, E731
            letter = {"i": "j" if near("i", 3) else "i", "h": "k" if near("w", 4) else "h"}[k]
            letter = letter.upper() if near("t", 4) or "t" in kinds[i + 1 : i + 5] else letter
            assert symbol == letter + "-" * near("n", 3) + '"' * ("r" in kinds[:i])


def test_threats_count_for_what_their_clause_makes_of_them():
    weights = [0.0] * len(toxicity.OUTCOMES)
    for name, w in {"threat, plain": 1.0, "threat, targeted": 3.0, "threat, negated": -1.0, "threat, reported": -2.0, "intended": 0.5}.items():
        weights[toxicity.OUTCOMES.index(name)] = w
    s = toxicity.Scorer(toxicity.Model({}, {}, weights, 0.0))
    scores = [s.score(t) for t in ("I will kill you", "to kill time", "I will not kill anyone", "he said kill", "a fine day")]
    assert len({round(x, 6) for x in scores}) == 5 and scores[0] == max(scores) and scores[3] == min(scores)


def test_toxicity_is_learned(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out")
    r = out.agg(F.sum(F.expr("int(toxic = 1 and predicted = 1)")).alias("tp"), F.sum(F.expr("int(toxic = 1)")).alias("t"), F.sum("predicted").alias("p")).first()
    assert r.tp / r.t > 0.85 and r.tp / r.p > 0.85


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_toxic_rows_that_are_held_out_rank_above_clean_ones(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").select("score", "toxic").toPandas()
    ranks, many = rows.score.rank()[rows.toxic == 1], int((rows.toxic == 1).sum())
    assert (ranks.sum() - many * (many + 1) / 2) / (many * (len(rows) - many)) > 0.95


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(40)], "doc_id long, toxic int")
    rows = [(i, f"you are a gronk today {i}" if i % 2 == 0 else f"a fine day {i}", "en", "s", 0, "", "") for i in range(40)]
    rows += [(None, None, "en", "s", 0, "", ""), (41, "", "en", "s", 0, "", ""), (42, "gronk " * 5000, "en", "s", 0, "", "")]
    out = {r.doc_id: r for r in toxicity.toxicity(frame(spark, rows), labels).collect()}
    assert out[2].predicted == 1 and out[3].predicted == 0 and out[42].predicted == 1
    assert out[None].score == out[41].score and out[None].held_out is False
    none = toxicity.toxicity(frame(spark, rows), labels.limit(0)).collect()
    assert len({r.score for r in none}) == 1
    assert toxicity.reject_toxic(frame(spark, rows), labels).columns == frame(spark, rows).columns
    assert toxicity.toxicity(empty(spark), labels).count() == 0


# ------------------------------------------------------------------ jaccard


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


@pytest.mark.parametrize(("seed", "hot"), [(3, jaccard.HOT), (4, 1)])
def test_jaccard_components(spark, seed, hot):
    rng = random.Random(seed)
    rows = corpus(seed)
    base = prose(rng, 60)  # a crowd of copies of one text, and a passage that others share
    rows += [(500 + i, changed(rng, base, rng.choice((11, 17, 25))), "en", "s", 0, "", "") for i in range(25)]
    rows += [(600 + i, base + " " + prose(rng, rng.randint(5, 40)), "en", "s", 0, "", "") for i in range(20)]
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = list(range(len(rows)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i, j in itertools.combinations(range(len(rows)), 2):
        if linked(sets[i][1], sets[j][1]):
            parent[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    want = sorted(str((d, len(s), least.get(find(i)))) for i, (d, s) in enumerate(sets))
    got = sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in jaccard.similar_components(frame(spark, rows), hot=hot).collect())
    assert got == want
    kept = jaccard.one_of_each(frame(spark, [r for r in rows if r[0] is not None]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({least[find(i)] for i, (d, _) in enumerate(sets) if d is not None} | {d for d, s in sets if not s and d is not None})


def test_jaccard_of_nothing(spark):
    assert jaccard.similar_components(empty(spark)).count() == 0


# ---------------------------------------------------------- decontamination


def test_decontamination(spark):
    rng = random.Random(7)
    items = [prose(rng, n) for n in (30, 20, 8, 4)] + [None, ""]
    swap = lambda t, at: " ".join(prose(rng, 1) if i in at else w for i, w in enumerate(t.split()))
    texts = [
        prose(rng, 50) + " " + items[0].upper() + ". " + prose(rng, 9), swap(items[0], {4, 9, 14, 19, 24}), " ".join(items[0].split()[5:20]), swap(items[1], {3, 10}),
        prose(rng, 200), " ".join(items[0].split()[:6]) + " " + prose(rng, 30), items[2], items[3], None, "", prose(rng, 3000) + " " + items[1],
    ]
    bench = spark.createDataFrame([(i, t, 0) for i, t in enumerate(items)] + [(9, items[0], 0)], "item_id long, text string, doc_id long")
    out = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(texts_frame(spark, texts), bench).collect()}
    assert out == {(0, 0), (1, 0), (2, 0), (3, 1), (6, 2), (10, 1)}
    kept = decontaminate.drop_contaminated(texts_frame(spark, texts), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 7, 8, 9] and kept.columns == texts_frame(spark, texts).columns
    assert decontaminate.overlaps(empty(spark), bench).count() == 0
    assert decontaminate.overlaps(texts_frame(spark, texts), bench.limit(0)).count() == 0


def test_all_matches_beside_a_substitution_count(spark):
    rng = random.Random(9)
    items = [prose(rng, n) for n in (20, 15, 25)]
    swap = lambda t, at: " ".join(prose(rng, 1) if i in at else w for i, w in enumerate(t.split()))
    texts = [swap(items[0], {2, 15}), swap(items[1], {2}), swap(items[2], range(10, 15))]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    out = {(r.doc_id, r.item_id): r.matched for r in decontaminate.overlaps(texts_frame(spark, texts), bench).collect()}
    assert out == {(0, 0): 18, (1, 1): 14, (2, 2): 20}


def _laid(text, item):
    """Brute force: the most equal words of any diagonal's stretch with at most one
    other word to three equal ones, and whether some spaced seed lies on it."""
    w, v = (re.findall(r"\w+", x.lower()) for x in (text, item))
    best = 0
    for d in range(-len(v) + 1, len(w)):
        same = [int(0 <= d + j < len(w) and w[d + j] == x) for j, x in enumerate(v)]
        if not any(all(same[a + i] for i, bit in enumerate(m) if bit == "1") for m in decontaminate.MASKS for a in range(len(v) - len(m) + 1)):
            continue
        sums = list(itertools.accumulate(same, initial=0))
        best = max([best, *(sums[z] - sums[a] for a in range(len(v)) for z in range(a + 1, len(v) + 1) if 4 * (sums[z] - sums[a]) >= 3 * (z - a))])
    return best


def test_decontamination_by_brute_force(spark):
    rng = random.Random(21)
    items = [prose(rng, rng.randint(6, 30)) for _ in range(12)]
    texts = []
    for share in (0.0, 0.1, 0.2, 0.3):
        for t in items:
            some = " ".join(prose(rng, 1) if rng.random() < share else w for w in t.split()[rng.choice([0, 0, 3]) :])
            texts.append(" ".join((prose(rng, rng.randint(0, 9)), some, prose(rng, rng.randint(0, 9)))).strip())
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    out = {(r.doc_id, r.item_id): r.matched for r in decontaminate.overlaps(texts_frame(spark, texts), bench).collect()}
    want = {(i, k): m for i, t in enumerate(texts) for k, x in enumerate(items) if (m := _laid(t, x)) >= min(13, -(-len(x.split()) * 4 // 5))}
    assert out == want and len(want) > 24


def test_short_items_count_whole(spark):
    texts = ["what is the capital", "we ask What is the capital, of it", "what is the big capital", "yes", "yes or no", None, ""]
    bench = spark.createDataFrame([(1, "what is the capital"), (2, "yes"), (3, ""), (4, None)], "item_id long, text string")
    run = lambda **o: {(r.doc_id, r.item_id) for r in decontaminate.overlaps(texts_frame(spark, texts), bench, **o).collect()}
    assert run(short_items=True) == {(0, 1), (1, 1), (3, 2)} and run() == set()


def test_twenty_thousand_equal_words(spark):
    bench = spark.createDataFrame([(1, "same " * 40)], "item_id long, text string")
    out = decontaminate.overlaps(texts_frame(spark, ["same " * 20_000, "other " * 20_000]), bench).collect()
    assert [(r.doc_id, r.matched) for r in out] == [(0, 40)]


def test_best_stretch_by_brute_force(spark):
    rng = random.Random(10)
    rows = [[int(rng.random() >= p) for _ in range(rng.randint(0, 40))] for p in (0.1, 0.15, 0.2, 0.6) for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, same array<int>")
    for r in df.select("same", decontaminate.best_stretch().alias("b")).collect():
        x = r.same
        assert r.b.matched == max([0, *(sum(x[a:z]) for a in range(len(x)) for z in range(a + 1, len(x) + 1) if 4 * sum(x[a:z]) >= 3 * (z - a))])
        if r.b.matched:
            part = x[r.b.first : r.b.last + 1]
            assert sum(part) == r.b.matched and part[0] == part[-1] == 1 and 4 * sum(part) >= 3 * len(part)


def test_wide_benchmarks_are_met_by_a_shuffle(spark, monkeypatch):
    text = prose(random.Random(8), 30)
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "fits_broadcast", lambda df: False)
    assert [(r.doc_id, r.matched) for r in decontaminate.overlaps(texts_frame(spark, [text, "x"]), bench).collect()] == [(0, 30)]


# --------------------------------------------------------------------- hnsw


def test_nearest(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(600, 16))
    v[100:160] = v[100]  # a crowd of equal vectors
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)]
    rows += [(1000, None, 0), (1020, [], 0), (1040, [0.0] * 16, 0), (1060, [float("nan")] * 16, 0), (1080, [1.0] * 3, 0), (None, v[0].tolist(), 0), (3, v[3].tolist(), 0), (1100, [None] + [1.0] * 15, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in hnsw.nearest(df, k=20).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 600, 20))
    found = 0
    for q, near in got.items():
        s = v @ v[q]
        want = sorted((i for i in range(600) if i != q), key=lambda i: (-round(s[i], 12), i))[:20]
        assert sorted(near) == list(range(1, 21)) and q not in {i for i, _ in near.values()}
        assert all(abs(x - s[i]) < 1e-9 for i, x in near.values())
        found += len({i for i, _ in near.values()} & set(want))
    assert found / (20 * len(got)) >= 0.95
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>, rank int")
    assert sorted((r.query_id, r.rank) for r in hnsw.nearest(few).collect()) == [(0, 1), (0, 2)]
    assert hnsw.nearest(df.limit(0)).count() == 0


def _recall(spark, v, **options):
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {}
    for r in hnsw.nearest(df, **options).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q in range(0, len(v), options.get("every", 20)):
        s = v @ v[q]
        s[q] = -np.inf
        hit += len(got[q] & set(np.argsort(-s)[:20].tolist()))
    return hit / (20 * len(got))


def test_recall_in_full_shards(spark):
    # the hard case: 64 dimensions without any structure, graphs far larger than the beam
    rng = np.random.default_rng(6)
    v = rng.normal(size=(hnsw.SHARD_POINTS, 64))
    x = hnsw.unit(v, float(np.linalg.norm(v, axis=1).max()))
    g = hnsw.Graph(x)
    q = v[::64]
    near, _ = g.nearest(hnsw._lifted(q), 21, max(hnsw.EF_SEARCH, len(v) // hnsw.BEAM_PART))
    want = np.argsort(-(q @ v.T), 1)[:, :21]
    assert np.mean([len(set(a) & set(b)) / 21 for a, b in zip(near, want, strict=True)]) >= 0.9


def test_queries_visit_the_cells_that_they_need(spark, monkeypatch):
    rng = np.random.default_rng(7)
    visits = []
    needed = hnsw.cells_needed
    monkeypatch.setattr(hnsw, "cells_needed", lambda *a: visits.append(needed(*a)) or visits[-1])
    centers = rng.normal(size=(12, 16)) * 6
    clusters = np.concatenate([c + rng.normal(size=(150, 16)) for c in centers])
    crowd = np.concatenate([clusters, centers[0] + rng.normal(size=(700, 16))])  # a third in one cell
    assert _recall(spark, crowd, every=5, shard_points=200) >= 0.95
    assert _recall(spark, rng.normal(size=(1500, 16)), every=5, shard_points=200) >= 0.95
    assert visits[0] < visits[1]


def test_other_rows_of_a_querys_id_are_candidates(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.9, 0.1]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    out = hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    by_first = [[(r.vec_id, round(r.score, 2)) for r in out if r.rank == k] for k in (1, 2, 3)]
    assert sorted(by_first[0]) == [(0, 0.9), (1, 1.0)] and sorted(by_first[1]) == [(0, 0.9), (1, 0.9)] and len(out) == 6


def test_flat_arrays_hold_the_graph():
    x = hnsw.unit(np.random.default_rng(1).normal(size=(300, 8)), 10.0)
    g = hnsw.Graph(x)
    h = hnsw.Graph.from_arrays(x, **g.to_arrays())
    assert all((a == b).all() for a, b in zip(g.links, h.links, strict=True))
    assert (g.nearest(x[:9], 5, 40)[0] == h.nearest(x[:9], 5, 40)[0]).all()


# ----------------------------------------------------------------- chaining


def test_chain_scores_are_the_best():
    rng = random.Random(2)
    for _ in range(30):
        n = rng.randint(1, 25)
        points = sorted((rng.randint(0, 60), rng.randint(0, 60)) for _ in range(n))
        x, y = [p[0] for p in points], [p[1] for p in points]
        best = []
        for j in range(n):
            before = [best[i] - chaining.GAP * (x[j] - x[i] + y[j] - y[i]) for i in range(j) if x[i] < x[j] and y[i] < y[j]]
            best.append(1 + max([0.0, *before]))
        got = chaining.chains(x, y, least=1)[0]
        score = 1 + sum(1 - chaining.GAP * (x[b] - x[a] + y[b] - y[a]) for a, b in zip(got, got[1:], strict=False))
        assert abs(score - max(best)) < 1e-9
        assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(got, got[1:], strict=False))


def test_passages(spark):
    rng = random.Random(11)
    p, q = prose(rng, 70), prose(rng, 60)
    texts = [
        prose(rng, 80) + " " + p + " " + prose(rng, 30), prose(rng, 10) + " " + p.upper() + " " + prose(rng, 90), changed(rng, p, 14), prose(rng, 300),
        prose(rng, 20) + " " + " ".join(q.split()[:30]) + " " + prose(rng, 2) + " " + " ".join(q.split()[30:]), q + " " + prose(rng, 5), " ".join(p.split()[:20]) + " " + prose(rng, 40),
        None, "", "a b", "word " * 200, "word " * 180,
    ]
    out = chaining.shared_passages(texts_frame(spark, texts)).collect()
    pairs = {(r.doc_id, r.other_id) for r in out}
    assert {(1, 0), (2, 0), (5, 4), (11, 10)} <= pairs
    assert not {3, 6, 7, 8, 9} & {x for p in pairs for x in p}
    for r in out:
        mine, other = (WORD.findall(texts[i].lower())[a:b] for i, a, b in ((r.doc_id, r.doc_from, r.doc_to), (r.other_id, r.other_from, r.other_to)))
        assert len(mine) >= 50 and r.identity >= 0.8 and r.matched <= min(len(mine), len(other))
    assert chaining.shared_passages(empty(spark)).count() == 0


def test_stretches_by_brute_force():
    marks = lambda *runs: np.concatenate([np.full(n, 0 if good else -1) for good, n in runs])
    exactly = marks(*[(True, 4), (False, 1)] * 9, (False, 1), (True, 4))
    assert chaining.stretches(exactly) == [(0, 50)]
    assert chaining.stretches(marks((True, 20), (False, 5), (True, 25)))[0] == (0, 50)
    rng = np.random.default_rng(3)
    for _ in range(300):
        to = np.where(rng.random(rng.integers(0, 160)) < rng.choice([0.7, 0.8, 0.9]), 0, -1)
        to[: rng.integers(0, 30)] = -1
        sums = np.concatenate([[0], np.cumsum(to >= 0)])
        any_at_all = any(5 * (sums[e] - sums[s]) >= 4 * (e - s) for s in range(len(to)) for e in range(s + 50, len(to) + 1))
        got = chaining.stretches(to)
        assert bool(got) == any_at_all
        assert all(e - s >= 50 and 5 * (sums[e] - sums[s]) >= 4 * (e - s) for s, e in got)
        assert all(a[1] <= b[0] for a, b in zip(got, got[1:], strict=False))


def test_altered_passages(spark):
    # 80 words of which every 10th is another
    rng = random.Random(13)
    texts = []
    for _ in range(60):
        p = prose(rng, 80)
        texts += [" ".join((prose(rng, 30), p, prose(rng, 30))), " ".join((prose(rng, 30), changed(rng, p, 10), prose(rng, 30)))]
    out = {(r.doc_id, r.other_id) for r in chaining.shared_passages(texts_frame(spark, texts)).collect()}
    assert len(out & {(i + 1, i) for i in range(0, 120, 2)}) >= 54
    assert all(a == b + 1 and b % 2 == 0 for a, b in out)


def _passage_in(a, b):
    """Whether some 50 words and more of a are equal to those of b, place by place, in
    80 % and more."""
    sums = np.concatenate([[0], np.cumsum(np.array(a) == np.array(b))])
    return any(5 * (sums[e] - sums[s]) >= 4 * (e - s) for s in range(len(a)) for e in range(s + 50, len(a) + 1))


@pytest.mark.parametrize("words", [50, 60, 120])
def test_recall_by_identity(spark, words):
    rng = random.Random(words)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts, wanted = [], {}
    for identity in (0.80, 0.85, 0.90, 0.95):
        for _ in range(60):
            p = [word() for _ in range(words)]
            q = [x if rng.random() < identity else word() for x in p]
            if _passage_in(p, q):
                wanted.setdefault(identity, set()).add((len(texts) + 1, len(texts)))
            texts += [" ".join([*(word() for _ in range(30)), *x, *(word() for _ in range(30))]) for x in (p, q)]
    found = {(r.doc_id, r.other_id) for r in chaining.shared_passages(texts_frame(spark, texts)).collect()}
    assert all(a == b + 1 and b % 2 == 0 for a, b in found)
    for identity, pairs in wanted.items():
        assert len(pairs) > 20 and len(found & pairs) >= 0.95 * len(pairs), identity


def test_altered_copies_of_a_frequent_passage(spark):
    # forty documents have the passage with every seventh word or so replaced; alone the
    # one with the original, in the middle, is near enough to all of them
    rng = random.Random(8)
    p = prose(rng, 70).split()
    texts = [" ".join((prose(rng, 30), " ".join(p if i == 23 else [x if rng.random() < 0.85 else prose(rng, 1) for x in p]), prose(rng, 30))) for i in range(41)]
    found = {frozenset((r.doc_id, r.other_id)) for r in chaining.shared_passages(texts_frame(spark, texts)).collect()}
    assert sum(frozenset((i, 23)) in found for i in range(41)) >= 36


def test_long_gaps_are_aligned():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 50, 900)  # no word is there once
    b = np.concatenate([a[:300], rng.integers(100, 150, 400), a[300:]])
    got = chaining._between(a, b)
    assert len(got) == 900 and all(a[i] == b[j] for i, j in got)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got[:-1], got[1:], strict=True))
    some = np.sort(rng.choice(3000, 2500, replace=False))
    unique = rng.permutation(3000)
    assert len(chaining._between(unique, unique[some])) == 2500


def test_a_text_of_a_million_characters(spark):
    rng = random.Random(9)
    long = prose(rng, 200_000)
    part = " ".join(long.split()[120_000:120_080])
    found = {(r.doc_id, r.other_id, r.other_from) for r in chaining.shared_passages(texts_frame(spark, [long, part, "again " * 20_000, "again " * 100])).collect()}
    assert (1, 0, 120_000) in found and {p[:2] for p in found} == {(1, 0), (3, 2)}


def test_passages_of_stock_sentences(spark):
    # documents 30 and 60 alone hold all of the passage; each half has other first and last holders
    rng = random.Random(12)
    a, b = prose(rng, 30), prose(rng, 30)
    whole = lambda: " ".join((prose(rng, 40), a, b, prose(rng, 40)))
    texts = [whole() if i in (30, 60) else " ".join((prose(rng, 40), (a, b)[i % 2], prose(rng, 40))) for i in range(80)]
    # 25 holders of 40 words around which the 50 differ
    core = prose(rng, 40)
    ends = [prose(rng, 5) for _ in range(5)]
    texts += [" ".join((prose(rng, 20), ends[i % 5], core, ends[i // 5], prose(rng, 20))) for i in range(25)]
    twice = " ".join((prose(rng, 20), ends[1], core, ends[2], prose(rng, 20)))  # as document 80 + 11
    out = chaining.shared_passages(texts_frame(spark, [*texts, twice])).collect()
    pairs = {(r.doc_id, r.other_id) for r in out}
    assert {(60, 30), (105, 91)} <= pairs and not [p for p in pairs if p[0] < 80 and p != (60, 30)]


def test_near_holders_far_from_the_first_and_weightiest(spark):
    # all stock sentences are frequent; documents 25 and 33 alone hold two that stand
    # together, each with other words replaced, and every other holder has more around
    rng = random.Random(21)
    a, b, c, d = (prose(rng, 32) for _ in range(4))
    alter = lambda p, at: " ".join(prose(rng, 1) if i % 12 == at else x for i, x in enumerate(p.split()))
    texts = [" ".join((prose(rng, 60), alter(a + " " + b, i % 12) if i in (25, 33) else (a + " " + c, d + " " + b)[i % 2], prose(rng, 60))) for i in range(60)]
    pairs = {(r.doc_id, r.other_id) for r in chaining.shared_passages(texts_frame(spark, texts)).collect()}
    assert (33, 25) in pairs and not [p for p in pairs if set(p) & {25, 33} and p != (33, 25)]


@pytest.mark.parametrize("many,tile", [(64, 4096), (10, 4096), (10, 16)])
def test_places_of_a_seed_by_brute_force(monkeypatch, many, tile):
    # 60 holders of a seed in the middle of a passage, altered to different degrees
    monkeypatch.setattr(chaining, "MANY", many)
    monkeypatch.setattr(chaining, "TILE", tile)
    rng = random.Random(5)
    p = prose(rng, 104).split()
    texts = [" ".join(x if 50 <= k < 54 or rng.random() > 0.04 * (1 + i % 6) else prose(rng, 1) for k, x in enumerate(p)) for i in range(60)]
    asked = [chaining.pack([np.array([x]) for x in (i, 50, 7, 0)], chaining._ASKED) for i in range(60)]
    batch = chaining.pa.RecordBatch.from_arrays([chaining.pa.array(texts), chaining.pa.array(asked, chaining.pa.binary())], ["text", "asked"])
    rows, linked = chaining._surroundings(1)(iter([batch])), set()
    while rows:
        out = [(kind, data) for r in chaining._near_linker(1, 1)(iter(rows)) for kind, data in zip(r.column("kind").to_pylist(), r.column("data").to_pylist(), strict=True)]
        for kind, data in out:
            if kind == 0:
                doc, other = chaining.unpack([data], chaining._LINK)[:2]
                linked |= {frozenset(x) for x in zip(doc.tolist(), other.tolist(), strict=True)}
        rows = [chaining._rows(np.zeros(len(x), np.int64), x) for x in [[data for kind, data in out if kind == 1]] if x]
    near = lambda x, y: max(np.convolve(np.array(x.split()) == np.array(y.split()), np.ones(50, int), "valid")[4:51]) >= 40
    run = lambda x, y: max(np.convolve(np.array(x.split()) == np.array(y.split()), np.ones(50, int), "valid")[4:51]) == 50
    partners = [{j for j in range(60) if frozenset((i, j)) in linked} for i in range(60)]
    wanted = [(i, j) for i in range(60) for j in range(i) if near(texts[i], texts[j]) and not run(texts[i], texts[j])]
    assert len(wanted) > 300
    for i, j in wanted:
        # two by two, or where there are many, both with the one that stands for them
        assert j in partners[i] or many < 60 and partners[i] & partners[j]


def test_words_in_another_order_are_no_near_place():
    # around the seed the same words, in order, with some more, and in an order of their own
    rng = np.random.default_rng(4)
    common = lambda a, b: len(chaining._common(a, b))
    a, b = rng.integers(1, 9, (60, 46)).astype(np.uint16), rng.integers(1, 9, (60, 72)).astype(np.uint16)
    a[::3, 30:] = b[::2, 50:] = 0  # past the text's end
    got = chaining._common_lengths(a, b)
    assert all(got[i, n] == common(np.where(a[i, :n] > 0, a[i, :n], 99), b[i]) for i in range(60) for n in range(47))
    words = rng.permutation(60_000)[: chaining._WIDE].astype(np.uint16) + 1
    at = chaining.SIDE
    altered, moved, mixed = words.copy(), words.copy(), words.copy()
    altered[[at - 9, at + 12, at + 20, at + 31]] = 1
    moved[at - 9] = 1
    moved[at + chaining.K + 5 :] = np.concatenate([[1] * 9, words[at + chaining.K + 5 : -9]])
    mixed[:at] = words[:at].reshape(-1, 12)[:, ::-1].ravel()
    mixed[at + chaining.K :] = words[at + chaining.K :].reshape(-1, 12)[:, ::-1].ravel()
    near = lambda *rows: [{(max(i, j), min(i, j)) for i, j in zip(i.tolist(), j.tolist(), strict=True)} for i, j in rows]
    for other, linked in ((altered, True), (moved, True), (mixed, False)):
        both, doc, none = np.stack([words, other]), np.arange(2), np.zeros(2, np.int64)
        for found in (chaining._near_few(both, doc, none, none), chaining.near_places(both, doc, none, none)):
            assert set().union(*near(*found)) == ({(1, 0)} if linked else set())


# ------------------------------------------------------------------ quality


def test_quality_is_learned(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = quality.score_quality(docs, labels).join(labels, "doc_id").where("held_out")
    assert out.select(F.avg(F.expr("int((quality = 1) = keep)"))).first()[0] > 0.97


def test_sparse_sites_are_shrunk(spark):
    rows = [("big", "p", 0.9)] * 200 + [("big", "q", 0.2)] + [("bad", "p", 0.1)] * 200 + [("tiny", "p", 0.0)] + [(None, None, 0.5)]
    sites, mean = quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double"))
    got = {(r._host, r._path): r for r in sites.collect()}
    assert abs(got["big", "p"].path_mean - 0.9) < 0.05 and abs(got["bad", "p"].path_mean - 0.1) < 0.05
    assert 0.1 < got["tiny", "p"].path_mean < mean and got["big", "q"].path_mean > 0.3 and (None, None) in got


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    rows = [r for r in corpus() if r[0] is None or r[0] < 1000]
    out = quality.score_quality(frame(spark, rows), labels)
    assert out.count() == len(rows) and out.where("score is null or score < 0 or score > 1").count() == 0
    assert quality.keep_good(frame(spark, rows), labels).columns == frame(spark, rows).columns
    assert quality.score_quality(frame(spark, rows), labels.limit(0)).select("keep").distinct().count() == 1
    assert quality.score_quality(empty(spark), labels).count() == 0


# ------------------------------------------------- clashing names and text ids

CLASHING = ("_id", "_bad", "_gone", "_toxic_score", "_copy", "_rk", "_again", "_fp", "_class", "_tie", "_mine", "_n", "_key", "_y", "_text", "_t", "copies", "size")


def clashing(spark, rows, text_ids):
    docs = frame(spark, rows)
    docs = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")) if text_ids else docs
    return docs.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.mark.parametrize("text_ids", [False, True])
def test_all_columns_are_kept(spark, text_ids):
    docs = clashing(spark, corpus(n=4), text_ids)
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    labels = ids.select("doc_id", F.expr("int(pmod(xxhash64(doc_id), 8) = 0)").alias("toxic")).withColumn("quality", 1 - F.col("toxic"))
    bench = spark.createDataFrame([(1, corpus(n=4)[0][1]), (2, None)], "item_id long, text string")
    for f in (
        lambda d: toxicity.reject_toxic(d, labels), jaccard.one_of_each, lambda d: decontaminate.drop_contaminated(d, bench),
        mixing.mix_documents, lambda d: sharding.shard_documents(d).drop("slot").withColumn("shard", F.lit("own")).select(d.columns), lambda d: quality.keep_good(d, labels),
    ):
        out = f(docs)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == c for r in rows for c in CLASHING)
    assert sharding.shard_documents(docs).count() == docs.count()


def test_groups_of_equal_rows_are_parted(spark):
    rows = spark.range(1000).selectExpr("if(id < 900, null, id % 20) k", "id v").withColumn("key", F.struct("k", F.lit(1).alias("one")))
    out = common.numbered_copies(rows, "key", "copy", most=50).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("copy").alias("a"), F.max("copy").alias("z"), F.count_distinct("copy").alias("d")).collect()
    assert len(out) == 21 and all(r.a == 1 and r.z == r.n == r.d for r in out)


def test_text_ids(spark):
    docs = clashing(spark, corpus(n=4), True)
    for f in (mixing.mix_digest, sharding.shard_digest, jaccard.similar_components, secrets.secret_digest):
        assert f(docs).count() == docs.count()
    # the same pairs of documents, whichever is named first
    pairs = lambda d: {frozenset(str(x).removeprefix("d") for x in (r.doc_id, r.other_id)) for r in chaining.shared_passages(d).collect()}
    assert pairs(docs) == pairs(clashing(spark, corpus(n=4), False)) != set()


# ------------------------------------------------- more results by brute force


def test_site_posteriors_by_hand(spark):
    rng = random.Random(14)
    rows = [(f"h{rng.randint(0, 4)}", f"/p{rng.randint(0, 3)}", rng.random()) for _ in range(300)]
    sites, mean = quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double"))

    def sums(key):
        out = {}
        for r in rows:
            n, k = out.get(key(r), (0, 0.0))
            out[key(r)] = (n + 1, k + r[2])
        return out

    def strength(groups):  # (n, k, mean of its parent)
        s = sum(n * (k / n - m) ** 2 for n, k, m in groups)
        a, b = sum(m * (1 - m) for _, _, m in groups), sum((n - 1) * m * (1 - m) for n, _, m in groups)
        return 1e6 if s <= a else min(1e6, max(0.5, b / (s - a) - 1))

    total = sum(r[2] for r in rows) / len(rows)
    assert abs(mean - total) < 1e-12
    hosts = sums(lambda r: r[0])
    m = strength([(n, k, total) for n, k in hosts.values()])
    shrunk = {h: (k + m * total) / (n + m) for h, (n, k) in hosts.items()}
    paths = sums(lambda r: r[:2])
    m = strength([(n, k, shrunk[h]) for (h, _), (n, k) in paths.items()])
    want = {(h, p): (k + m * shrunk[h]) / (n + m) for (h, p), (n, k) in paths.items()}
    got = {(r._host, r._path): r.path_mean for r in sites.collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_hosts_come_from_urls(spark):
    urls = ["HTTPS://user@WWW.Example.org:80/a/b?q#f", "http://example.org", "no url", None, ""]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = quality.site_columns(df)
    assert [tuple(r) for r in df.select(host, path).collect()] == [("example.org", "/a"), ("example.org", None), (None, None), (None, None), (None, None)]
    docs = frame(spark, corpus(n=3)).withColumn("url", F.lit("http://one.org/x"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    assert quality.score_quality(docs, labels).select("host_mean").distinct().count() == 1
    assert quality.score_quality(frame(spark, corpus(n=3)), labels).select("host_mean").distinct().count() > 1


def test_repeated_labelled_ids_teach_once(spark):
    docs = frame(spark, [(i % 10, f"text {i} of some kind", "en", "s", 0, "", "") for i in range(400)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    assert quality.score_quality(docs, labels).count() == 400
    rows = toxicity.labelled_sample(docs, labels.withColumnRenamed("quality", "toxic"))
    assert rows.count() <= 10


def _base(text):
    """The contract's spans, read letter by letter."""
    found = []
    low, i = "".join(c.lower() if c.isascii() else c for c in text), 0
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    while i < len(text):
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if not low.startswith(word, i):
                continue
            j = i + len(word)
            ways = []
            for quote in (True, False):
                k = j
                if quote and k < len(text) and text[k] in "\"'":
                    k += 1
                elif quote:
                    continue
                while k < len(text) and text[k] == " ":
                    k += 1
                if k < len(text) and text[k] in ":=":
                    ways.append(k + 1)
            for k in ways[:1]:
                while k < len(text) and text[k] == " ":
                    k += 1
                if k < len(text) and text[k] in "\"'":
                    k += 1
                e = k
                while e < len(text) and text[e] in value:
                    e += 1
                if e > k:
                    found.append((i, e, "assign", e - k >= 8))
                    i = e - 1
            break
        i += 1
    for kind, letters, head, least in (("access", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "AKIA", 16), ("hex", "0123456789abcdef", "", 32)):
        i = 0
        while i < len(text):
            e = i + len(head)
            while text.startswith(head, i) and e < len(text) and text[e] in letters:
                e += 1
            if text.startswith(head, i) and e > i + len(head):
                found.append((i, e, kind, e - i >= least))
                i = e
            else:
                i += 1
    order = ("assign", "access", "hex")
    return [(a, z, k) for a, z, k, ok in sorted(found, key=lambda s: (s[0], order.index(s[2]))) if ok]


def test_base_spans_by_brute_force(spark):
    import hashlib

    rng = random.Random(15)
    pieces = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", "  ", '"', "'", "abc", "12345678", "Zz9_/+.=-", "AKIA", "AKIAAKIA", "ABCDEF0123456789", "deadbeef", "0123456789abcdef" * 2, "é", "ſ", "\n", "ß", ""]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(1500)] + [None]
    rows = secrets.secret_digest(texts_frame(spark, texts)).orderBy("doc_id").collect()
    some = 0
    for t, r in zip(texts, rows, strict=True):
        want = _base(t or "")
        some += len(want)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, _, k in want) for x in ("assign", "access", "hex")], t
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{z}" for a, z, k in want).encode()).hexdigest(), t
        assert {f"{k}:{a}:{z}" for a, z, k in want} <= set(r.spans.split(","))
    assert some > 300


def test_another_vocabulary(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    key = "q7Zx9Kp2Vb4Nc8Lm3Rt6Yw1Qs5Hd0Jf"
    assert secrets.secret_digest(texts_frame(spark, [f"see {key}"]), vocabulary=path).first().n_random == 1
