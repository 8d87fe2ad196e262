import difflib
import hashlib
import itertools
import json

import duckdb
import pytest

from arborlex.plans.fixtures import SEEDS
from arborlex.plans.oracles import POOL
from arborlex.plans.queries import _state
from arborlex.plans.registry import ORACLES, QUERIES
from tests.conftest import SF
from tests.oracle import compare, connection


@pytest.fixture(scope="module")
def con():
    return connection(SF)


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_sql_gives(spark, con, name):
    compare(spark, con, SF, QUERIES[name], ORACLES[name])


def test_blank_documents_are_left_out_of_a_scan(spark, tmp_path):
    rows = [(1, "some text", "en"), (2, " \t\n", "en"), (3, "", "en"), (4, None, "de"), (5, 'a "quoted"\x00\ud7ff line\n', None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    want = duckdb.sql(ORACLES["scan_documents"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")).fetchall()
    assert values(QUERIES["scan_documents"](spark, str(tmp_path)), "doc_id", "chars") == sorted(want) == [("1", 9), ("5", 18)]


# ------------------------------------------- what SQL can't say, by brute force


def score(a: str, b: str) -> tuple[float, float, float]:
    s, t = (sorted(set(x.lower().split())) for x in (a, b))
    if a == b:
        return 1.0, 1.0, 1.0
    ratio, shared = difflib.SequenceMatcher(None, " ".join(s), " ".join(t)).ratio(), len({*s} & {*t})
    overlap = shared / min(len(s), len(t)) if shared > 1 else 0.0
    return max(ratio, overlap), ratio, overlap


@pytest.fixture(scope="module")
def pool(con):
    """id -> (name, support); pair -> scores of those that share a word."""
    groups = {g: (n, int(k)) for g, n, k in con.sql(f"WITH {POOL} SELECT group_id, name, support_count FROM pool").fetchall()}
    pairs = {(a, b): score(groups[a][0], groups[b][0]) for a in groups for b in groups if a < b and {*groups[a][0].split()} & {*groups[b][0].split()}}
    assert len(groups) > 50 and len(pairs) > 20
    return groups, pairs


def turns(pool, threshold: float, most: int = 12) -> list[list[str]]:
    """Seeds in order of ids; each takes what is nearest and near enough to all it has."""
    groups, pairs = pool
    near = lambda a, b: (pairs.get((min(a, b), max(a, b))) or score(groups[min(a, b)][0], groups[max(a, b)][0]))[0]
    free, out = sorted(groups), []
    while free:
        group = [free[0]]
        some = [g for g in free[1:] if pairs.get((group[0], g), (-1,))[0] >= threshold]
        for g in sorted(some, key=lambda g: (-near(group[0], g), g)):
            if len(group) < most and all(near(g, other) >= threshold for other in group):
                group.append(g)
        free = [g for g in free if g not in group]
        out.append(group)
    return out


def values(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_name_similarity(spark, pool):
    got = values(QUERIES["name_similarity"](spark, SF), "left_id", "right_id", "score")
    assert got == sorted((*k, round(v[0], 6)) for k, v in pool[1].items())


def test_sweep_pairs(spark, pool):
    got = values(QUERIES["sweep_pairs"](spark, SF), "left_id", "left_name", "right_id", "right_name", "score", "sequence_score", "overlap_score", "shared_tokens", "historically_excluded", "eligible_thresholds")
    names = {k: v[0] for k, v in pool[0].items()}
    want = [(a, names[a], b, names[b], *(f"{x:.6f}" for x in s), " | ".join(sorted({*names[a].split()} & {*names[b].split()})), False, ",".join(str(t) for t in (0.6, 0.8) if s[0] >= t)) for (a, b), s in pool[1].items()]
    assert got == sorted(want)


def test_consolidation_batches(spark, pool):
    got = {}
    for r in QUERIES["consolidation_batches"](spark, SF).orderBy("member_pos").collect():
        got.setdefault(r.seed_id, []).append(r.group_id)
    assert sorted(got.values()) == sorted(g for g in turns(pool, 0.8) if len(g) > 1)


def test_sweep_groups_and_singletons(spark, pool):
    groups, pairs = pool
    want, alone = [], []
    for t in (0.6, 0.8):
        n = 0
        for g in turns(pool, t):
            support = sum(groups[x][1] for x in g)
            if len(g) == 1:
                alone.append((t, g[0], groups[g[0]][1]))
                want.append((str(t), "", 1, g[0], groups[g[0]][1], support, support >= 3, "", "", "singleton"))
                continue
            n += 1
            s = [(pairs.get((min(a, b), max(a, b))) or score(groups[min(a, b)][0], groups[max(a, b)][0]))[0] for a, b in itertools.combinations(g, 2)]
            want += [(str(t), f"T{t:.3f}_G{n:04d}", len(g), x, groups[x][1], support, support >= 3, f"{min(s):.6f}", f"{sum(s) / len(s):.6f}", "grouped") for x in g]
    got = values(QUERIES["sweep_groups"](spark, SF), "threshold", "sweep_group_id", "member_count", "candidate_group_id", "candidate_support", "combined_support", "reaches_promotion_support", "min_pair_similarity", "mean_pair_similarity", "status")
    assert got == sorted(want)
    assert values(QUERIES["sweep_singletons"](spark, SF), "threshold", "group_id", "support_count") == sorted(alone)


def test_sweep_summary(spark, pool):
    groups, want = pool[0], []
    for t in (0.6, 0.8):
        many = [g for g in turns(pool, t) if len(g) > 1]
        support = [sum(groups[x][1] for x in g) for g in many]
        n = sum(map(len, many))
        want.append((str(t), len(groups), len(many), n, len(groups) - n, sum(s >= 3 for s in support), sum(support)))
    assert values(QUERIES["sweep_summary"](spark, SF), "threshold", "total_candidates", "num_multi_candidate_groups", "grouped_candidates", "singleton_candidates", "groups_reaching_promotion_support", "grouped_support_total") == want


def test_taxonomy_hash(spark):
    labels = [{"definition": f"About {n}", "id": f"L{i:03d}", "name": n} for i, n in enumerate(SEEDS, 1)]
    assert QUERIES["taxonomy_hash"](spark, SF).first()[0] == _state().digest() and len(_state().digest()) == 64
    assert _state().seed_hash == hashlib.sha256(json.dumps(labels, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def test_allocate_ids(spark):
    assert [r.id for r in QUERIES["allocate_ids"](spark, SF).collect()] == ["L025", "L027", "L029", "L030"]


def test_every_query_is_held_against_something():
    rest = set(QUERIES) - set(ORACLES)
    assert rest <= {"name_similarity", "sweep_pairs", "consolidation_batches", "sweep_groups", "sweep_singletons", "sweep_summary", "taxonomy_hash", "allocate_ids"}
