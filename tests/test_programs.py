import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborlex.operators import candidates as C
from arborlex.operators.inference import LexicalLabeler, ReplayLabeler, label_documents
from arborlex.operators.taxonomy import Group, Label, Settings, TaxonomyError, load, new_taxonomy, save
from arborlex.plans import discover as D
from arborlex.plans import sweep as S
from arborlex.plans.classifier import classify_to
from arborlex.plans.classify import RESULT, run_classification
from arborlex.plans.queries import QUERIES
from arborlex.sources.sinks import epochs, read_log
from arborlex.streaming.discovery import discover_stream
from tests.conftest import SF

SEEDS = [Label(f"L{i:03d}", f"Seed {i}", f"Definition {i}") for i in range(1, 25)]
QUANTUM = {"name": "Quantum computing", "definition": "On qubits"}
ANSWERS = {
    "Document 1 text.": (["L001"], [QUANTUM]), "Document 2 text.": (["L002"], [{"name": "Robotics", "definition": "On robots"}]),
    "Document 3 text.": (["L001"], [{"name": "quantum  computing", "definition": "on qubits"}]), "Document 4 text.": (["L003"], []),
}
SETTINGS = Settings(batch_size=2, screen_every=2, min_promotion_support=2)


def corpus(spark):
    return spark.createDataFrame([(f"doc-{i}", f"Document {i} text.") for i in range(1, 5)], "doc_id string, text string")


def test_discovery_and_classification_end_to_end(spark, tmp_path):
    docs, folder = corpus(spark), str(tmp_path)
    t = D.discover(docs, ReplayLabeler(ANSWERS), D.KeepAll(), SEEDS, "topic", folder, SETTINGS)
    assert t.frozen and [(x.id, x.name, x.proposal_support_count) for x in t.dynamic_labels] == [("L025", "Quantum computing", 2)]
    assert [(g.name, g.support_count) for g in t.candidates] == [("Robotics", 1)]
    log = read_log(spark, f"{folder}/discovery", D.G.LOG).orderBy("seq").collect()
    assert [(r.seq, r.doc_id) for r in log] == [(i, f"doc-{i}") for i in range(1, 5)]
    with pytest.raises(TaxonomyError, match="frozen"):
        D.discover(docs, ReplayLabeler(ANSWERS), D.KeepAll(), SEEDS, "topic", folder, SETTINGS)
    out = f"{folder}/labels"
    labeler = LexicalLabeler({"L001": ["document"]})
    assert run_classification(docs.limit(4), labeler, t, out, max_documents=3) == 3
    assert run_classification(docs, labeler, t, out) == 1
    assert run_classification(docs, labeler, t, out) == 0
    rows = read_log(spark, out, RESULT).orderBy("seq").collect()
    assert [r.seq for r in rows] == [1, 2, 3, 4] and {r.taxonomy_hash for r in rows} == {t.frozen_hash}
    with pytest.raises(ValueError, match="aren't in the input"):
        run_classification(docs.where("doc_id <> 'doc-1'"), labeler, t, out)


def test_cursor_stays_when_screening_breaks_off(spark, tmp_path):
    class Broken(D.KeepAll):
        def screen(self, t, groups):
            raise RuntimeError("gone")

    with pytest.raises(RuntimeError):
        D.discover(corpus(spark), ReplayLabeler(ANSWERS), Broken(), SEEDS, "topic", str(tmp_path), SETTINGS)
    t = load(tmp_path / "taxonomy_state.json")
    assert t.last_screened_seq == 0 and epochs(f"{tmp_path}/discovery") == [1]
    assert D.discover(corpus(spark), ReplayLabeler(ANSWERS), D.KeepAll(), SEEDS, "topic", str(tmp_path), SETTINGS).frozen


def test_nothing_is_saved_before_freezing(spark, tmp_path):
    class Broken(D.KeepAll):
        def merge(self, t):
            raise RuntimeError("gone")

    with pytest.raises(RuntimeError):
        D.discover(corpus(spark), ReplayLabeler(ANSWERS), Broken(), SEEDS, "topic", str(tmp_path), SETTINGS)
    t = load(tmp_path / "taxonomy_state.json")
    assert not t.frozen and t.last_screened_seq == 4 and all(h["kind"] != "final_merge" for h in t.history)


def test_unreadable_screening_is_halved():
    calls = []

    class Picky(D.KeepAll):
        def screen(self, t, groups):
            calls.append(len(groups))
            if any(g.group_id == "G2" for g in groups):
                raise D.MalformedOutput
            return super().screen(t, groups)

    groups = [Group(f"G{i}", f"Name {i}", "x", 1) for i in range(4)]
    out = D.screen_resiliently(Picky(), new_taxonomy("topic", SEEDS), groups)
    assert [d["proposal_group_id"] for d in out] == ["G0", "G1", "G2", "G3"] and calls == [4, 2, 2, 1, 1]


def test_wrong_label_stops_the_run(spark, tmp_path):
    bad = dict(ANSWERS) | {"Document 1 text.": (["L999"], [])}
    with pytest.raises(Exception, match="unknown label L999"):
        D.discover(corpus(spark), ReplayLabeler(bad), D.KeepAll(), SEEDS, "topic", str(tmp_path), SETTINGS)


def test_epoch_sizes():
    t = new_taxonomy("topic", SEEDS, Settings(batch_size=512, screen_every=2000))
    assert [D.epoch_size(t, lag) for lag in (0, 1999, 500, 5000)] == [2048, 512, 1536, 512]


def test_streamed_discovery(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "run")
    save(new_taxonomy("topic", SEEDS, SETTINGS), f"{folder}/taxonomy_state.json")
    docs = corpus(spark)
    for part in ("doc_id <= 'doc-2'", "doc_id > 'doc-2'"):
        docs.where(part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("doc_id string, text string").parquet(source)
        discover_stream(stream, ReplayLabeler(ANSWERS), D.KeepAll(), folder, str(tmp_path / "ckpt")).awaitTermination()
    t = load(f"{folder}/taxonomy_state.json")
    assert t.last_screened_seq == 4 and [x.name for x in t.dynamic_labels] == ["Quantum computing"]


def pool(spark, rows):
    return spark.createDataFrame(rows, C.GROUP)


def test_no_chaining_and_one_batch_of_similar(spark):
    four = [("G1", "Media Ethics & Journalism", "x", 1), ("G2", "Media & Journalism", "a", 1), ("G3", "Media & Journalism", "b", 1), ("G4", "Journalism & Media", "x", 1)]
    got = C.neighbourhoods(pool(spark, four), [0.8]).collect()
    assert sorted(r.group_id for r in got) == ["G1", "G2", "G3", "G4"] and len({r.seed_id for r in got}) == 1
    apart = spark.createDataFrame([("G2", "G3")], "left_id string, right_id string")
    got = C.neighbourhoods(pool(spark, four), [0.8], excluded=apart).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.seed_id, set()).add(r.group_id)
    assert not any({"G2", "G3"} <= g for g in groups.values())
    assert C.greedy_cliques([("a", "x"), ("b", "x"), ("c", "x")], {("a", "b"): 0.9, ("b", "c"): 0.9, ("a", "c"): 0.4}, {("a", "b"), ("b", "c")}, set(), 0.8, 12) == [["a", "b"]]


@pytest.mark.parametrize("limit", [C.COMPONENT_LINKS, 40])
def test_components_give_what_the_whole_pool_gives(spark, limit):
    rng = random.Random(5)
    words = ["media", "ethics", "law", "sport", "history", "music"]
    rows = [(f"G{i:02d}", " ".join(rng.sample(words, rng.randint(1, 3))), "x", i + 1) for i in range(40)]
    pairs = {(r.left_id, r.right_id): r.score for r in C.scored_pairs(pool(spark, rows)).collect()}
    for t in (0.6, 0.8):
        want = C.greedy_cliques([r[:2] for r in rows], dict(pairs), {k for k, v in pairs.items() if v >= t}, set(), t, 5)
        found = {}
        for r in C.neighbourhoods(pool(spark, rows), [t], 5, limit=limit).orderBy("member_pos").collect():
            found.setdefault(r.seed_id, []).append(r.group_id)
        assert sorted(found.values()) == sorted(want)


def per_task(pairs):
    """Each pair with its task; no task makes more than 2 * PART * PART."""
    rows = pairs.select("left_id", "right_id", F.spark_partition_id().alias("task")).collect()
    assert max(Counter(r.task for r in rows).values()) <= 2 * C.PART**2
    return sorted((r.left_id, r.right_id) for r in rows)


def test_pairs_of_a_common_token_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(C, "PART", 16)
    monkeypatch.setattr(C, "TASK_PAIRS", 8)
    rng = random.Random(6)
    rows = [(f"G{i:03d}", f"common {' '.join(rng.sample('abcdefgh', 3))}", "x", 1) for i in range(150)]
    assert per_task(C.block_pairs(pool(spark, rows))) == [(a[0], b[0]) for a, b in itertools.combinations(rows, 2)]


def test_pairs_that_were_told_apart_come_once(spark, monkeypatch):
    monkeypatch.setattr(C, "PART", 16)
    monkeypatch.setattr(C, "TASK_PAIRS", 8)
    rng = random.Random(7)
    history = [(f"E{rng.choice((0, 0, 0, 1, 2))}", f"G{rng.randint(0, 129):03d}", f"R{rng.randint(0, 3)}") for _ in range(500)]
    now = {f"G{i:03d}" for i in range(120)}
    want = {(a, b) for (e, a, x), (f, b, y) in itertools.product(history, history) if e == f and a < b and x != y and {a, b} <= now}
    frame = spark.createDataFrame(history, "entry_id string, group_id string, rep string")
    assert per_task(C.reviewed_pairs(frame, pool(spark, [(g, g, "x", 1) for g in now]))) == sorted(want)


@pytest.mark.parametrize("name", ["overlap_score", "excluded_pairs_filter", "reviewed_pairs"])
def test_pairs_are_made_once_and_not_shuffled(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Repartition" not in plan[: plan.index("Join ")] and "Aggregate" not in plan


def test_pairs_of_a_sweep_need_no_groups(spark, monkeypatch):
    rows = [("G1", "Media Ethics", "x", 2), ("G2", "Ethics of Media", "x", 2)]
    monkeypatch.setattr(S, "neighbourhoods", None)
    assert S.sweep(pool(spark, rows), [0.6, 0.8]).pair_rows().count() == 1


def test_sweep_reports(spark, tmp_path):
    rows = [("G1", "Media Ethics", "x", 2), ("G2", "Ethics of Media", "x", 2), ("G3", "Chess", "x", 1)]
    s = S.sweep(pool(spark, rows), S.parse_thresholds("80, 0.95"))
    summary = {r.threshold: r for r in s.summary(3).collect()}
    assert (summary["0.8"].num_multi_candidate_groups, summary["0.8"].singleton_candidates, summary["0.8"].grouped_support_total, summary["0.8"].groups_reaching_promotion_support) == (1, 1, 4, 1)
    assert {r.status for r in s.groups(3).collect()} == {"grouped", "singleton"} and s.groups(3).count() == 6
    assert s.pair_rows().first().eligible_thresholds == "0.8,0.95"
    S.write_reports(s, str(tmp_path), 3)
    assert (tmp_path / "report.html").exists() and (tmp_path / "summary").exists()


def test_batch_classifier(spark, tmp_path):
    docs = spark.createDataFrame([("a", "http://x", "short"), ("b", None, "a much longer text")], "doc_id string, url string, text string")
    logits = lambda texts: np.array([[1, 0, 0] if len(t) > 15 else [0, 1, 1] for t in texts])
    out = str(tmp_path / "out")
    classify_to(docs.where("doc_id = 'a'"), out, logits, {0: "long", "1": "short"}, short=True)
    with pytest.raises(ValueError, match="exists"):
        classify_to(docs, out, logits, {})
    classify_to(docs, out, logits, {0: "long", "1": "short"}, short=True, resume=True)
    assert {r.doc_id: r.predicted_label for r in spark.read.json(out).collect()} == {"a": "short", "b": "long"}


def test_a_run_reads_its_log_once(spark, tmp_path, monkeypatch):
    read = []
    whole = D.read_log
    monkeypatch.setattr(D, "read_log", lambda s, f, schema, after=None, only=None: read.append(list(only)) or whole(s, f, schema, after, only))
    docs = spark.createDataFrame([(f"doc-{i:02d}", "Document 1 text.") for i in range(12)], "doc_id string, text string")
    t = D.discover(docs, ReplayLabeler({"Document 1 text.": (["L001"], [QUANTUM])}), D.KeepAll(), SEEDS, "topic", str(tmp_path), SETTINGS, freeze=False)
    assert t.last_screened_seq == 12 and epochs(f"{tmp_path}/discovery") == [1, 2, 3, 4, 5, 6]
    # at the start the log is empty; an epoch is read when it is added and when its proposals are due
    assert [r for r in read if len(r) > 1] == [] and max(read.count(r) for r in read if r) <= 3
    assert [(x.name, x.usage_count) for x in t.dynamic_labels] == [("Quantum computing", 0)]


def test_long_lags_are_screened_in_parts(spark, tmp_path):
    seen = []

    class Counting(D.KeepAll):
        def screen(self, t, groups):
            seen.append(len(groups))
            return super().screen(t, groups)

    docs = spark.createDataFrame([(f"doc-{i}", f"Text {i}") for i in range(9)], "doc_id string, text string")
    t = new_taxonomy("topic", SEEDS, SETTINGS)
    log = D.DiscoveryLog(spark, f"{tmp_path}/discovery", t)
    labeler = ReplayLabeler({f"Text {i}": (["L001"], [{"name": f"Name {i}", "definition": "x"}]) for i in range(9)})
    log.append(D.label_epoch(docs, labeler, t, 1), t)
    t = D.screen_new(log, t, Counting())
    assert t.last_screened_seq == 9 and seen == [4, 4, 1] and len(t.candidates) == 9
    again = D.DiscoveryLog(spark, f"{tmp_path}/discovery", t)
    assert (again.latest, again.uses, again.last) == (9, {"L001": 9}, {1: 9})


def test_a_folder_of_another_file_system(spark, tmp_path):
    (tmp_path / "far").mkdir()
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.test.link./run", f"file://{tmp_path}/far")
    folder = "viewfs://test/run/topics"
    t = D.discover(corpus(spark), ReplayLabeler(ANSWERS), D.KeepAll(), SEEDS, "topic", folder, SETTINGS, max_documents=2, freeze=False)
    assert epochs(f"{folder}/discovery") == [1] and load(f"{folder}/taxonomy_state.json").last_screened_seq == 2
    t = D.discover(corpus(spark), ReplayLabeler(ANSWERS), D.KeepAll(), SEEDS, "topic", folder, SETTINGS)
    assert t.frozen and load(f"{folder}/taxonomy_state.json").digest() == t.digest()
    assert epochs(f"{folder}/discovery") == [1, 2]


def test_labelling_takes_a_batch_at_a_time_and_passes_columns_on(spark):
    class Longest:
        def __call__(self, texts, labels, discover):
            return [([f"L{len(texts):03d}"], [{"name": "Quantum", "definition": "On qubits"}])] * len(texts)

    rows = [(i, 2**53 + 1 if i % 2 else None, f"Text {i}") for i in range(20)]
    out = label_documents(spark.createDataFrame(rows, "doc_id long, n long, text string").coalesce(1), Longest(), SEEDS, True, batch=8)
    assert "MapInArrow" in out._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(out.collect(), key=lambda r: r.doc_id)
    assert [r.n for r in got] == [r[1] for r in rows] and [r.assigned_label_ids for r in got] == [["L008"]] * 16 + [["L004"]] * 4
    assert got[0].proposed_labels[0].name == "Quantum" and all(r.problem is None for r in got)
