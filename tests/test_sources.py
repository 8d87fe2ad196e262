import pytest

from arborlex.operators.inference import length_batches
from arborlex.operators.ordering import with_index
from arborlex.sources import documents as D
from arborlex.sources import sinks as K

LINES = [
    ('{"doc_id": "a", "text": "x", "more": 1}', "a", None),
    ('{"id": "b", "text": "x"}', "b", None),
    ('{"warc_record_id": "c", "text": "x"}', "c", None),
    ('{"warc_record_id": "w", "id": "i", "doc_id": "d", "text": "x"}', "d", None),
    ('{"doc_id": null, "id": "i", "text": "x"}', None, "the id is not a string"),
    ('{"doc_id": 5, "text": "x"}', None, "the id is not a string"),
    ('{"text": "x"}', None, "no doc_id, id or warc_record_id"),
    ('{"doc_id": "  ", "text": "x"}', "  ", "blank doc_id"),
    ('{"doc_id": "e", "text": "\\n\\t "}', "e", "blank text"),
    ('{"doc_id": "f"}', "f", "text is missing or not a string"),
    ("", None, "blank line"),
    ("[1]", None, "not an object"),
    ("{", None, "not JSON, or a key twice"),
]


def test_lines_are_read_strictly(spark):
    rows = D.parse_lines(spark.createDataFrame([(i, x) for i, (x, _, _) in enumerate(LINES)], "i int, value string")).orderBy("i").collect()
    assert [(r.doc_id, r.problem) for r in rows] == [(a, b) for _, a, b in LINES]


def test_strict_raises_and_quarantine_parts(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text(LINES[0][0] + "\n\n")
    df = D.read_jsonl(spark, str(tmp_path / "in.jsonl"))
    with pytest.raises(Exception, match="blank line"):
        D.strict(df).collect()
    good, bad = D.quarantine(df)
    assert (good.count(), bad.count()) == (1, 1)
    assert D.count_lines(spark, str(tmp_path / "in.jsonl")) == 2


def test_fingerprint_of_a_file(spark, tmp_path):
    f = tmp_path / "a.txt"
    f.write_text("abc")
    assert D.fingerprint(spark, str(f)) == (str(f), 3, f.stat().st_mtime_ns)


def test_shards_are_every_nth(spark):
    df = spark.range(20).withColumnRenamed("id", "doc_id")
    assert sorted(r.doc_id for r in D.shard(df, 1, 3, "doc_id").collect()) == list(range(1, 20, 3))
    assert sorted(r.doc_id for r in D.shard(df, 1, 3, "doc_id", skip=2).collect()) == list(range(7, 20, 3))
    with pytest.raises(ValueError):
        D.shard(df, 3, 3, "doc_id")


def test_index_is_the_global_place(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS k")
    rows = with_index(df, "k").collect()
    assert len(rows) == 1000 and all(r.pos == r.k for r in rows)
    assert with_index(spark.range(0), "id").count() == 0


def test_length_batches():
    got = list(length_batches(iter(["aaaa", "b", "cc", "ddd", "e"]), 2, 3))
    assert got == [["b", "cc"], ["e", "ddd"], ["aaaa"]] or sorted(map(len, got)) == [1, 2, 2]
    with pytest.raises(ValueError):
        list(length_batches(iter([]), 3, 2))


def test_epochs_and_metadata(spark, tmp_path):
    folder = str(tmp_path / "log")
    for e in (1, 2):
        K.append_epoch(spark.createDataFrame([(e,)], "seq long"), folder, e)
    K.append_epoch(spark.createDataFrame([(2,)], "seq long"), folder, 2)
    assert sorted(r.seq for r in K.read_log(spark, folder, "seq long").collect()) == [1, 2]
    assert [r.seq for r in K.read_log(spark, folder, "seq long", after=1).collect()] == [2]
    K.ensure_metadata(tmp_path / "m.json", {"a": 1, "created_at_unix": 1})
    K.ensure_metadata(tmp_path / "m.json", {"a": 1, "created_at_unix": 2})
    with pytest.raises(ValueError, match="a differ"):
        K.ensure_metadata(tmp_path / "m.json", {"a": 2})


def test_reconcile(spark):
    assert K.reconcile([spark.range(3), spark.range(4)]).count() == 7


class FakeRows(list):
    def shard(self, num_shards, index):
        return FakeRows(self[index::num_shards])


def fake_hub(dataset, name=None, split="train", streaming=False):
    assert streaming
    return FakeRows([{"id": f"{dataset}-{name}-{split}-{i}", "text": f"text {i}", "n": i} for i in range(5)])


def test_hub_datasets(spark):
    rows = D.read_hub(spark, "set", "conf", "test", shards=2, loader="tests.test_sources:fake_hub")
    assert rows.rdd.getNumPartitions() == 2
    assert sorted(r.doc_id for r in rows.collect()) == [f"set-conf-test-{i}" for i in range(5)]
    got = D.read_input(spark, dataset="set", loader="tests.test_sources:fake_hub")
    assert got.columns == ["doc_id", "text"] and got.count() == 5
    with pytest.raises(ValueError, match="exactly one"):
        D.read_input(spark)
    with pytest.raises(ValueError, match="exactly one"):
        D.read_input(spark, jsonl="a", dataset="b")


def test_typed_records_name_the_bad_line(spark, tmp_path):
    schema = "seq long, doc_id string, assigned_label_ids array<string>"
    f = tmp_path / "log.jsonl"
    fine = '{"seq": 1, "doc_id": "a", "assigned_label_ids": ["L001"]}\n'
    f.write_text(fine + fine.replace("1,", "2,"))
    assert [r.seq for r in D.read_records(spark, str(f), schema).orderBy("seq").collect()] == [1, 2]
    for bad, problem in (("\n", "blank"), ("{\n", "not JSON"), ("[1]\n", "not an object"), ('{"seq": 1}\n', "fields are seq"), (fine.replace("1,", '"1",'), "another type"), (fine.replace('"a"', "null"), "null"), (fine.replace('"doc_id"', '"more": 1, "doc_id"'), "fields are")):
        f.write_text(fine + fine + bad + fine)
        with pytest.raises(ValueError, match=f"log.jsonl:3: .*{problem}"):
            D.read_records(spark, str(f), schema)


def test_records_that_cannot_stand(spark):
    from arborlex.operators import labels_log as G

    p = ("P1", "Name", "x")
    rows = [(1, "ok", 1, ["L1"], [p]), (0, "seq", 1, [], []), (2, "", 1, [], []), (3, "version", 0, [], []), (4, "twice", 1, ["L1", "L1"], []), (5, "id", 1, [], [p, ("P1", "Other", "x")]), (6, "label", 1, [], [p, ("P2", " name ", "X")]), (7, "none", 1, None, [])]
    found = G.record_problems(spark.createDataFrame(rows, G.LOG)).collect()
    assert sorted(r.doc_id for r in found) == ["", "id", "label", "none", "seq", "twice", "version"]


def test_predictions_in_buckets(spark):
    import numpy as np

    from arborlex.plans.classifier import predict

    docs = spark.createDataFrame([(str(i), "x" * (i % 7 + 1), i) for i in range(48)], "doc_id string, text string, n int").coalesce(1)

    def logits(texts):
        assert len(texts) <= 4 and max(map(len, texts)) - min(map(len, texts)) <= 2
        return np.array([[len(t) % 2, 0.5] for t in texts])

    rows = predict(docs, logits, {0: "odd", 1: "even"}, batch=4, bucket=24).collect()
    assert len(rows) == 48 and all(r.predicted_label == ("odd" if (r.n % 7 + 1) % 2 else "even") for r in rows)
