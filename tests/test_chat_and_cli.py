import json
import time

import pytest

from arborlex.functions import prompts as P
from arborlex.operators.chat import ChatLabeler, ChatMaintainer, Reply, Words, ask_many
from arborlex.operators.taxonomy import Group, Label, new_taxonomy
from arborlex.plans import cli
from arborlex.plans.discover import MalformedOutput, screen_chunks
from arborlex.streaming.progress import Ticker, report

SEEDS = [Label(f"L{i:03d}", f"Seed {i}", f"Definition {i}") for i in range(1, 25)]
T = new_taxonomy("topic", SEEDS)
GROUPS = [Group("G_a", "A", "x", 2), Group("G_b", "B", "y", 2)]


def says(answer):
    return lambda messages, schema: answer if isinstance(answer, str) else json.dumps(answer)


def test_labeler_asks_and_translates():
    labeler = ChatLabeler(says({"assigned_label_ids": ["L001"], "proposed_labels": []}), "topic")
    assert labeler(["text"], SEEDS, True) == [(["L001"], [])]
    with pytest.raises(MalformedOutput):
        ChatLabeler(says("no json"), "topic")(["text"], SEEDS, True)


def test_maintainer_translates_prompt_ids():
    m = ChatMaintainer(says({"decisions": {"P002": {"action": "discard_candidate"}, "P001": {"action": "map_existing", "target_label_id": "L001"}}}))
    assert m.screen(T, GROUPS) == [{"proposal_group_id": "G_a", "action": "map_existing", "target_label_id": "L001"}, {"proposal_group_id": "G_b", "action": "discard_candidate"}]
    assert ChatMaintainer(says({"assignments": {"C001": "C002", "C002": "C002"}})).consolidate(T, GROUPS) == {"G_a": "G_b", "G_b": "G_b"}
    new = {"new_labels": [{"candidate_group_ids": ["C001", "C002"], "name": "N", "definition": "D"}]}
    assert ChatMaintainer(says(new)).promote(T, GROUPS)[0]["candidate_group_ids"] == ["G_a", "G_b"]
    assert ChatMaintainer(says("unasked")).merge(T) == []


@pytest.mark.parametrize("answer", [
    {"decisions": {"P001": {"action": "keep_candidate"}}}, {"decisions": {"P001": {"action": "keep_candidate"}, "P002": {"action": "x"}}},
    {"decisions": {"P001": {"action": "keep_candidate", "target_label_id": "L001"}, "P002": {"action": "keep_candidate"}}},
    {"decisions": {"P001": {"action": "map_existing", "target_label_id": "L999"}, "P002": {"action": "keep_candidate"}}}, [],
])
def test_malformed_screening(answer):
    with pytest.raises(MalformedOutput):
        ChatMaintainer(says(answer)).screen(T, GROUPS)


def test_schemas_name_what_is_allowed():
    assert P.classification_schema(["L001"], 3)["properties"]["assigned_label_ids"] == {"type": "array", "items": {"type": "string", "enum": ["L001"]}, "minItems": 1, "maxItems": 3}
    assert set(P.screening_schema(["P001", "P002"], ["L001"])["properties"]["decisions"]["required"]) == {"P001", "P002"}
    with pytest.raises(ValueError):
        P.consolidation_schema(["C001", "C001"])
    assert "immutable" in P.merging(T)[1]["content"] and "Seed 1" in P.discovery("t", SEEDS, "topic")[1]["content"]


def test_config(tmp_path):
    f = tmp_path / "c.yaml"
    f.write_text("run_name: r1\npaths:\n  folder: /x/${run_name}\n  input: in\n  seed_labels: s\nmodel:\n  batch_size: 7\n")
    args = cli.arguments(["discover", "--config", str(f), "--input", "other"])
    assert (args.folder, args.input, args.batch_size) == ("/x/r1", "other", 7)
    f.write_text("reconcile: 3\n")
    with pytest.raises(ValueError, match="unknown keys"):
        cli.config_defaults(str(f))
    with pytest.raises(SystemExit):
        cli.arguments(["classify"])


def test_programs_from_the_command_line(spark, tmp_path):
    import yaml

    (tmp_path / "seeds.yaml").write_text(yaml.safe_dump([{"id": x.id, "name": x.name, "definition": x.definition} for x in SEEDS]))
    (tmp_path / "in.jsonl").write_text("".join(json.dumps({"doc_id": f"d{i}", "text": "seeds about quantum computing"}) + "\n" for i in range(3)))
    run = str(tmp_path / "run")
    cli.main(["discover", "--input", str(tmp_path / "in.jsonl"), "--folder", run, "--seed-labels", str(tmp_path / "seeds.yaml")], spark)
    cli.main(["classify", "--input", str(tmp_path / "in.jsonl"), "--taxonomy", f"{run}/taxonomy_state.json", "--output", f"{run}/labels"], spark)
    state = json.loads((tmp_path / "run/taxonomy_state.json").read_text())
    assert state["frozen"] and {x["name"] for x in state["dynamic_labels"]} == {"Topic computing", "Topic quantum"}


def test_report():
    assert report(10, 20, 100.0, now=102.0) == "10 of 20 documents, 5.00/s, 2s spent, 2s left, 0.00 device hours"


class Batched:
    """A model that takes all requests at once."""

    def __init__(self, answer):
        self.answer, self.calls = answer, []

    def many(self, requests):
        self.calls.append(len(requests))
        return [self.answer(m, s) for m, s in requests]


def test_a_batch_is_one_call():
    fine = Reply(json.dumps({"assigned_label_ids": ["L001"], "proposed_labels": []}), tokens_in=10, tokens_out=3)
    chat = Batched(lambda m, s: fine)
    labeler = ChatLabeler(chat, "topic")
    assert labeler(["a", "b", "c"], SEEDS, True) == [(["L001"], [])] * 3 and chat.calls == [3]
    assert (labeler.totals.requests, labeler.totals.tokens_in, labeler.totals.tokens_out) == (3, 30, 9)
    with pytest.raises(ValueError, match="0 answers"):
        ask_many(type("None_", (), {"many": lambda self, r: []})(), [([], {})])


def test_screening_chunks_are_one_call_and_bad_ones_are_halved():
    def answer(messages, schema):
        ids = list(schema["properties"]["decisions"]["properties"])
        finish = "length" if len(ids) > 1 and "G_a-name" in messages[1]["content"] else "stop"
        return Reply(json.dumps({"decisions": {i: {"action": "keep_candidate"} for i in ids}}), finish)

    chat = Batched(answer)
    groups = [Group("G_a", "G_a-name", "x", 1), *(Group(f"G_{i}", f"N{i}", "x", 1) for i in range(3))]
    out = screen_chunks(ChatMaintainer(chat), T, [groups[:2], groups[2:]])
    assert [[d["proposal_group_id"] for d in c] for c in out] == [["G_a", "G_0"], ["G_1", "G_2"]]
    assert chat.calls == [2, 1, 1, 1]  # both chunks; the first again, then its halves


@pytest.mark.parametrize(("reply", "problem"), [
    (Reply("{}", "length"), "cut off"), (Reply(""), "empty"), (Reply("[]"), "no object"), (Reply('{"assigned_label_ids": [], "x": 1}'), "keys"),
    (Reply('{"assigned_label_ids": ["L999"], "proposed_labels": []}'), "unknown value"), (Reply('{"assigned_label_ids": "L001", "proposed_labels": []}'), "no array"),
    (Reply('{"assigned_label_ids": [], "proposed_labels": [{"name": 5, "definition": "x"}]}'), "no string"),
])
def test_answers_are_held_against_their_schema(reply, problem):
    with pytest.raises(MalformedOutput, match=problem):
        ChatLabeler(lambda m, s: reply, "topic")(["text"], SEEDS, True)


def test_texts_that_can_be_mended_pass():
    answer = json.dumps({"assigned_label_ids": ["L001", "L001"], "proposed_labels": [{"name": "#Rust", "definition": "x" * 600}]})
    assert ChatLabeler(says(answer), "topic")(["t"], SEEDS, True)[0][1][0]["name"] == "#Rust"
    new = {"new_labels": [{"candidate_group_ids": ["C001"], "name": "#N", "definition": "D"}]}
    with pytest.raises(MalformedOutput, match="doesn't fit"):
        ChatMaintainer(says(new)).promote(T, GROUPS)


def test_prompts_fit_the_context():
    class Letters(Words):
        def encode(self, text):
            return list(text)

        def decode(self, tokens):
            return "".join(tokens)

        def prompt_length(self, messages):
            return sum(len(m["content"]) for m in messages)

    room = Letters().prompt_length(ChatLabeler(says("{}"), "topic").messages("", SEEDS, False))
    labeler = ChatLabeler(says("{}"), "topic", tokenizer=Letters(), context=room + 60, answer=10)
    messages = labeler.messages("x" * 500, SEEDS, False)
    assert Letters().prompt_length(messages) == room + 50 and messages[1]["content"].endswith("x\n[TRUNCATED]")
    assert labeler.messages("short", SEEDS, False)[1]["content"].endswith("short")
    with pytest.raises(ValueError, match="longer than the context"):
        ChatLabeler(says("{}"), "topic", tokenizer=Letters(), context=20, answer=10).messages("t", SEEDS, False)


@pytest.mark.parametrize(("text", "problem"), [
    ("reconcile: 3\n", "obsolete"), ("model:\n  reconcile_max_tokens: 3\n", "obsolete"), ("model:\n  screen_every: 3\n", "unknown keys screen_every in the section model"),
    ("batch_size: 3\n", "unknown keys"), ("model: 3\n", "not a mapping"), ("paths:\n  input: ${other}\n", "placeholder"), ("paths:\n  input: ${run_name}\n", "needs a run name"), ("run_name: -x\n", "no run name"),
])
def test_files_that_are_refused(tmp_path, text, problem):
    (tmp_path / "c.yaml").write_text(text)
    with pytest.raises(ValueError, match=problem):
        cli.config_defaults(str(tmp_path / "c.yaml"))


@pytest.mark.parametrize("more", [
    ["--seed", "-1"], ["--log-level", "VERBOSE"], ["--max-documents", "0"], ["--compute-logging-interval", "0"], ["--max-total-labels", "3"], ["--dataset-input", "d"], ["--batch-size", "0"],
])
def test_arguments_that_are_refused(tmp_path, more):
    fine = ["classify", "--input", "in", "--taxonomy", "t", "--output", "o"]
    assert cli.arguments(fine).seed == 0
    with pytest.raises(SystemExit):
        cli.arguments([*fine, *more])


def test_kinds_of_values_from_a_file(tmp_path):
    for text in ('runtime:\n  compute_logging: "false"\n', "model:\n  seed: true\n", "model:\n  batch_size: 2.5\n"):
        (tmp_path / "c.yaml").write_text(text)
        with pytest.raises(SystemExit):
            cli.arguments(["classify", "--input", "in", "--taxonomy", "t", "--output", "o", "--config", str(tmp_path / "c.yaml")])


def test_ticker_tells_and_goes_on(caplog):
    calls = []

    def progress():
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("no figures")
        return 10, 20

    with caplog.at_level("INFO"), Ticker(progress, every=0.01, devices=4, budget=2.0):
        while len(calls) < 3:
            time.sleep(0.01)
    assert "no progress to tell" in caplog.text and "10 of 20 documents" in caplog.text
    assert Ticker(lambda: (10, 20), devices=4, budget=2.0).line(3600) == "10 of 20 documents, 0.00/s, 1h 0m 0s spent, 1h 0m 0s left, 4.00 device hours, 4.00 to come, -2.00 of 2.00 left"
    with pytest.raises(ValueError):
        Ticker(progress, every=0)
