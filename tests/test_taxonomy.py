from dataclasses import replace

import pytest

from arborlex.operators import taxonomy as X
from arborlex.operators.taxonomy import DynamicLabel, Group, Label, Settings, TaxonomyError

SEEDS = [Label(f"L{i:03d}", f"Seed {i}", f"Definition {i}") for i in range(1, 25)]
G1, G2 = Group("G1", "Quantum computing", "On qubits", 2), Group("G2", "Robotics", "On robots", 1)


def fresh(**changes):
    return replace(X.new_taxonomy("topic", SEEDS), **changes)


def keep(*groups):
    return [{"proposal_group_id": g.group_id, "action": "keep_candidate"} for g in groups]


def promoted():
    t = fresh().screen([G1], keep(G1), 1)
    return t.promote([G1], [{"candidate_group_ids": ["G1"], "name": G1.name, "definition": G1.definition}])


def test_keep_accumulate_promote():
    t = fresh().screen([G1, G2], keep(G1, G2), 4)
    t, new = t.accumulate([replace(G2, support_count=3), Group("G3", "Chess", "On chess", 1)])
    assert [g.group_id for g in new] == ["G3"]
    assert {g.group_id: g.support_count for g in t.candidates} == {"G1": 2, "G2": 4}
    ready = t.eligible()
    assert [g.group_id for g in ready] == ["G2", "G1"]
    t = t.promote(ready, [{"candidate_group_ids": ["G1", "G2"], "name": "Machines", "definition": "On machines"}])
    label = t.dynamic_labels[0]
    assert (label.id, label.proposal_support_count, label.created_version, t.schema_version, t.candidates) == ("L025", 6, 2, 2, ())


def test_screening_must_cover_and_know_its_targets():
    with pytest.raises(TaxonomyError, match="leaves out"):
        fresh().screen([G1, G2], keep(G1), 1)
    with pytest.raises(TaxonomyError, match="isn't active"):
        fresh().screen([G1], [{"proposal_group_id": "G1", "action": "map_existing", "target_label_id": "L099"}], 1)
    t = fresh().screen([G1], keep(G1), 1).screen([G1], [{"proposal_group_id": "G1", "action": "map_existing", "target_label_id": "L001"}], 1)
    assert t.candidates == () and t.schema_version == 1 and len(t.history) == 2


def test_consolidation_keeps_support():
    t = fresh().screen([G1, G2], keep(G1, G2), 1).consolidate([G1, G2], {"G1": "G2", "G2": "G2"})
    assert [(g.group_id, g.support_count) for g in t.candidates] == [("G2", 3)]
    with pytest.raises(TaxonomyError, match="not for itself"):
        fresh().screen([G1, G2], keep(G1, G2), 1).consolidate([G1, G2], {"G1": "G2", "G2": "G1"})
    t = fresh().screen([G1, G2], keep(G1, G2), 1).consolidate([G1, G2], {"G1": "G1", "G2": "G2"})
    assert t.told_apart() == {("G1", "G2")}


def test_merge_moves_counts_and_aliases():
    t = promoted()
    other = DynamicLabel("L026", "Qubits", "On qubits, too", 2, 2, 5, 1)
    t = replace(t, dynamic_labels=(*t.dynamic_labels, other), alias_map={"L030": "L026"}, next_dynamic_label_num=31).checked()
    t = t.merge([("L026", "L025")])
    assert t.alias_map == {"L030": "L025", "L026": "L025"}
    assert (t.dynamic_labels[0].usage_count, t.dynamic_labels[0].proposal_support_count, t.schema_version) == (5, 3, 3)
    assert t.merge([]).schema_version == 3 and t.merge([]).history[-1]["kind"] == "final_merge"
    with pytest.raises(TaxonomyError):
        t.merge([("L001", "L025")])


def test_revision():
    t = promoted().revise([Label("L025", "Quantum", "On qubits")])
    assert t.dynamic_labels[0].name == "Quantum" and t.schema_version == 3
    with pytest.raises(TaxonomyError, match="nothing changes"):
        t.revise([Label("L025", "Quantum", "On qubits")])
    with pytest.raises(TaxonomyError, match="twice"):
        t.revise([Label("L025", "seed  1", "On qubits")])


@pytest.mark.parametrize(("change", "says"), [
    ({"seed_labels": tuple(SEEDS[:-1])}, "seed labels"),
    ({"alias_map": {"L001": "L002"}}, "is an active label"),
    ({"alias_map": {"L090": "L091"}, "next_dynamic_label_num": 99}, "ends nowhere"),
    ({"alias_map": {"L090": "L091", "L091": "L090"}, "next_dynamic_label_num": 99}, "cycle"),
    ({"next_dynamic_label_num": 24}, "in use"),
    ({"candidates": (G1, G1)}, "twice"),
    ({"dynamic_labels": (DynamicLabel("L025", "x", "y", 1, 1),), "next_dynamic_label_num": 26}, "version 1"),
    ({"frozen": True}, "frozen"),
    ({"seed_hash": "x"}, "stored hash"),
])
def test_invariants(change, says):
    with pytest.raises(TaxonomyError, match=says):
        fresh(**change).checked()


def test_saved_state_is_the_same(tmp_path):
    t = promoted().freeze()
    X.save(t, tmp_path / "t.json")
    back = X.load(tmp_path / "t.json")
    assert back.digest() == t.frozen_hash == back.frozen_hash and back.history == tuple(t.history)
    text = (tmp_path / "t.json").read_text().replace('"format_version": 3', '"format_version": 2')
    with pytest.raises(TaxonomyError):
        X.from_json(text)


def test_settings_are_checked():
    with pytest.raises(TaxonomyError):
        Settings(batch_size=0)
    assert Settings().candidate_consolidation_max_groups == 12


def test_seed_file(tmp_path):
    f = tmp_path / "s.yaml"
    f.write_text("- id: L001\n  name: A\n  definition: >\n    folded\n- {id: L002, name: B, definition: c}\n")
    assert [x.definition for x in X.load_seeds(f, 2)] == ["folded", "c"]
    with pytest.raises(TaxonomyError):
        X.load_seeds(f, 3)


def test_allocation_skips_taken_ids():
    assert X.allocate(25, {"L025", "L026"}) == ("L027", 28)
