"""Messages and answer schemas for a chat model behind labelers and maintainers.

Every task is a pair: what the model is told, and the JSON schema that its answer
must fit. Groups are named by short ids (P001, C001, ...) that are unique within one
prompt; answers are translated back.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from arborlex.functions.text import DEFINITION_MAX, LABEL_PATTERN, NAME_MAX
from arborlex.operators.taxonomy import Group, Label, Taxonomy

Messages = list[dict[str, str]]


def _chat(system: str, user: str) -> Messages:
    return [{"role": "system", "content": system}, {"role": "user", "content": user}]


def label_lines(labels: Sequence[Label]) -> str:
    return "\n".join(f"{x.id} | {x.name}: {x.definition}" for x in labels)


def short_ids(groups: Sequence[Group], letter: str) -> dict[str, Group]:
    return {f"{letter}{i:03d}": g for i, g in enumerate(groups, 1)}


def _table(groups: dict[str, Group]) -> str:
    return json.dumps([{"id": k, "name": g.name, "definition": g.definition, "support": g.support_count} for k, g in groups.items()], ensure_ascii=False)


def _labels(t: Taxonomy) -> str:
    fixed = {x.id for x in t.seed_labels}
    return json.dumps([{"id": x.id, "name": x.name, "definition": x.definition, "immutable": x.id in fixed} for x in t.active], ensure_ascii=False)


def discovery(text: str, labels: Sequence[Label], aspect: str, creativity: str = "low") -> Messages:
    eager = "Propose a label whenever a more telling one can be thought of." if creativity == "high" else "Propose a label only where no present one fits."
    return _chat(f"You label documents by {aspect}. Assign the ids of all labels that fit. {eager} Answer in JSON.", f"Labels:\n{label_lines(labels)}\n\nDocument:\n{text}")


def classification(text: str, labels: Sequence[Label], aspect: str) -> Messages:
    return _chat(f"You label documents by {aspect}, with the given labels only. Assign one at least. Answer in JSON.", f"Labels:\n{label_lines(labels)}\n\nDocument:\n{text}")


def screening(t: Taxonomy, groups: dict[str, Group]) -> Messages:
    return _chat(f"You look after labels for {t.aspect}. For each proposal: keep it as a candidate, discard it, or map it to the active label that covers it. Answer in JSON.", f"Labels: {_labels(t)}\n\nProposals: {_table(groups)}")


def consolidation(t: Taxonomy, groups: dict[str, Group]) -> Messages:
    return _chat(f"You look after candidate labels for {t.aspect}. Give for each the one that stands for the same thing; itself, if none does. Answer in JSON.", f"Candidates: {_table(groups)}")


def promotion(t: Taxonomy, groups: dict[str, Group], most: int) -> Messages:
    return _chat(f"You make labels for {t.aspect} of candidates: {most} at most, each candidate used once, with names that no label has. Answer in JSON.", f"Labels: {_labels(t)}\n\nCandidates: {_table(groups)}")


def merging(t: Taxonomy) -> Messages:
    return _chat(f"You look for labels for {t.aspect} that mean the same. Merge such that aren't immutable into another; no label that is merged is a target. Answer in JSON.", f"Labels: {_labels(t)}")


def revision(t: Taxonomy, ids: Sequence[str]) -> Messages:
    return _chat(f"You improve names and definitions of labels for {t.aspect}. Leave out labels that are fine. Answer in JSON.", f"Labels: {_labels(t)}\n\nReview: {json.dumps(list(ids))}")


# ------------------------------------------------------------------- schemas


def _object(**properties: dict) -> dict:
    return {"type": "object", "properties": properties, "required": list(properties), "additionalProperties": False}


def _ids(ids: Sequence[str]) -> dict:
    if not ids or len(set(ids)) < len(ids):
        raise ValueError("ids must be given, each once")
    return {"type": "string", "enum": list(ids)}


def _text(most: int) -> dict:
    return {"type": "string", "minLength": 1, "maxLength": most, "pattern": LABEL_PATTERN}


def _list(items: dict, least: int = 0, most: int | None = None) -> dict:
    return {"type": "array", "items": items, "minItems": least} | ({} if most is None else {"maxItems": most})


_NAMED = {"name": _text(NAME_MAX), "definition": _text(DEFINITION_MAX)}


def discovery_schema(ids: Sequence[str], most_ids: int, most_proposed: int) -> dict:
    return _object(assigned_label_ids=_list(_ids(ids), 0, most_ids), proposed_labels=_list(_object(**_NAMED), 0, most_proposed))


def classification_schema(ids: Sequence[str], most_ids: int) -> dict:
    return _object(assigned_label_ids=_list(_ids(ids), 1, most_ids))


def screening_schema(groups: Sequence[str], targets: Sequence[str]) -> dict:
    """An object with one decision under each id, so that none can be left out."""
    plain = [_object(action={"const": a}) for a in ("keep_candidate", "discard_candidate")]
    decision = {"anyOf": [*plain, _object(action={"const": "map_existing"}, target_label_id=_ids(targets))]}
    _ids(groups)
    return _object(decisions=_object(**dict.fromkeys(groups, decision)))


def consolidation_schema(groups: Sequence[str]) -> dict:
    return _object(assignments=_object(**dict.fromkeys(groups, _ids(groups))))


def promotion_schema(groups: Sequence[str], most: int) -> dict:
    return _object(new_labels=_list(_object(candidate_group_ids=_list(_ids(groups), 1), **_NAMED), 1, most))


def merging_schema(sources: Sequence[str], targets: Sequence[str]) -> dict:
    return _object(merges=_list(_object(source_label_id=_ids(sources), target_label_id=_ids(targets))))


def revision_schema(ids: Sequence[str]) -> dict:
    return _object(revisions=_list(_object(label_id=_ids(ids), **_NAMED), 0, len(ids)))
