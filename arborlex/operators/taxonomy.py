"""The versioned taxonomy: its state, invariants, hash, and the transitions that
screening, consolidation, promotion, merging and revision make.

The state is small (labels are capped, candidates have passed screening) and is
held by the driver; what it is computed from stays in DataFrames.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections import Counter
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from pathlib import Path
from typing import Any

from arborlex.functions.text import normalized
from arborlex.operators.storage import read_text, write_text

FORMAT_VERSION = 3
FIRST_DYNAMIC = 25
_ID = re.compile(r"L(\d+)")


class TaxonomyError(ValueError):
    """A transition or a state that breaks a rule."""


@dataclass(frozen=True)
class Label:
    id: str
    name: str
    definition: str


@dataclass(frozen=True)
class DynamicLabel(Label):
    created_version: int
    last_modified_version: int
    usage_count: int = 0
    proposal_support_count: int = 0


@dataclass(frozen=True)
class Group:
    group_id: str
    name: str
    definition: str
    support_count: int


@dataclass(frozen=True)
class Settings:
    """What a run must not change when it is resumed."""

    input_path: str = ""
    input_size_bytes: int = 0
    input_mtime_ns: int = 0
    model_name: str = "lexical"
    batch_size: int = 512
    max_document_tokens: int = 8192
    max_assigned_labels_per_doc: int = 5
    max_proposals_per_doc: int = 3
    screen_every: int = 2048
    max_screening_groups: int = 64
    max_promotion_groups: int = 16
    max_revision_labels: int = 16
    min_promotion_support: int = 2
    max_total_labels: int = 100
    expected_seed_label_count: int = 24
    creativity: str = "low"
    candidate_consolidation_max_groups: int = 12
    candidate_consolidation_min_name_similarity: float = 0.80
    candidate_consolidation_max_tokens: int = 512

    def __post_init__(self) -> None:
        least = {"candidate_consolidation_max_groups": 2}
        for name, value in asdict(self).items():
            if isinstance(value, int) and not name.startswith("input_") and value < least.get(name, 1):
                raise TaxonomyError(f"{name} must be at least {least.get(name, 1)}")
        if self.creativity not in ("low", "high"):
            raise TaxonomyError("creativity must be low or high")
        if not 0 <= self.candidate_consolidation_min_name_similarity <= 1:
            raise TaxonomyError("candidate_consolidation_min_name_similarity must be between 0 and 1")


@dataclass(frozen=True)
class Taxonomy:
    aspect: str
    seed_labels: tuple[Label, ...]
    settings: Settings = Settings()
    schema_version: int = 1
    dynamic_labels: tuple[DynamicLabel, ...] = ()
    alias_map: dict[str, str] = field(default_factory=dict)
    candidates: tuple[Group, ...] = ()
    next_dynamic_label_num: int = FIRST_DYNAMIC
    last_screened_seq: int = 0
    history: tuple[dict, ...] = ()
    frozen: bool = False
    frozen_at_unix: int | None = None
    frozen_hash: str | None = None
    seed_hash: str = ""
    created_at_unix: int = 0
    updated_at_unix: int = 0

    # ----------------------------------------------------------- reading

    @property
    def active(self) -> list[Label]:
        """Seeds first, then dynamic labels."""
        return [*self.seed_labels, *self.dynamic_labels]

    def resolve(self, label_id: str) -> str:
        seen = set()
        while label_id in self.alias_map:
            if label_id in seen:
                raise TaxonomyError(f"alias cycle at {label_id}")
            seen.add(label_id)
            label_id = self.alias_map[label_id]
        return label_id

    def digest(self) -> str:
        """Hash of what classifies: aspect, labels and aliases, not how they came."""
        plain = lambda labels: [{"id": x.id, "name": x.name, "definition": x.definition} for x in labels]
        return sha256({"aspect": self.aspect, "seed_labels": plain(self.seed_labels), "dynamic_labels": plain(self.dynamic_labels), "alias_map": self.alias_map})

    # -------------------------------------------------------- invariants

    def problems(self) -> list[str]:
        """Every rule that the state breaks."""
        s, out = self.settings, []
        versions = [(x.created_version, x.last_modified_version, x.id) for x in self.dynamic_labels]
        if len(self.seed_labels) != s.expected_seed_label_count:
            out.append(f"{len(self.seed_labels)} seed labels, not {s.expected_seed_label_count}")
        out += [f"label id {x} twice" for x, n in Counter(x.id for x in self.active).items() if n > 1]
        out += [f"label name {x!r} twice" for x, n in Counter(normalized(x.name) for x in self.active).items() if n > 1]
        out += [f"{i} was created in version {c}" for c, _, i in versions if c < 2]
        out += [f"{i} has versions out of order" for c, m, i in versions if not c <= m <= self.schema_version]
        if len(self.active) > s.max_total_labels:
            out.append(f"{len(self.active)} labels are more than {s.max_total_labels}")
        used = [int(m[1]) for i in [*(x.id for x in self.active), *self.alias_map] if (m := _ID.fullmatch(i))]
        if self.next_dynamic_label_num <= max(used, default=0):
            out.append("the next label number is in use")
        ids = {x.id for x in self.active}
        for source in self.alias_map:
            if source in ids:
                out.append(f"alias {source} is an active label")
            try:
                if self.resolve(source) not in ids:
                    out.append(f"alias {source} ends nowhere")
            except TaxonomyError as e:
                out.append(str(e))
        out += [f"candidate {x} twice" for x, n in Counter(g.group_id for g in self.candidates).items() if n > 1]
        out += [f"candidate text {x} twice" for x, n in Counter((normalized(g.name), normalized(g.definition)) for g in self.candidates).items() if n > 1]
        if self.seed_hash != seed_hash(self.seed_labels):
            out.append("seed labels aren't those of the stored hash")
        if self.frozen != (self.frozen_at_unix is not None) or self.frozen != (self.frozen_hash is not None):
            out.append("frozen state without its time and hash, or the other way round")
        elif self.frozen and self.frozen_hash != self.digest():
            out.append("the taxonomy isn't the one that was frozen")
        return out

    def checked(self) -> Taxonomy:
        if found := self.problems():
            raise TaxonomyError("; ".join(found))
        return self

    # -------------------------------------------------------- transitions

    def _with(self, entry: dict | None = None, **changes: Any) -> Taxonomy:
        now = int(time.time())
        history = self.history if entry is None else (*self.history, {**entry, "timestamp_unix": now})
        return replace(self, history=history, updated_at_unix=now, **changes).checked()

    def with_usage(self, usage: dict[str, int]) -> Taxonomy:
        return replace(self, dynamic_labels=tuple(replace(x, usage_count=usage.get(x.id, 0)) for x in self.dynamic_labels))

    def accumulate(self, groups: Sequence[Group]) -> tuple[Taxonomy, list[Group]]:
        """Adds support to candidates that are proposed again; the other groups are
        to be screened."""
        pool, new = {g.group_id: g for g in self.candidates}, []
        for g in groups:
            if (old := pool.get(g.group_id)) is None:
                new.append(g)
            elif (normalized(old.name), normalized(old.definition)) != (normalized(g.name), normalized(g.definition)):
                raise TaxonomyError("two texts have one group id")
            else:
                pool[g.group_id] = replace(old, support_count=old.support_count + g.support_count)
        return replace(self, candidates=tuple(pool.values())), new

    def screen(self, groups: Sequence[Group], decisions: Sequence[dict], seq: int) -> Taxonomy:
        """decisions: proposal_group_id, action (keep_candidate, discard_candidate,
        map_existing with target_label_id), one for each group."""
        given, expected = [d["proposal_group_id"] for d in decisions], {g.group_id: g for g in groups}
        _same_ids("screening", expected, given)
        ids = {x.id for x in self.active}
        pool = {g.group_id: g for g in self.candidates}
        for d in decisions:
            g = expected[d["proposal_group_id"]]
            match d["action"]:
                case "keep_candidate":
                    if pool.setdefault(g.group_id, g) != g:
                        raise TaxonomyError(f"candidate {g.group_id} isn't the one in the pool")
                case "map_existing" if d.get("target_label_id") not in ids:
                    raise TaxonomyError(f"{g.group_id} is mapped to {d.get('target_label_id')}, which isn't active")
                case "map_existing" | "discard_candidate":
                    pool.pop(g.group_id, None)
                case other:
                    raise TaxonomyError(f"unknown action {other!r}")
        entry = {"kind": "proposal_screening", "discovery_seq_end": seq, "taxonomy_version": self.schema_version, "proposal_groups": [asdict(g) for g in groups], "screening": {"decisions": list(decisions)}}
        return self._with(entry, candidates=tuple(pool.values()), last_screened_seq=seq)

    def consolidate(self, groups: Sequence[Group], assignments: dict[str, str]) -> Taxonomy:
        """assignments: each group to the one that stands for it (itself, if none)."""
        own = {g.group_id: g for g in groups}
        _same_ids("consolidation", own, list(assignments))
        for rep in assignments.values():
            if rep not in own or assignments[rep] != rep:
                raise TaxonomyError(f"{rep} stands for others but not for itself")
        self._must_hold(groups)
        support: Counter[str] = Counter()
        for source, rep in assignments.items():
            support[rep] += own[source].support_count
        result = [replace(own[r], support_count=support[r]) for r in sorted(support)]
        rest = [g for g in self.candidates if g.group_id not in own]
        entry = {"kind": "candidate_consolidation", "discovery_seq_end": self.last_screened_seq, "taxonomy_version": self.schema_version, "candidate_groups": [asdict(g) for g in groups], "consolidation": {"assignments": dict(assignments)}, "resulting_groups": [asdict(g) for g in result]}
        return self._with(entry, candidates=tuple(sorted([*rest, *result], key=lambda g: g.group_id)))

    def told_apart(self) -> set[tuple[str, str]]:
        """Pairs of present candidates that a consolidation kept apart."""
        now, out = {g.group_id for g in self.candidates}, set()
        for entry in self.history:
            if entry["kind"] == "candidate_consolidation":
                to = entry["consolidation"]["assignments"]
                ids = sorted(now & set(to))
                out |= {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if to[a] != to[b]}
        return out

    def eligible(self) -> list[Group]:
        least = self.settings.min_promotion_support
        return sorted((g for g in self.candidates if g.support_count >= least), key=lambda g: (-g.support_count, g.group_id))

    @property
    def slots(self) -> int:
        return self.settings.max_total_labels - len(self.active)

    def promote(self, groups: Sequence[Group], new_labels: Sequence[dict], most: int | None = None) -> Taxonomy:
        """new_labels: candidate_group_ids, name, definition; each group once."""
        own = {g.group_id: g for g in groups}
        _same_ids("promotion", own, [i for n in new_labels for i in n["candidate_group_ids"]])
        if len(new_labels) > (len(groups) if most is None else most):
            raise TaxonomyError("more new labels than allowed")
        names = [normalized(n["name"]) for n in new_labels]
        if len(set(names)) < len(names) or set(names) & {normalized(x.name) for x in self.active}:
            raise TaxonomyError("a new label's name is in use")
        self._must_hold(groups)
        if low := [g.group_id for g in groups if g.support_count < self.settings.min_promotion_support]:
            raise TaxonomyError(f"too little support: {low}")
        if len(new_labels) > self.slots:
            raise TaxonomyError("more labels than the taxonomy may hold")
        version, number, created = self.schema_version + 1, self.next_dynamic_label_num, []
        taken = {x.id for x in self.active} | set(self.alias_map)
        for n in new_labels:
            label_id, number = allocate(number, taken)
            taken.add(label_id)
            created.append(DynamicLabel(label_id, n["name"], n["definition"], version, version, 0, sum(own[i].support_count for i in n["candidate_group_ids"])))
        entry = {"kind": "candidate_promotion", "discovery_seq_end": self.last_screened_seq, "version_before": self.schema_version, "version_after": version, "candidate_groups": [asdict(g) for g in groups], "promotion": {"new_labels": list(new_labels)}, "created_labels": [asdict(x) for x in created]}
        return self._with(entry, schema_version=version, dynamic_labels=(*self.dynamic_labels, *created), candidates=tuple(g for g in self.candidates if g.group_id not in own), next_dynamic_label_num=number)

    def merge(self, merges: Sequence[tuple[str, str]]) -> Taxonomy:
        """merges: (source, target); sources are dynamic, targets active and no sources."""
        sources, dynamic = [s for s, _ in merges], {x.id: x for x in self.dynamic_labels}
        ids = {x.id for x in self.active}
        if len(set(sources)) < len(sources):
            raise TaxonomyError("a label is merged twice")
        for s, t in merges:
            if s not in dynamic or t not in ids or s == t or t in sources:
                raise TaxonomyError(f"{s} can't be merged into {t}")
        version, aliases = self.schema_version + bool(merges), dict(self.alias_map)
        for s, t in merges:
            source = dynamic.pop(s)
            if t in dynamic:
                old = dynamic[t]
                dynamic[t] = replace(old, usage_count=old.usage_count + source.usage_count, proposal_support_count=old.proposal_support_count + source.proposal_support_count, last_modified_version=version)
            aliases = {k: t if v == s else v for k, v in aliases.items()} | {s: t}
        entry = {"kind": "final_merge", "version_before": self.schema_version, "version_after": version, "result": {"merges": [{"source_label_id": s, "target_label_id": t} for s, t in merges]}}
        return self._with(entry, schema_version=version, dynamic_labels=tuple(dynamic.values()), alias_map=aliases)

    def revise(self, revisions: Sequence[Label]) -> Taxonomy:
        new, dynamic = {r.id: r for r in revisions}, {x.id: x for x in self.dynamic_labels}
        if len(new) < len(revisions) or set(new) - set(dynamic):
            raise TaxonomyError("a label is revised twice, or isn't dynamic")
        if same := [i for i, r in new.items() if (r.name, r.definition) == (dynamic[i].name, dynamic[i].definition)]:
            raise TaxonomyError(f"nothing changes in {same}")
        version = self.schema_version + bool(revisions)
        changed = tuple(replace(x, name=new[x.id].name, definition=new[x.id].definition, last_modified_version=version) if x.id in new else x for x in self.dynamic_labels)
        entry = {"kind": "final_revision", "version_before": self.schema_version, "version_after": version, "result": {"revisions": [{"label_id": r.id, "name": r.name, "definition": r.definition} for r in revisions]}}
        return self._with(entry, schema_version=version, dynamic_labels=changed)

    def freeze(self) -> Taxonomy:
        return self._with(frozen=True, frozen_at_unix=int(time.time()), frozen_hash=self.digest())

    def _must_hold(self, groups: Sequence[Group]) -> None:
        pool = {g.group_id: g for g in self.candidates}
        for g in groups:
            if pool.get(g.group_id) != g:
                raise TaxonomyError(f"{g.group_id} isn't in the pool as given")


def _same_ids(what: str, expected, given: list[str]) -> None:
    if len(set(given)) < len(given):
        raise TaxonomyError(f"{what} names a group twice")
    if missing := sorted(set(expected) - set(given)):
        raise TaxonomyError(f"{what} leaves out {missing}")
    if unknown := sorted(set(given) - set(expected)):
        raise TaxonomyError(f"{what} names unknown {unknown}")


def allocate(number: int, taken: set[str]) -> tuple[str, int]:
    """(the next free label id, the number after it)."""
    while f"L{number:03d}" in taken:
        number += 1
    return f"L{number:03d}", number + 1


def sha256(value: Any) -> str:
    text = json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()


def seed_hash(labels: Sequence[Label]) -> str:
    return sha256([{"id": x.id, "name": x.name, "definition": x.definition} for x in labels])


def new_taxonomy(aspect: str, seeds: Sequence[Label], settings: Settings = Settings()) -> Taxonomy:
    if not aspect.strip():
        raise TaxonomyError("the aspect is blank")
    now = int(time.time())
    return Taxonomy(aspect.strip(), tuple(seeds), settings, seed_hash=seed_hash(seeds), created_at_unix=now, updated_at_unix=now).checked()


# --------------------------------------------------------------- persistence


def to_json(t: Taxonomy) -> str:
    d = asdict(t)
    moved = {"settings": "discovery_settings", "candidates": "candidate_proposals", "last_screened_seq": "last_screened_discovery_seq", "frozen_hash": "frozen_taxonomy_hash", "seed_hash": "seed_labels_sha256"}
    return json.dumps({"format_version": FORMAT_VERSION} | {moved.get(k, k): v for k, v in d.items()}, ensure_ascii=False, indent=2)


def from_json(text: str) -> Taxonomy:
    d = json.loads(text)
    if d.pop("format_version", None) != FORMAT_VERSION:
        raise TaxonomyError(f"not a state of format {FORMAT_VERSION}")
    known = Settings.__dataclass_fields__
    settings = Settings(**{k: v for k, v in d.pop("discovery_settings").items() if k in known})
    return Taxonomy(
        aspect=d["aspect"], seed_labels=tuple(Label(**x) for x in d["seed_labels"]), settings=settings, schema_version=d["schema_version"],
        dynamic_labels=tuple(DynamicLabel(**x) for x in d["dynamic_labels"]), alias_map=d["alias_map"], candidates=tuple(Group(**x) for x in d["candidate_proposals"]),
        next_dynamic_label_num=d["next_dynamic_label_num"], last_screened_seq=d["last_screened_discovery_seq"], history=tuple(d["history"]),
        frozen=d["frozen"], frozen_at_unix=d["frozen_at_unix"], frozen_hash=d["frozen_taxonomy_hash"], seed_hash=d["seed_labels_sha256"],
        created_at_unix=d["created_at_unix"], updated_at_unix=d["updated_at_unix"],
    ).checked()


def save(t: Taxonomy, path: str | Path) -> None:
    """Write beside the target, then put it in its place."""
    write_text(path, to_json(t))


def load(path: str | Path) -> Taxonomy:
    return from_json(read_text(path))


def load_seeds(path: str | Path, expected: int | None = None) -> list[Label]:
    """A YAML list of id, name, definition."""
    import yaml

    rows = yaml.safe_load(read_text(path))
    if not isinstance(rows, list) or not all(isinstance(r, dict) and set(r) == {"id", "name", "definition"} for r in rows):
        raise TaxonomyError(f"{path}: not a list of id, name and definition")
    labels = [Label(*(str(r[k]).strip() for k in ("id", "name", "definition"))) for r in rows]
    if any(not v for x in labels for v in (x.id, x.name, x.definition)):
        raise TaxonomyError(f"{path}: a label has a blank field")
    if expected is not None and len(labels) != expected:
        raise TaxonomyError(f"{path}: {len(labels)} labels, not {expected}")
    for what, values in (("id", [x.id for x in labels]), ("name", [normalized(x.name) for x in labels])):
        if len(set(values)) < len(values):
            raise TaxonomyError(f"{path}: a label {what} occurs twice")
    return labels
