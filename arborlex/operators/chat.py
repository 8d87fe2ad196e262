"""Labeler and maintainer on top of any chat model: a function from messages and a
JSON schema to text, or to a Reply, or with a method `many` that takes all requests of
a batch at once. Answers are parsed, held against their schema, and translated to the
ids of the taxonomy; what can't be read is a MalformedOutput."""

from __future__ import annotations

import json
import logging
import re
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any, NamedTuple, Protocol

from arborlex.functions import prompts as P
from arborlex.functions.text import truncate
from arborlex.operators.taxonomy import Group, Label, Taxonomy
from arborlex.plans.discover import MalformedOutput

LOGGER = logging.getLogger(__name__)
Chat = Callable[[P.Messages, dict], "str | Reply"]
Request = tuple[P.Messages, dict]


class Reply(NamedTuple):
    """What a model said, why it ended, and its tokens (where it counts them)."""

    text: str
    finish: str = "stop"
    tokens_in: int | None = None
    tokens_out: int | None = None


class Tokenizer(Protocol):
    """How a model cuts text, and how long a whole prompt is for it."""

    def encode(self, text: str) -> Sequence: ...
    def decode(self, tokens: Sequence) -> str: ...
    def prompt_length(self, messages: P.Messages) -> int: ...


class Words:
    """Words for tokens, where there is no model's tokenizer."""

    def encode(self, text: str) -> list[str]:
        return text.split()

    def decode(self, tokens: Sequence[str]) -> str:
        return " ".join(tokens)

    def prompt_length(self, messages: P.Messages) -> int:
        return sum(len(m["content"].split()) for m in messages)


@dataclass
class Totals:
    """Requests, tokens and seconds so far."""

    requests: int = 0
    tokens_in: int = 0
    tokens_out: int = 0
    seconds: float = 0.0

    def add(self, requests: Sequence[Request], replies: Sequence[Reply], seconds: float) -> None:
        count = Words()
        own_in = sum(count.prompt_length(m) if r.tokens_in is None else r.tokens_in for (m, _), r in zip(requests, replies, strict=True))
        own_out = sum(len(r.text.split()) if r.tokens_out is None else r.tokens_out for r in replies)
        self.requests, self.tokens_in, self.tokens_out, self.seconds = self.requests + len(requests), self.tokens_in + own_in, self.tokens_out + own_out, self.seconds + seconds
        rate = (own_in + own_out) / max(1e-9, seconds)
        LOGGER.info("model: %d requests, %d tokens in, %d out, %.1f a second; %d in and %d out so far", len(requests), own_in, own_out, rate, self.tokens_in, self.tokens_out)


_KINDS = {"object": dict, "array": list, "string": str}


def violation(value: Any, schema: dict, mendable: bool = False, at: str = "answer") -> str | None:
    """What in a value breaks its schema. Limits of texts and lists that mending sees to
    (see fix_output) are left to it if `mendable`."""
    if "anyOf" in schema:
        found = [violation(value, s, mendable, at) for s in schema["anyOf"]]
        return None if None in found else found[0]
    if "const" in schema:
        return None if value == schema["const"] else f"{at} isn't {schema['const']}"
    kind = schema["type"]
    if not isinstance(value, _KINDS[kind]):
        return f"{at} is no {kind}"
    if kind == "string":
        if "enum" in schema:
            return None if value in schema["enum"] else f"{at} has the unknown value {value[:40]!r}"
        fine = mendable or schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)) and re.search(schema.get("pattern", ""), value)
        return None if fine else f"{at} doesn't fit: {value[:40]!r}"
    if kind == "array":
        if not mendable and not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            return f"{at} has {len(value)} items"
        items = ((f"{at}[{i}]", v, schema["items"]) for i, v in enumerate(value))
    else:
        if off := sorted({*schema["properties"]} ^ {*value}):
            return f"{at}: keys {', '.join(map(str, off))} are missing or unknown"
        items = ((f"{at}.{k}", value[k], s) for k, s in schema["properties"].items())
    return next((v for where, x, s in items if (v := violation(x, s, mendable, where))), None)


def _read(reply: Reply, schema: dict, mendable: bool) -> dict | MalformedOutput:
    if reply.finish != "stop":
        return MalformedOutput(f"ended by {reply.finish}, perhaps cut off: {reply.text[-80:]!r}")
    if not reply.text:
        return MalformedOutput("an empty answer")
    try:
        answer = json.loads(reply.text)
    except ValueError:
        return MalformedOutput(f"not JSON: {reply.text[:80]!r}")
    problem = violation(answer, schema, mendable)
    return MalformedOutput(problem) if problem else answer


def ask_many(chat: Chat, requests: Sequence[Request], totals: Totals | None = None, mendable: bool = False) -> list[dict | MalformedOutput]:
    """An answer or what is wrong with it for each request, all asked at once where the
    model can."""
    if not requests:
        return []
    began = time.monotonic()
    many = getattr(chat, "many", None)
    said = list(many(requests)) if many else [chat(m, s) for m, s in requests]
    if len(said) != len(requests):
        raise ValueError(f"{len(said)} answers to {len(requests)} requests")
    replies = [r if isinstance(r, Reply) else Reply(r) for r in said]
    (Totals() if totals is None else totals).add(requests, replies, time.monotonic() - began)
    return [_read(r, schema, mendable) for r, (_, schema) in zip(replies, requests, strict=True)]


def ask(chat: Chat, messages: P.Messages, schema: dict, totals: Totals | None = None) -> dict:
    """The parsed answer, which fits the schema."""
    (answer,) = ask_many(chat, [(messages, schema)], totals)
    if isinstance(answer, MalformedOutput):
        raise answer
    return answer


class ChatLabeler:
    """Labels documents, all of a batch in one call. Texts are cut to so many tokens,
    and further until prompt and answer fit the model's context."""

    def __init__(self, chat: Chat, aspect: str, creativity: str = "low", most_words: int = 8192, most_ids: int = 5, most_proposed: int = 3, tokenizer: Tokenizer | None = None, context: int = 32_768, answer: int = 4096) -> None:
        if answer >= context:
            raise ValueError("the answer leaves no room for a prompt")
        self.chat, self.aspect, self.creativity = chat, aspect, creativity
        self.most, self.most_ids, self.most_proposed = most_words, most_ids, most_proposed
        self.tokenizer, self.budget, self.totals = tokenizer or Words(), context - answer, Totals()

    def messages(self, text: str, labels: Sequence[Label], discover: bool) -> P.Messages:
        """The prompt for a text, cut until it fits."""
        suffix = "\n[TRUNCATED]"
        build = lambda t: P.discovery(t, labels, self.aspect, self.creativity) if discover else P.classification(t, labels, self.aspect)
        length = lambda t: self.tokenizer.prompt_length(build(t))
        if length(suffix) > self.budget:
            raise ValueError("instructions and labels alone are longer than the context")
        whole = self.tokenizer.encode(text)
        cost = lambda tokens: length(text if len(tokens) == len(whole) else self.tokenizer.decode(tokens) + suffix)
        return build(truncate(text, self.most, self.tokenizer.encode, self.tokenizer.decode, cost, self.budget, suffix))

    def __call__(self, texts: Sequence[str], labels: Sequence[Label], discover: bool) -> list[tuple[list[str], list[dict]]]:
        ids = [x.id for x in labels]
        schema = P.discovery_schema(ids, self.most_ids, self.most_proposed) if discover else P.classification_schema(ids, self.most_ids)
        answers = ask_many(self.chat, [(self.messages(t, labels, discover), schema) for t in texts], self.totals, mendable=True)
        if bad := next((a for a in answers if isinstance(a, MalformedOutput)), None):
            raise bad
        return [(a["assigned_label_ids"], a.get("proposed_labels", [])) for a in answers]


class ChatMaintainer:
    """The judgements of maintenance, asked of a model."""

    def __init__(self, chat: Chat) -> None:
        self.chat, self.totals = chat, Totals()

    def _ask(self, messages: P.Messages, schema: dict) -> dict:
        return ask(self.chat, messages, schema, self.totals)

    def screen(self, t: Taxonomy, groups: Sequence[Group]) -> list[dict]:
        (decisions,) = self.screen_many(t, [groups])
        if isinstance(decisions, MalformedOutput):
            raise decisions
        return decisions

    def screen_many(self, t: Taxonomy, chunks: Sequence[Sequence[Group]]) -> list[list[dict] | MalformedOutput]:
        """Decisions on each chunk, or what is wrong with them; one call for all."""
        own = [P.short_ids(c, "P") for c in chunks]
        active = [x.id for x in t.active]
        answers = ask_many(self.chat, [(P.screening(t, o), P.screening_schema(list(o), active)) for o in own], self.totals)
        return [a if isinstance(a, MalformedOutput) else [{"proposal_group_id": g.group_id, **a["decisions"][k]} for k, g in o.items()] for a, o in zip(answers, own, strict=True)]

    def consolidate(self, t: Taxonomy, groups: Sequence[Group]) -> dict[str, str]:
        own = P.short_ids(groups, "C")
        answer = self._ask(P.consolidation(t, own), P.consolidation_schema(list(own)))["assignments"]
        return {g.group_id: own[answer[k]].group_id for k, g in own.items()}

    def promote(self, t: Taxonomy, groups: Sequence[Group]) -> list[dict]:
        own = P.short_ids(groups, "C")
        answer = self._ask(P.promotion(t, own, len(own)), P.promotion_schema(list(own), len(own)))
        return [n | {"candidate_group_ids": [own[i].group_id for i in n["candidate_group_ids"]]} for n in answer["new_labels"]]

    def merge(self, t: Taxonomy) -> list[tuple[str, str]]:
        if not t.dynamic_labels:
            return []
        answer = self._ask(P.merging(t), P.merging_schema([x.id for x in t.dynamic_labels], [x.id for x in t.active]))
        return [(m["source_label_id"], m["target_label_id"]) for m in answer["merges"]]

    def revise(self, t: Taxonomy, ids: Sequence[str]) -> list[Label]:
        if not ids:
            return []
        answer = self._ask(P.revision(t, ids), P.revision_schema(list(ids)))
        return [Label(r["label_id"], r["name"], r["definition"]) for r in answer["revisions"]]
