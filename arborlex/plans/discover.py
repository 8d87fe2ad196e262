"""Taxonomy discovery: documents are labelled in epochs, proposals gathered from the
log, and the taxonomy maintained between epochs until it is frozen.

Labels cannot change within an epoch, so an epoch is one Spark job. Its output is
written once as a directory of the log; the cursor in the saved taxonomy moves only
after everything that depends on it is done, so a run that breaks off is resumed
without loss: finished epochs are read back, documents in them are skipped.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlex.functions import text as T
from arborlex.operators import labels_log as G
from arborlex.operators.candidates import GROUP, neighbourhoods, worth_reviewing
from arborlex.operators.inference import Labeler, label_documents
from arborlex.operators.ordering import with_index
from arborlex.operators.storage import cut, exists
from arborlex.operators.taxonomy import Group, Label, Taxonomy, TaxonomyError, load, new_taxonomy, save
from arborlex.sources.sinks import append_epoch, epochs, read_log

LOGGER = logging.getLogger(__name__)


class MalformedOutput(ValueError):
    """A maintainer's answer that can't be read."""


class Maintainer(Protocol):
    """The judgements that a model (or a rule) makes about the taxonomy."""

    def screen(self, t: Taxonomy, groups: Sequence[Group]) -> list[dict]: ...
    def consolidate(self, t: Taxonomy, groups: Sequence[Group]) -> dict[str, str]: ...
    def promote(self, t: Taxonomy, groups: Sequence[Group]) -> list[dict]: ...
    def merge(self, t: Taxonomy) -> list[tuple[str, str]]: ...
    def revise(self, t: Taxonomy, ids: Sequence[str]) -> list[Label]: ...


class KeepAll:
    """Keeps and promotes every candidate as it is; merges and revises nothing."""

    def screen(self, t: Taxonomy, groups: Sequence[Group]) -> list[dict]:
        names = {T.normalized(x.name): x.id for x in t.active}
        return [
            {"proposal_group_id": g.group_id, "action": "map_existing", "target_label_id": names[T.normalized(g.name)]}
            if T.normalized(g.name) in names
            else {"proposal_group_id": g.group_id, "action": "keep_candidate"}
            for g in groups
        ]

    def consolidate(self, t: Taxonomy, groups: Sequence[Group]) -> dict[str, str]:
        return {g.group_id: g.group_id for g in groups}

    def promote(self, t: Taxonomy, groups: Sequence[Group]) -> list[dict]:
        by_name: dict[str, dict] = {}
        for g in groups:
            new = by_name.setdefault(T.normalized(g.name), {"candidate_group_ids": [], "name": g.name, "definition": g.definition})
            new["candidate_group_ids"].append(g.group_id)
        return list(by_name.values())

    def merge(self, t: Taxonomy) -> list[tuple[str, str]]:
        return []

    def revise(self, t: Taxonomy, ids: Sequence[str]) -> list[Label]:
        return []


def screen_resiliently(m: Maintainer, t: Taxonomy, groups: Sequence[Group]) -> list[dict]:
    """The maintainer's decisions; where an answer can't be read, halves are asked
    for, down to single groups, which are then kept."""
    try:
        return m.screen(t, groups)
    except MalformedOutput:
        if len(groups) == 1:
            LOGGER.warning("no readable decision on %s: kept", groups[0].group_id)
            return [{"proposal_group_id": groups[0].group_id, "action": "keep_candidate"}]
        half = len(groups) // 2
        return screen_resiliently(m, t, groups[:half]) + screen_resiliently(m, t, groups[half:])


# ------------------------------------------------------------------ the log


def check_log(log: DataFrame, t: Taxonomy) -> int:
    """The last seq; raises if the log isn't one of this taxonomy."""
    if bad := G.record_problems(log).first():
        raise TaxonomyError(f"document {bad.doc_id}: {bad.problem}")
    state = G.seq_gaps(log).first()
    if state.records and not state.contiguous:
        raise TaxonomyError("the log's seq isn't contiguous")
    if twice := G.duplicates(log, "doc_id").first():
        raise TaxonomyError(f"document {twice.doc_id} is in the log twice")
    newer = log.agg(F.max("taxonomy_version")).first()[0]
    if newer is not None and newer > t.schema_version:
        raise TaxonomyError("the log is of a newer taxonomy")
    spark = log.sparkSession
    unknown = G.unknown_labels(log, _ids(spark, [x.id for x in t.active]), _aliases(spark, t)).first()
    if unknown:
        raise TaxonomyError(f"document {unknown.doc_id} has the unknown label {unknown.label_id}")
    ids = log.select(F.explode("proposed_labels.proposal_id").alias("proposal_id"))
    if twice := G.duplicates(ids, "proposal_id").first():
        raise TaxonomyError(f"proposal {twice.proposal_id} is in the log twice")
    return state.latest_seq


def _ids(spark: SparkSession, ids: list[str]) -> DataFrame:
    return spark.createDataFrame([(i,) for i in ids], "id string")


def _aliases(spark: SparkSession, t: Taxonomy) -> DataFrame:
    return spark.createDataFrame(list(t.alias_map.items()), "source string, target string")


class DiscoveryLog:
    """The log's epochs and what is known of them: the last seq of each, and how often
    each id was assigned. The whole log is read and checked once, when a run begins;
    after that only epochs that are added, and those whose proposals are due."""

    def __init__(self, spark: SparkSession, folder: str, t: Taxonomy) -> None:
        self.spark, self.folder = spark, folder
        own = epochs(folder)
        whole = read_log(spark, folder, G.LOG, only=own)
        self.latest = check_log(whole, t)
        self.uses = {r.label_id: r.uses for r in G.raw_usage(whole).collect()}  # as many as there were labels
        numbered = whole.select("seq", F.regexp_extract(F.input_file_name(), r"epoch=(\d+)", 1).cast("int").alias("epoch"))
        self.last = {r.epoch: r.s for r in numbered.groupBy("epoch").agg(F.max("seq").alias("s")).collect()}  # one row for each epoch
        self.last |= {e: 0 for e in own if e not in self.last}

    def append(self, records: DataFrame, t: Taxonomy, epoch: int | None = None) -> None:
        """Records of seq latest + 1 and on, checked once written."""
        epoch = max(self.last, default=0) + 1 if epoch is None else epoch
        append_epoch(records, self.folder, epoch)
        new = read_log(self.spark, self.folder, G.LOG, only=[epoch])
        latest = self.latest + check_log(new.withColumn("seq", F.col("seq") - self.latest), t)
        for r in G.raw_usage(new).collect():
            self.uses[r.label_id] = self.uses.get(r.label_id, 0) + r.uses
        self.latest = self.last[epoch] = latest

    def after(self, seq: int) -> DataFrame:
        """The epochs that hold records beyond a seq."""
        return read_log(self.spark, self.folder, G.LOG, only=sorted(e for e, last in self.last.items() if last > seq))

    def all(self) -> DataFrame:
        return read_log(self.spark, self.folder, G.LOG, only=sorted(self.last))

    def usage(self, t: Taxonomy) -> dict[str, int]:
        """Uses of each dynamic label, counted by what ids stand for now."""
        out = {x.id: 0 for x in t.dynamic_labels}
        for label, n in self.uses.items():
            if (now := t.resolve(label)) in out:
                out[now] += n
        return out


# -------------------------------------------------------------- maintenance


def _chunks(items: Sequence, size: int) -> list[list]:
    return [list(items[i : i + size]) for i in range(0, len(items), size)]


def screen_new(log: DiscoveryLog, t: Taxonomy, m: Maintainer) -> Taxonomy:
    """Usage counts anew, repeats of candidates counted, new groups screened in
    chunks; the cursor moves with the last of them, or not at all. What a maintenance
    leaves due is what an epoch adds; more (a long stream batch, a run that broke off)
    is gone through in parts of that size, so the driver holds no more at once."""
    most = t.settings.screen_every + t.settings.batch_size
    t = t.with_usage(log.usage(t)) if t.dynamic_labels else t
    while True:
        upto = min(log.latest, t.last_screened_seq + most)
        found = G.proposal_groups(G.proposals(log.after(t.last_screened_seq), t.last_screened_seq).where(F.col("seq") <= upto))
        # at most `most` documents' proposals
        rows = found.orderBy("group_id").collect()
        t, new = t.accumulate([Group(r.group_id, r.name, r.definition, r.support_count) for r in rows])
        chunks = _chunks(new, t.settings.max_screening_groups)
        answers = screen_chunks(m, t, chunks)
        for chunk, decisions in zip(chunks, answers, strict=True):
            t = t.screen(chunk, decisions, upto)
        t = t._with(last_screened_seq=upto)
        if upto >= log.latest:
            return t


def screen_chunks(m: Maintainer, t: Taxonomy, chunks: Sequence[Sequence[Group]]) -> list[list[dict]]:
    """Decisions on each chunk: all asked for at once where the maintainer can, and
    those that can't be read once more by halves."""
    many = getattr(m, "screen_many", None)
    answers = many(t, chunks) if many and len(chunks) > 1 else [MalformedOutput()] * len(chunks)
    return [screen_resiliently(m, t, c) if isinstance(a, MalformedOutput) else a for c, a in zip(chunks, answers, strict=True)]


def consolidate_pool(spark: SparkSession, t: Taxonomy, m: Maintainer) -> Taxonomy:
    """Similar candidates, where they have enough support together, are put to the
    maintainer. An unreadable or wrong answer leaves its candidates as they are."""
    if len(t.candidates) < 2:
        return t
    pool = spark.createDataFrame([(g.group_id, g.name, g.definition, g.support_count) for g in t.candidates], GROUP)
    apart = t.told_apart()
    excluded = spark.createDataFrame(sorted(apart), "left_id string, right_id string") if apart else None
    s = t.settings
    members = neighbourhoods(pool, [s.candidate_consolidation_min_name_similarity], s.candidate_consolidation_max_groups, excluded)
    rows = worth_reviewing(members, pool, s.min_promotion_support).orderBy("seed_id", "member_pos").collect()
    own, batches = {g.group_id: g for g in t.candidates}, {}
    for r in rows:
        batches.setdefault(r.seed_id, []).append(own[r.group_id])
    for batch in batches.values():
        try:
            t = t.consolidate(batch, m.consolidate(t, batch))
        except (MalformedOutput, TaxonomyError) as e:
            LOGGER.warning("candidates %s stay as they are: %s", [g.group_id for g in batch], e)
    return t


def promote_eligible(t: Taxonomy, m: Maintainer) -> Taxonomy:
    """Candidates with enough support become labels while there is room, in batches
    that are screened once more against the labels of the moment."""
    while t.slots > 0 and (ready := t.eligible()):
        batch = ready[: min(t.settings.max_promotion_groups, t.slots)]
        decisions = screen_resiliently(m, t, batch)
        t = t.screen(batch, decisions, t.last_screened_seq)
        kept = {d["proposal_group_id"] for d in decisions if d["action"] == "keep_candidate"}
        if batch := [g for g in batch if g.group_id in kept]:
            t = t.promote(batch, m.promote(t, batch))
    return t


def maintain(log: DiscoveryLog, t: Taxonomy, m: Maintainer, path: str | None = None) -> Taxonomy:
    """Screening, consolidation and promotion; saved after each, if there is a path."""
    for step in (lambda t: screen_new(log, t, m), lambda t: consolidate_pool(log.spark, t, m), lambda t: promote_eligible(t, m)):
        t = step(t)
        if path:
            save(t, path)
    return t


def finish(spark: SparkSession, t: Taxonomy, m: Maintainer) -> Taxonomy:
    """Consolidates once, merges and promotes until nothing is promoted, and revises
    once. Nothing is saved: only the frozen taxonomy is."""
    t = consolidate_pool(spark, t, m)
    while True:
        t = t.merge(m.merge(t) if t.dynamic_labels else [])
        version = t.schema_version
        t = promote_eligible(t, m)
        if t.schema_version == version:
            break
    for ids in _chunks([x.id for x in t.dynamic_labels], t.settings.max_revision_labels):
        t = t.revise(m.revise(t, ids))
    return t


# ------------------------------------------------------------------- program


def label_epoch(docs: DataFrame, labeler: Labeler, t: Taxonomy, first_seq: int) -> DataFrame:
    """Log records of documents, labelled against the present taxonomy."""
    s = t.settings
    done = cut(label_documents(docs.select("doc_id", "text"), labeler, t.active, True, batch=s.batch_size, most_ids=s.max_assigned_labels_per_doc, most_proposed=s.max_proposals_per_doc), "labels")
    bad = F.raise_error(F.concat("doc_id", F.lit(": "), "problem")).cast("string")
    rows = done.withColumn("doc_id", F.when(F.col("problem").isNotNull(), bad).otherwise(F.col("doc_id")))
    ids = F.transform("proposed_labels", lambda p, i: F.struct(T.proposal_id(F.col("doc_id"), i, p["name"], p["definition"]).alias("proposal_id"), p["name"].alias("name"), p["definition"].alias("definition")))
    return with_index(rows, "doc_id").select((F.col("pos") + first_seq).alias("seq"), "doc_id", F.lit(t.schema_version).cast("long").alias("taxonomy_version"), "assigned_label_ids", ids.alias("proposed_labels"))


def epoch_size(t: Taxonomy, lag: int) -> int:
    """Documents until maintenance is due, in whole batches, one at least."""
    b = t.settings.batch_size
    return max(1, math.ceil((t.settings.screen_every - lag) / b)) * b


def discover(docs: DataFrame, labeler: Labeler, m: Maintainer, seeds: Sequence[Label], aspect: str, folder: str, settings=None, max_documents: int | None = None, freeze: bool = True) -> Taxonomy:
    """Runs, or resumes, discovery over docs (doc_id, text) in `folder`."""
    spark = docs.sparkSession
    state, log_dir = f"{folder}/taxonomy_state.json", f"{folder}/discovery"
    t = load(state) if exists(state) else None
    if t is None and epochs(log_dir):
        raise TaxonomyError(f"{folder} has a log but no taxonomy")
    fresh = new_taxonomy(aspect, seeds, *([settings] if settings else []))
    if t is None:
        t = fresh
        save(t, state)
    if t.frozen:
        raise TaxonomyError("the taxonomy is frozen")
    if (t.settings, t.seed_hash, t.aspect) != (fresh.settings, fresh.seed_hash, fresh.aspect):
        raise TaxonomyError("settings, seed labels or aspect aren't those of the run so far")
    if docs.isEmpty():
        raise TaxonomyError("no documents")
    if twice := G.duplicates(docs.select("doc_id"), "doc_id").first():
        raise TaxonomyError(f"document {twice.doc_id} is there twice")
    log = DiscoveryLog(spark, log_dir, t)
    if t.last_screened_seq > log.latest:
        raise TaxonomyError("the taxonomy has seen more than the log holds")
    if max_documents is None and (orphan := G.orphans(log.all(), docs).first()):
        raise TaxonomyError(f"the log's document {orphan.doc_id} isn't in the input")
    # numbered and written once, in order: an epoch reads its own stretch of files
    begin = log.latest
    left = G.pending(docs.select("doc_id", "text"), log.all())
    if max_documents is not None:
        left = left.orderBy("doc_id").limit(max(0, max_documents - begin))
    left = cut(with_index(left, "doc_id"), "pending")
    count = left.count()
    while True:
        if log.latest - t.last_screened_seq >= t.settings.screen_every:
            t = maintain(log, t, m, state)
            continue
        done = log.latest - begin
        size = min(epoch_size(t, log.latest - t.last_screened_seq), count - done)
        if size <= 0:
            break
        todo = left.where((F.col("pos") >= done) & (F.col("pos") < done + size)).select("doc_id", "text")
        log.append(label_epoch(todo, labeler, t, log.latest + 1), t)
    t = maintain(log, t, m, state)
    if not freeze:
        return t
    t = finish(spark, t, m)
    if t.eligible() and t.slots > 0:
        raise TaxonomyError("candidates were left that should have been promoted")
    t = t.freeze()
    save(t, state)
    return t
