"""Command line: discover, classify, sweep. A YAML file may give defaults; what is on
the command line wins. `${run_name}` in the file's values is replaced."""

from __future__ import annotations

import argparse
import contextlib
import dataclasses
import logging
import re
import sys

from arborlex.operators.taxonomy import Settings

RUN_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")
LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
_SETTINGS = {f.name for f in dataclasses.fields(Settings) if not f.name.startswith("input_")}
_CONSOLIDATION = {n for n in _SETTINGS if n.startswith("candidate_consolidation_")}
#: What may stand where in the file: outside of sections, and in each section.
_TOP = {"program", "aspect", "run_name"}
SECTIONS = {
    "model": {"model_name", "batch_size", "max_document_tokens", "seed"},
    "paths": {"input", "format", "dataset_input", "dataset_config", "dataset_split", "folder", "output", "seed_labels", "taxonomy"},
    "discovery": {"max_assigned_labels_per_doc", "max_proposals_per_doc", "creativity", "max_documents"},
    "maintenance": {"screen_every", "max_screening_groups", "max_promotion_groups", "max_revision_labels", "min_promotion_support", "max_total_labels", "expected_seed_label_count", *_CONSOLIDATION},
    "sweep": {"thresholds", "promotion_support", "respect_history"},
    "runtime": {"log_level", "compute_logging", "compute_logging_interval", "reset_discovery", "overwrite_output"},
}
#: Keys of earlier files, and what they became.
OBSOLETE = {("reconcile",): "the section maintenance", ("model", "reconcile_max_tokens"): "model.maintenance_max_tokens"}
_FLAGS = ("compute_logging", "reset_discovery", "overwrite_output", "respect_history")


def config_defaults(path: str, run_name: str | None = None) -> dict:
    """Keys and values of the file, sections flattened. A key that doesn't belong where
    it stands is an error, an obsolete one an error that says what took its place."""
    import yaml

    from arborlex.operators.storage import read_text

    raw = yaml.safe_load(read_text(path)) or {}
    if not isinstance(raw, dict):
        raise ValueError(f"{path}: not a mapping")
    for keys, now in OBSOLETE.items():
        inner = raw
        for k in keys:
            inner = inner.get(k, None) if isinstance(inner, dict) and k in inner else None
        if inner is not None:
            raise ValueError(f"{path}: {'.'.join(keys)} is obsolete, use {now}; unknown keys are not read")
    flat: dict = {}
    for key, value in raw.items():
        if key in SECTIONS:
            if not isinstance(value, dict):
                raise ValueError(f"{path}: the section {key} is not a mapping")
            own = {str(k).replace("-", "_"): v for k, v in value.items()}
            if unknown := sorted(set(own) - SECTIONS[key]):
                raise ValueError(f"{path}: unknown keys {', '.join(unknown)} in the section {key}")
            flat |= own
        elif key.replace("-", "_") in _TOP:
            flat[key.replace("-", "_")] = value
        else:
            raise ValueError(f"{path}: unknown keys {key}")
    name = run_name or flat.get("run_name")
    if name is not None and not (isinstance(name, str) and RUN_NAME.fullmatch(name)):
        raise ValueError(f"{name!r} is no run name")
    for k, v in flat.items():
        if isinstance(v, str) and "${run_name}" in v:
            if name is None:
                raise ValueError(f"{path}: {k} needs a run name")
            flat[k] = v = v.replace("${run_name}", name)
        if isinstance(v, str) and "${" in v:
            raise ValueError(f"{path}: {k} has a placeholder that stands for nothing")
    return flat


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="arborlex", description=__doc__)
    p.add_argument("program", choices=("discover", "classify", "sweep"))
    p.add_argument("--config")
    p.add_argument("--run-name")
    p.add_argument("--input")
    p.add_argument("--dataset-input", help="a hub's dataset, instead of --input")
    p.add_argument("--dataset-config")
    p.add_argument("--dataset-split", default="train")
    p.add_argument("--dataset-loader", help="module:function that streams it")
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--log-level", default="INFO")
    p.add_argument("--compute-logging", action="store_true")
    p.add_argument("--compute-logging-interval", type=float, default=300.0)
    p.add_argument("--devices", type=int, default=1)
    p.add_argument("--reset-discovery", action="store_true")
    p.add_argument("--overwrite-output", action="store_true")
    p.add_argument("--format", choices=("jsonl", "parquet"), default="jsonl")
    p.add_argument("--folder")
    p.add_argument("--output")
    p.add_argument("--taxonomy")
    p.add_argument("--seed-labels")
    p.add_argument("--aspect", default="topic")
    p.add_argument("--max-documents", type=int)
    p.add_argument("--thresholds", default="60,70,80,90,100")
    p.add_argument("--promotion-support", type=int, default=2)
    p.add_argument("--respect-history", action="store_true")
    for f in dataclasses.fields(Settings):
        if f.name in _SETTINGS:
            p.add_argument("--" + f.name.replace("_", "-"), type=type(f.default), default=f.default)
    return p


def arguments(argv: list[str]) -> argparse.Namespace:
    p = parser()
    first, _ = p.parse_known_args(argv)
    if first.config:
        p.set_defaults(**config_defaults(first.config, first.run_name))
    args = p.parse_args(argv)
    needs = {"discover": ("folder", "seed_labels"), "classify": ("taxonomy", "output"), "sweep": ("taxonomy", "folder")}[args.program]
    if missing := [n for n in needs if not getattr(args, n)]:
        p.error(f"{args.program} needs {', '.join('--' + n.replace('_', '-') for n in missing)}")
    if args.program != "sweep" and (args.input is None) == (args.dataset_input is None):
        p.error("give exactly one of --input and --dataset-input")
    try:
        validate(args)
    except ValueError as e:
        p.error(str(e))
    return args


def validate(args: argparse.Namespace) -> None:
    """Values from the file come as YAML has them: their kinds are checked, too."""
    whole = lambda v: isinstance(v, int) and not isinstance(v, bool)
    flag = lambda n: "--" + n.replace("_", "-")
    for n in _FLAGS:
        if not isinstance(getattr(args, n), bool):
            raise ValueError(f"{flag(n)} must be true or false")
    if not whole(args.seed) or args.seed < 0:
        raise ValueError("--seed must be a whole number from 0")
    if args.log_level not in LOG_LEVELS:
        raise ValueError(f"--log-level must be one of {', '.join(LOG_LEVELS)}")
    if args.max_documents is not None and (not whole(args.max_documents) or args.max_documents < 1):
        raise ValueError("--max-documents must be at least 1")
    for f in dataclasses.fields(Settings):
        if f.name in _SETTINGS and isinstance(f.default, int) and (not whole(v := getattr(args, f.name)) or v < 1):
            raise ValueError(f"{flag(f.name)} must be a whole number from 1")
    for n, least in (("promotion_support", 1), ("devices", 1)):
        if not whole(getattr(args, n)) or getattr(args, n) < least:
            raise ValueError(f"{flag(n)} must be a whole number from {least}")
    interval = args.compute_logging_interval
    if isinstance(interval, bool) or not isinstance(interval, (int, float)) or interval <= 0:
        raise ValueError("--compute-logging-interval must be above 0")
    if args.max_total_labels < args.expected_seed_label_count:
        raise ValueError("--max-total-labels must leave room for the seed labels")


def main(argv: list[str] | None = None, spark=None, labeler=None, maintainer=None) -> None:
    """labeler and maintainer default to the lexical ones, which need no model."""
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from arborlex.operators.inference import LexicalLabeler
    from arborlex.operators.storage import remove
    from arborlex.operators.taxonomy import load, load_seeds
    from arborlex.plans.classify import run_classification
    from arborlex.plans.discover import KeepAll, discover
    from arborlex.plans.sweep import load_pool, parse_thresholds, sweep, write_reports
    from arborlex.sources.documents import fingerprint, read_input
    from arborlex.sources.sinks import epochs
    from arborlex.streaming.progress import Ticker

    args = arguments(sys.argv[1:] if argv is None else argv)
    logging.basicConfig(level=args.log_level)
    spark = spark or SparkSession.builder.appName("arborlex").getOrCreate()

    def documents():
        if args.dataset_input is not None:
            return read_input(spark, dataset=args.dataset_input, config=args.dataset_config, split=args.dataset_split, loader=args.dataset_loader)
        return read_input(spark, **{args.format: args.input})

    def ticking(folder: str):
        """Tells of the finished epochs in a folder, if asked to."""
        if not args.compute_logging:
            return contextlib.nullcontext()
        done = lambda: sum(spark.read.parquet(f"{folder}/epoch={e}").count() for e in epochs(folder))
        return Ticker(lambda: (done(), args.max_documents), args.compute_logging_interval, args.devices)

    if args.program == "discover":
        if args.reset_discovery:  # the log and the state that is made from it
            remove(f"{args.folder}/discovery")
            remove(f"{args.folder}/taxonomy_state.json")
        path = (args.dataset_input, 0, 0) if args.dataset_input is not None else fingerprint(spark, args.input)
        settings = Settings(*path, **{k: getattr(args, k) for k in _SETTINGS})
        seeds = load_seeds(args.seed_labels, settings.expected_seed_label_count)
        with ticking(f"{args.folder}/discovery"):
            discover(documents(), labeler or LexicalLabeler(), maintainer or KeepAll(), seeds, args.aspect, args.folder, settings, args.max_documents)
    elif args.program == "classify":
        if args.overwrite_output:
            remove(args.output)
            remove(f"{args.output}.meta.json")
        t = load(args.taxonomy)
        with ticking(args.output):
            run_classification(documents(), labeler or LexicalLabeler(fallback=t.active[0].id), t, args.output, args.input or args.dataset_input, args.max_documents)
    else:
        apart = sorted(load(args.taxonomy).told_apart()) if args.respect_history else []
        excluded = spark.createDataFrame(apart, "left_id string, right_id string") if apart else None
        s = sweep(load_pool(spark, args.taxonomy), parse_thresholds(args.thresholds), args.candidate_consolidation_max_groups, excluded)
        write_reports(s, args.folder, args.promotion_support)
        s.summary(args.promotion_support).orderBy(F.col("threshold").cast("double")).show(truncate=False)


if __name__ == "__main__":
    main()
