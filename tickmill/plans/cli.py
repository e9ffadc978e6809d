"""Command line of the jobs: `python -m tickmill.plans.cli JOB ...`, or by spark-submit. Each writes its report to <out>/reports."""

from __future__ import annotations

import argparse
import json
from functools import partial

from pyspark.sql import SparkSession

from ..config import Config, Settings
from ..sources import evaluator, store
from ..streaming import ingest
from . import jobs


def parser(paths: Settings) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tickmill", description=__doc__)
    p.add_argument("--config", help="JSON or YAML file of parameters")
    p.add_argument("--interim", default=paths.interim, help="folder of filtered games, games and moves")
    p.add_argument("--out", default=paths.processed, help="folder of positions, labels, budgets, pool and reports")
    job = p.add_subparsers(dest="job", required=True)

    def add(name: str, what: str, *options: tuple[str, dict]) -> None:
        sub = job.add_parser(name, help=what)
        for flag, how in options:
            sub.add_argument(flag, **how)

    add("filter", "kept games of a dump by month", ("dump", {}), ("--partitions", {"type": int}))
    add("ingest", "kept games of all files of a folder that no earlier run took", ("folder", {}), ("--checkpoint", {"required": True}), ("--files-per-trigger", {"type": int, "default": 8}))
    add("parse", "games and moves", ("--months", {"nargs": "+", "metavar": "YYYY-MM"}))
    add("puzzles", "outcomes of puzzles of known games", ("puzzles", {}))
    add("sample", "a stratified sample of decisions, replayed", ("--target", {"type": int}))
    add("evaluations", "database evaluations of sampled positions", ("database", {}), ("--also", {"nargs": "+", "default": []}))
    add("label", "labels by an engine", ("--engine", {"default": paths.evaluator}), ("--batch", {"type": int, "default": 50}), ("--limit", {"type": int}))
    add("observations", "decisions joined to labels")
    add("budgets", "time budgets", ("--model", {"default": "m0"}))
    add("pool", "servable positions")
    add("load", "serving tables", ("--serving", {"default": paths.database}), ("--model", {"default": "m0"}))
    return p


def run(spark: SparkSession, argv: list[str] | None = None, paths: Settings | None = None) -> dict:
    """Runs one job; returns its report."""
    a = parser(paths or Settings.from_env()).parse_args(argv)
    cfg = Config.from_file(a.config) if a.config else Config()
    report = {
        "filter": lambda: jobs.filter_games(spark, a.dump, a.interim, cfg, a.partitions),
        "ingest": lambda: _ingested(spark, a, cfg),
        "parse": lambda: jobs.parse_games(spark, a.interim, cfg, a.months),
        "puzzles": lambda: jobs.join_puzzles(spark, a.puzzles, a.interim, a.out),
        "sample": lambda: jobs.sample_positions(spark, a.interim, a.out, cfg, a.target),
        "evaluations": lambda: jobs.lookup_evaluations(spark, a.database, a.out, cfg, tuple(a.also)),
        "label": lambda: {"labelled": jobs.label(spark, a.out, partial(evaluator.UciEvaluator, evaluator.find_binary(a.engine), cfg=cfg), cfg, a.batch, a.limit)},
        "observations": lambda: jobs.build_observations(spark, a.out, cfg),
        "budgets": lambda: jobs.build_budgets(spark, a.out, cfg, a.model),
        "pool": lambda: {"positions": jobs.build_pool(spark, a.interim, a.out, cfg)},
        "load": lambda: jobs.load_app(spark, a.out, a.serving, cfg, a.model),
    }[a.job]()
    store.write_report(spark, f"{a.out}/reports", a.job, report)
    return report


def _ingested(spark: SparkSession, a: argparse.Namespace, cfg: Config) -> dict:
    ingest.ingest(spark, a.folder, a.interim, a.checkpoint, cfg, a.files_per_trigger)
    return {r["reason"]: r["n"] for r in ingest.report(spark, a.interim).collect()}


def main() -> None:
    spark = SparkSession.builder.appName("tickmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        print(json.dumps(run(spark), default=str))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
