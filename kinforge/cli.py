"""Commands: clean, block, sweep, check."""

from __future__ import annotations

import argparse
import os
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from .operators import checker
from .plans import cleaning, linkage
from .schema import BlockingConfig, PublicationTransactionError, QualityCheckError, StructuralIntegrityError


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kinforge")
    commands = top.add_subparsers(dest="command", required=True)
    clean = commands.add_parser("clean")
    clean.add_argument("--input-dir", type=Path, required=True)
    clean.add_argument("--output-dir", type=Path, required=True)
    clean.add_argument("--split", choices=["all", "train", "test"], default="all")
    clean.add_argument("--quiet", action="store_true")
    for name in ("block", "sweep"):
        p = commands.add_parser(name)
        p.add_argument("--split", choices=["train", "test", "val"], default="train")
        p.add_argument("--input-dir", type=Path, default=Path("cleaned"))
        p.add_argument("--output-dir", type=Path, default=Path("candidates"))
        p.add_argument("--ground-truth", type=Path, default=Path("dataset/train/train_ground_truth.tsv"))
        p.add_argument("--max-s1", type=int)
        p.add_argument("--max-cands", type=int)
        p.add_argument("--max-candidates-per-s1-per-source", "--cap", dest="cap", type=int, default=BlockingConfig().max_candidates_per_source)
        p.add_argument("--sweep-caps", "--caps", dest="caps", help="caps with commas between, or default; block then sweeps")
        p.add_argument("--workers", type=int, default=4, help="cores of a local session that is started here")
        p.add_argument("--reuse-store", action="store_true", help="take the pairs that an earlier sweep wrote to the output folder")
        p.add_argument("--reuse", help="take the pairs of this folder")
        p.add_argument("--holdout-ratio", type=float, default=BlockingConfig().holdout_ratio)
        p.add_argument("--holdout-salt", default=BlockingConfig().holdout_salt)
        p.add_argument("--quiet", action="store_true")
    check = commands.add_parser("check")
    check.add_argument("-m", "--matching", required=True)
    check.add_argument("-c", "--candidates")
    check.add_argument("-t", "--test-dir", required=True)
    check.add_argument("--check-ids", action="store_true")
    return top


def caps_of(text: str | None) -> tuple[int, ...]:
    """The caps that an option names; the default ones for default, true, yes, all or nothing."""
    if text is None or text.lower() in ("default", "true", "yes", "all", ""):
        return linkage.CAPS
    return tuple(int(x) for x in text.split(",") if x.strip())


def _session(args: argparse.Namespace) -> SparkSession:
    builder = SparkSession.builder.appName("kinforge")
    if "workers" in args and "MASTER" not in os.environ and "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.master(f"local[{args.workers}]")
    return builder.getOrCreate()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or _session(args)
    say = (lambda text: None) if getattr(args, "quiet", False) else print
    try:
        if args.command == "clean":
            cleaning.run_cleaning_pipeline(spark, args.input_dir, args.output_dir, ["train", "test"] if args.split == "all" else [args.split], say)
        elif args.command == "check":
            errors, warnings = checker.validate(spark, args.matching, args.candidates, args.test_dir, args.check_ids, print)
            for w in warnings:
                print(f"warning: {w}")
            for i, e in enumerate(errors, 1):
                print(f"{i}. {e}")
            return int(bool(errors))
        else:
            config = BlockingConfig(max_candidates_per_source=args.cap, holdout_ratio=args.holdout_ratio, holdout_salt=args.holdout_salt)
            sweeps = args.command == "sweep" or args.caps is not None
            split, only = ("train", True) if args.split == "val" else (args.split, args.command == "sweep")
            if sweeps:
                store = args.output_dir / linkage.STORE
                reuse = args.reuse or (str(store) if args.reuse_store and store.exists() else None)
                path, table, report = linkage.run_cap_sweep(spark, args.input_dir, args.output_dir, args.ground_truth, caps_of(args.caps), split, config, only, args.max_s1, args.max_cands, reuse)
                say(f"{path}\n{table}\nrecommended cap: {report['recommended_cap']}")
            else:
                lists, path, _ = linkage.run_blocking_pipeline(spark, args.input_dir, args.output_dir, split, config, args.ground_truth, only, args.max_s1, args.max_cands)
                say(f"{lists}\n{path}")
    except (StructuralIntegrityError, QualityCheckError, PublicationTransactionError, FileNotFoundError) as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
