"""The cleaning plan: validate all files, clean and profile them, verify what was written, publish all or nothing."""

from __future__ import annotations

import os
import shutil
import time
from collections.abc import Callable, Iterable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, profiling
from ..schema import FLAG_COLUMNS, OUTPUT_COLUMNS, PublicationTransactionError, QualityCheckError, StructuralIntegrityError
from ..sources import tsv


def discover(input_dir: Path, splits: Iterable[str]) -> list[tuple[str, Path, str]]:
    """Split, file and id prefix of each source file; all must exist."""
    found = [(split, Path(input_dir) / split / f"{split}_source{n}.tsv", f"S{n}-") for split in splits for n in (1, 2, 3)]
    for _, path, _ in found:
        if not path.is_file():
            raise FileNotFoundError(path)
    return found


def profile(rows: DataFrame) -> dict:
    """The profile of a cleaned frame as nested dicts; all that comes to the driver are aggregates."""

    def nested(frame: DataFrame, outer: str, inner: str, value: str) -> dict:
        out: dict = {}
        for r in frame.orderBy(outer, inner).collect():
            out.setdefault(r[outer], {})[r[inner]] = r[value]
        return out

    lengths = {}
    for r in profiling.length_quantiles(profiling.length_counts(rows)).collect():
        lengths[r["column"]] = {"count": r["n"], "min": r["min_length"], "max": r["max_length"], "mean": round(r["total_length"] / r["n"], 2), "quantiles": {f"p{int(p * 100)}": r[f"p{int(p * 100)}"] for p in profiling.PERCENTILES}}
    examples: dict = {}
    for r in profiling.length_examples(rows).orderBy("column", "kind", "rank").collect():
        examples.setdefault(r["column"], {}).setdefault(r["kind"], []).append({"entity_id": r["entity_id"], "value": r["value"], "length": len(r["value"])})
    missing = {r["column"]: r for r in profiling.missing_counts(rows).collect()}
    return {
        "row_count": rows.count(),
        "headers": OUTPUT_COLUMNS,
        "missing_counts": {c: r["missing"] for c, r in missing.items()},
        "empty_string_counts": {c: r["empty"] for c, r in missing.items()},
        "unicode_non_ascii_counts": {c: r["non_ascii"] for c, r in missing.items()},
        "script_counts": nested(profiling.script_counts(rows), "column", "kind", "n"),
        "suspicious_symbol_counts": nested(profiling.suspicious_counts(rows), "column", "kind", "n"),
        "length_summaries": lengths,
        "length_examples": examples,
        "repeated_values": {r["kind"]: {"values": r["values"], "rows": r["rows"]} for r in profiling.repeats(rows).collect()},
        "country_counts": {r["country"]: r["n"] for r in profiling.country_counts(rows).orderBy("country").collect()},
    }


def clean_and_profile_file(spark: SparkSession, input_path: Path, output_path: Path, prefix: str = "") -> dict:
    """Write the cleaned file of a valid input and return its profile."""
    rows = cleaning.clean(tsv.read_raw(spark, str(input_path))).persist()
    try:
        bad = rows.where(~F.col("entity_id").startswith(prefix)).orderBy("line").first()
        if bad:
            raise StructuralIntegrityError(str(input_path), bad["line"], f"Inconsistent entity_id prefix: '{bad['entity_id']}', expected '{prefix}'")
        shown = [F.when(F.col(c), "True").otherwise("False") if c in FLAG_COLUMNS else F.col(c) for c in OUTPUT_COLUMNS]
        output_path.parent.mkdir(parents=True, exist_ok=True)
        tsv.write_lines(rows.select("line", F.concat_ws("\t", *shown).alias("value")), "line", output_path, "\t".join(OUTPUT_COLUMNS))
        return {"file_name": input_path.name} | profile(rows)
    finally:
        rows.unpersist()


def publish(staged: Path, target: Path, items: list[str], fail: Callable[[str], None] = lambda point: None) -> None:
    """Move the staged items into target. What stood there is put back if anything fails; other items stay."""
    backup = target / f".backup-{time.time_ns()}-{os.getpid()}"
    backup.mkdir()
    saved: list[str] = []
    moved: list[str] = []
    try:
        for item in items:
            if (target / item).exists():
                (target / item).rename(backup / item)
                saved.append(item)
                fail(f"backup {len(saved)}")
        for item in items:
            (staged / item).rename(target / item)
            moved.append(item)
            fail(f"publish {len(moved)}")
    except Exception as error:
        for item in moved:
            shutil.rmtree(target / item)
        for item in saved:
            (backup / item).rename(target / item)
        raise PublicationTransactionError(str(error)) from error
    finally:
        shutil.rmtree(backup, ignore_errors=True)


def run_cleaning_pipeline(spark: SparkSession, input_dir: Path, output_dir: Path, splits: list[str], say: Callable[[str], None] = lambda text: None, fail: Callable[[str], None] = lambda point: None) -> tuple[dict, dict]:
    """Profile and quality reports; output_dir gets the cleaned splits and the reports, or stays as it was."""
    began = time.time()
    output_dir = Path(output_dir)
    files = discover(input_dir, splits)
    for _, path, prefix in files:
        say(f"{path.name}: {cleaning.validate_input_file(spark, str(path), prefix)} rows are valid")
    output_dir.mkdir(parents=True, exist_ok=True)
    staged = output_dir / f".staging-{time.time_ns()}-{os.getpid()}"
    try:
        profiles, checks, manifest = {}, {}, {}
        for split, path, prefix in files:
            name, out = f"{split}/{path.name}", staged / split / path.name
            profiles[name] = clean_and_profile_file(spark, path, out, prefix)
            checks[name] = cleaning.verify_file_quality(spark, str(path), str(out), prefix)
            if checks[name]["status"] != "PASSED":
                raise QualityCheckError(f"{name}: {'; '.join(checks[name]['errors'])}")
            manifest[name] = {"rows": profiles[name]["row_count"], "sha256": tsv.sha256_file(out)}
            say(f"{name}: cleaned and verified")
        now = datetime.now(UTC).isoformat()
        total = sum(p["row_count"] for p in profiles.values())
        profile_report = {"title": "Profile", "timestamp": now, "summary": {"total_files": len(files), "total_rows": total, "splits": splits, "elapsed_seconds": round(time.time() - began, 2)}, "files": profiles}
        quality_report = {"title": "Quality checks", "timestamp": now, "status": "PASSED", "summary": {"total_files_checked": len(files), "total_rows_checked": total, "all_checks_passed": True}, "invariants_checked": cleaning.HEADER_INVARIANTS + cleaning.INVARIANTS, "file_checks": checks}
        (staged / "reports").mkdir()
        tsv.write_json(staged / "reports" / "profile.json", profile_report)
        tsv.write_json(staged / "reports" / "quality_checks.json", quality_report)
        tsv.write_json(staged / "reports" / "manifest.json", {"generation_id": staged.name, "created_at": now, "splits": splits, "files": manifest})
        publish(staged, output_dir, [*dict.fromkeys(splits), "reports"], fail)
        return profile_report, quality_report
    finally:
        shutil.rmtree(staged, ignore_errors=True)
