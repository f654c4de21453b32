"""Registered queries over files: the entity view is written as raw tables and goes through the plans over files.

The files stand in a folder of the driver, as the plans over files publish on its file system; they are made once for
a folder of tables and removed at the end of the process.
"""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checker, cleaning, lists
from ..operators.store import CandidateStore
from ..schema import INPUT_COLUMNS, BlockingConfig
from ..sources import tsv
from ..sources.shared import new_path, scope, shuffles_removed, stage
from ..streaming.matching import stream_candidates
from . import entities, linkage
from .blocking import Blocking, CandidateIndex, candidates_for
from .cleaning import run_cleaning_pipeline

SWEEP_CAPS = (1, 2, 5)
SWEEP = BlockingConfig(max_block_size=entities.CONFIG.max_block_size, max_candidates_per_source=entities.CONFIG.max_candidates_per_source, holdout_ratio=0.5)


def decorated(rows: DataFrame) -> DataFrame:
    """Raw rows whose names are of many scripts, with punctuation, white space and accents that cleaning folds."""
    name, k = F.col("business_name"), F.col("doc_id") % 6
    others = [F.concat(F.lit("ООО “"), name, F.lit("”")), F.concat(name, F.lit(" café")), F.concat(F.lit(" Straße – "), name), F.concat(F.lit("राम "), name), F.concat(F.lit("株式会社"), name)]
    out = name
    for i, value in enumerate(others):
        out = F.when(k == i, value).otherwise(out)
    return rows.withColumn("business_name", out)


def _write(rows: DataFrame, folder: Path) -> None:
    """rows as the three raw tables of the split train, in the order of doc_id."""
    folder.mkdir(parents=True)
    for n in (1, 2, 3):
        own = rows.where(F.col("entity_id").startswith(f"S{n}-")).select("doc_id", F.concat_ws("\t", *INPUT_COLUMNS).alias("value"))
        tsv.write_lines(own, "doc_id", str(folder / f"train_source{n}.tsv"), "\t".join(INPUT_COLUMNS))


@cache
def _made(sf_dir: str, kind: str) -> Path:
    """A folder with raw and cleaned tables: of decorated names, or of the entity view as it is."""
    spark = SparkSession.active()
    top = Path(tempfile.mkdtemp(prefix="kinforge-files-"))
    atexit.register(shutil.rmtree, top, ignore_errors=True)
    rows = entities.raw(spark, sf_dir)
    _write(decorated(rows) if kind == "decorated" else rows, top / "raw" / "train")
    run_cleaning_pipeline(spark, top / "raw", top / "cleaned", ["train"])
    return top


@cache
def _truth(sf_dir: str) -> Path:
    """The ground truth beside the plain tables. It has an id for each true pair, so only what is told of it makes it."""
    spark, path = SparkSession.active(), _made(sf_dir, "plain") / "truth.tsv"
    truth = entities.ground_truth(entities.records(entities.cleaned(spark, sf_dir)))
    tsv.write_lines(truth.select("s1_id", F.concat_ws("\t", "s1_id", F.array_join("matched", ",")).alias("value")), None, str(path), "source1_entity_id\tmatched_entity_ids")
    return path


def _files(top: Path, stage: str) -> list[tuple[str, str]]:
    return [(f"S{n}", str(top / stage / "train" / f"train_source{n}.tsv")) for n in (1, 2, 3)]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def file_raw_rows(spark, sf_dir):
    return _union([tsv.read_raw(spark, path).select(F.lit(s).alias("source"), "*") for s, path in _files(_made(sf_dir, "decorated"), "raw")])


def file_cleaned_rows(spark, sf_dir):
    return _union([tsv.read_cleaned(spark, path).select(F.lit(s).alias("source"), "*") for s, path in _files(_made(sf_dir, "decorated"), "cleaned")])


def file_first_rows(spark, sf_dir):
    """The first seven rows of each cleaned table."""
    return _union([tsv.read_cleaned(spark, path, 7).select("entity_id") for _, path in _files(_made(sf_dir, "decorated"), "cleaned")])


def file_manifest(spark, sf_dir):
    """What the manifest says of each published table, and whether the file's bytes still have that digest."""
    folder = _made(sf_dir, "decorated") / "cleaned"
    files = json.loads((folder / "reports" / "manifest.json").read_text())["files"]
    return spark.createDataFrame([(name, f["rows"], f["sha256"], tsv.sha256_file(folder / name) == f["sha256"]) for name, f in files.items()], "name string, n_rows long, sha256 string, unchanged boolean")


def file_profile(spark, sf_dir):
    report = json.loads((_made(sf_dir, "decorated") / "cleaned" / "reports" / "profile.json").read_text())
    rows = [(name, p["row_count"], *(p["missing_counts"][c] for c in INPUT_COLUMNS[1:]), p["unicode_non_ascii_counts"]["business_name"]) for name, p in report["files"].items()]
    return spark.createDataFrame([*rows, ("all", report["summary"]["total_rows"], None, None, None, None)], "name string, n_rows long, no_name long, no_address long, no_country long, non_ascii_names long")


def file_quality(spark, sf_dir):
    """The invariants of a cleaned table with a wrong header, one wrong name and its last row gone."""
    top = _made(sf_dir, "decorated")
    good = (top / "cleaned" / "train" / "train_source1.tsv").read_text(encoding="utf-8").split("\n")[:-1]
    cells = good[2].split("\t")
    cells[4] += "!"
    bad = top / "broken.tsv"
    bad.write_text("\n".join([good[0] + "x", good[1], "\t".join(cells), *good[3:-1]]) + "\n", encoding="utf-8")
    found = cleaning.verify_file_quality(spark, str(top / "raw" / "train" / "train_source1.tsv"), str(bad), "S1-")
    return spark.createDataFrame(list(found["invariants"].items()), "invariant string, holds boolean")


def file_truth(spark, sf_dir):
    """A ground truth with empty, repeated and spaced ids, rows without a tab, and a record told twice."""
    top = _made(sf_dir, "decorated")
    ids = entities.raw(spark, sf_dir).where(F.col("entity_id").startswith("S1-")).select("doc_id", "entity_id")
    k = F.floor(F.col("doc_id") / 3) % 4
    text = F.when(k == 0, F.concat("entity_id", F.lit("\t"))).when(k == 1, F.concat("entity_id", F.lit("\tS2-a,S2-a, S3-b"))).when(k == 2, F.concat("entity_id", F.lit("\t,S2-c,"))).otherwise(F.col("entity_id"))
    rows = ids.select("doc_id", text.alias("value")).unionByName(ids.where(k == 1).select((F.col("doc_id") + 10**9).alias("doc_id"), F.concat("entity_id", F.lit("\tS3-last")).alias("value")))
    tsv.write_lines(rows, "doc_id", str(top / "odd_truth.tsv"), "source1_entity_id\tmatched_entity_ids")
    return tsv.ground_truth(spark, str(top / "odd_truth.tsv")).select("s1_id", F.array_join("matched", "|").alias("matched"))


@cache
def _blocked(sf_dir: str) -> tuple[Path, dict]:
    """The lists and what is told of the run; no query over it tells of an evaluation, so it is given no ground truth."""
    top = _made(sf_dir, "plain")
    lists, _, told = linkage.run_blocking_pipeline(SparkSession.active(), top / "cleaned", top / "lists", "train", entities.CONFIG)
    return lists, told


def file_candidates(spark, sf_dir):
    """The written candidate lists by line."""
    cut = tsv.fields(F.col("value"))
    lists = spark.read.text(str(_blocked(sf_dir)[0])).select(cut[0].alias("s1_id"), cut[1].alias("candidates"))
    return lists


def file_diagnostics(spark, sf_dir):
    """Counters of the run over files: volumes and what became of large blocks."""
    told = _blocked(sf_dir)[1]
    volume, overflow = told["candidate_volume_summary"], told["overflow_summary"]
    names = ["total_s1_entities", "total_candidate_pairs_generated", "total_candidate_pairs_retained", "total_candidate_pairs_truncated_by_caps", "s1_capped_by_safety_budget"]
    rows = [(n, volume[n]) for n in names] + [(n, overflow[n]) for n in ("total_overflow_events", "refined_overflow_events", "unrefined_retained_events", "filtered_high_df_events", "s2_overflows", "s3_overflows")]
    return spark.createDataFrame(rows, "counter string, n long")


def file_sweep(spark, sf_dir):
    """The written summary of a sweep over the holdout."""
    top = _made(sf_dir, "plain")
    _, table, _ = linkage.run_cap_sweep(spark, top / "cleaned", top / "sweep", _truth(sf_dir), SWEEP_CAPS, config=SWEEP)
    rows = [x.split("\t") for x in table.read_text().splitlines()]
    at = [rows[0].index(c) for c in ("cap", "validation_s1_count", "true_pairs", "retrieved_true_pairs", "missed_true_pairs", "generated_pairs", "retained_pairs", "truncated_pairs", "capped_s1_count")]
    return spark.createDataFrame([tuple(int(r[i]) for i in at) for r in rows[1:]], ", ".join(f"{rows[0][i]} long" for i in at))


def production_projection(spark, sf_dir):
    """What ten times the records would need, from the run over files."""
    volume = _blocked(sf_dir)[1]["candidate_volume_summary"]
    found = linkage.project(10 * volume["total_s1_entities"], volume["total_s1_entities"], volume, 1000, 1.0)
    return spark.createDataFrame([(found["total_source1_entities"], found["projected_candidate_pairs_before_capping"], found["projected_retained_candidate_pairs"], found["projected_candidate_tsv_size_bytes"])], "s1 long, generated long, retained long, bytes long")


def _result_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lines with faults by number: no tab, blank, a spaced id, a repeated id."""
    ids = _s1(spark, sf_dir)
    n = F.substring("s1_id", 4, 8).cast("long")
    k = n % 14
    value = F.when(k == 0, F.col("s1_id")).when(k == 2, F.lit("  ")).when(k == 4, F.concat("s1_id", F.lit("\tS2-00000001, S3-00000002"))).when(k == 6, F.concat("s1_id", F.lit("\tS3-00000002,S3-00000002"))).when(k == 8, F.concat("s1_id", F.lit("\t "))).otherwise(F.concat("s1_id", F.lit("\tS2-00000001")))
    return ids.select(value.alias("value"), (n + 2).alias("line"))


def _s1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.raw(spark, sf_dir).where(F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("s1_id"))


def check_lines(spark, sf_dir):
    lines = _result_lines(spark, sf_dir)
    return checker.list_errors(checker.parse(lines), _s1(spark, sf_dir)).unionByName(checker.malformed(lines)).distinct()


def check_tallies(spark, sf_dir):
    return checker.tallies(checker.parse(_result_lines(spark, sf_dir)))


def file_check(spark, sf_dir):
    """Result files against a folder of source tables: how often each rule is told of the matching list."""
    top = _made(sf_dir, "plain")
    test = top / "test"
    test.mkdir(exist_ok=True)
    for n in (1, 2, 3):
        shutil.copyfile(top / "raw" / "train" / f"train_source{n}.tsv", test / f"test_source{n}.tsv")
    tsv.write_lines(_result_lines(spark, sf_dir), "line", str(top / "matching.tsv"), "source1_entity_id\tmatched_entity_ids")
    errors, _ = checker.validate(spark, str(top / "matching.tsv"), None, str(test), True)
    return spark.createDataFrame([(e.split(": ")[1], int(e.split(": ")[2].split(",")[0])) for e in errors], "rule string, n long")


def one_record_candidates(spark, sf_dir):
    """Candidates of the first record, asked alone."""
    records = entities.records(entities.cleaned(spark, sf_dir))
    first = records.where("source = 'S1'").orderBy("entity_id").first()
    found = candidates_for((first["entity_id"], first["name"], first["address"], first["country"]), records.where("source <> 'S1'"), entities.CONFIG)
    return spark.createDataFrame(list(found.items()), "cand_id string, provenance long")


def grown_index(spark, sf_dir):
    """Key frequencies of an index that was built on one half of the candidates, saved, loaded and grown by the other."""
    rows = entities.records(entities.cleaned(spark, sf_dir)).where("source <> 'S1'")
    half = F.pmod(F.xxhash64("entity_id"), F.lit(2)) == 0
    folder = new_path(spark, "index")
    CandidateIndex.build(rows.where(half), entities.CONFIG).save(folder)
    return CandidateIndex.load(spark, folder, entities.CONFIG).add(rows.where(~half)).frequencies


def index_countries(spark, sf_dir):
    return CandidateIndex.build(entities.records(entities.cleaned(spark, sf_dir)).where("source <> 'S1'"), entities.CONFIG).countries


def store_capped(spark, sf_dir):
    """A store that got its pairs in two batches, with overlap, and was compacted; its best two of each record and source."""
    store = CandidateStore(spark, new_path(spark, "store"))
    with scope(spark), shuffles_removed(spark):
        pairs = stage(Blocking(entities.records(entities.cleaned(spark, sf_dir)), entities.CONFIG).lists(), "lists")
        store.add(lists.masked(pairs, 15))
        store.add(lists.masked(pairs, 124))
    store.compact()
    return store.capped(2).select("s1_id", "cand_id", F.col("provenance").cast("long").alias("provenance"), F.col("rank").cast("long").alias("rank_no"))


def stream_pairs(spark, sf_dir):
    """Records that arrive as a stream in three files, against stored candidates; ranks within the cap."""
    records = entities.records(entities.cleaned(spark, sf_dir))
    arriving, done = new_path(spark, "arriving"), new_path(spark, "stream-pairs")
    for k in range(3):
        records.where("source = 'S1'").where(F.pmod(F.xxhash64("entity_id"), F.lit(3)) == k).coalesce(1).write.mode("append").parquet(arriving)
    source = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    sink = lambda rows, number: rows.withColumn("number", F.lit(number)).write.mode("overwrite").parquet(f"{done}/batch={number}")
    query = stream_candidates(source, records.where("source <> 'S1'"), entities.CONFIG, sink, new_path(spark, "stream-checkpoint"))
    query.processAllAvailable()
    query.stop()
    return spark.read.parquet(done).select("s1_id", "cand_id", F.col("rank").cast("long").alias("rank_no"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        file_raw_rows, file_cleaned_rows, file_first_rows, file_manifest, file_profile, file_quality, file_truth, file_candidates, file_diagnostics, file_sweep,
        production_projection, check_lines, check_tallies, file_check, one_record_candidates, grown_index, index_countries, store_capped, stream_pairs,
    )
}
