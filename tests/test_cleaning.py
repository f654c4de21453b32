import hashlib
import json

import pytest

from kinforge.operators import cleaning
from kinforge.plans.cleaning import clean_and_profile_file, run_cleaning_pipeline
from kinforge.schema import INPUT_COLUMNS, OUTPUT_COLUMNS, PublicationTransactionError, StructuralIntegrityError

HEADER = "\t".join(INPUT_COLUMNS)


def write(path, *rows, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(end.join([HEADER, *rows]) + end, encoding="utf-8", newline="")
    return path


@pytest.mark.parametrize(
    ("rows", "line", "reason"),
    [
        (["S1-1\ta\tb\tUS", "S1-2\ta\tb"], 3, "4 tab-delimited columns"),
        (["S1-1\ta\tb\tUS\tx"], 2, "Expected exactly 4"),
        (["S1-001\ta\tb\tUS", "S1-001\tc\td\tUS"], 3, "Duplicate entity_id detected"),
        ([" \ta\tb\tUS"], 2, "Empty or whitespace-only entity_id"),
        (["S2-001\ta\tb\tUS"], 2, "Inconsistent entity_id prefix"),
        (["S1-1\ta\tb\tUS", ""], 3, "4 tab-delimited columns"),
    ],
)
def test_violations(spark, tmp_path, rows, line, reason):
    path = write(tmp_path / "s.tsv", *rows)
    with pytest.raises(StructuralIntegrityError) as error:
        cleaning.validate_input_file(spark, str(path), "S1-")
    assert error.value.line_number == line
    assert reason in error.value.reason


def test_other_violations(spark, tmp_path):
    for name, content in (("none", None), ("empty", b""), ("bom", b"\xef\xbb\xbf" + HEADER.encode() + b"\n"), ("header", b"a\tb\n")):
        path = tmp_path / name
        if content is not None:
            path.write_bytes(content)
        with pytest.raises(StructuralIntegrityError):
            cleaning.validate_input_file(spark, str(path))
    path = tmp_path / "utf8"
    path.write_bytes(HEADER.encode() + b"\nS1-1\t\xff\tb\tUS\n")
    with pytest.raises(StructuralIntegrityError, match="UTF-8"):
        cleaning.validate_input_file(spark, str(path))


def test_valid_files(spark, tmp_path):
    path = write(tmp_path / "s.tsv", "S1-1\ta\tb\tUS", "S1-2\ta\tb\tUS", end="\r\n")
    assert cleaning.validate_input_file(spark, str(path), "S1-") == 2
    assert cleaning.expected_prefix("Train_Source3.tsv") == "S3-"
    assert cleaning.expected_prefix("x.tsv") == ""


def test_clean_and_verify(spark, tmp_path):
    path = write(tmp_path / "s.tsv", *[f"S1-{i:03}\tAlpha “Inc”. {i % 7}\t{i} Main  St\t{'' if i % 5 == 0 else ' US '}" for i in range(200)], "S1-900\tMaße\t \tDE")
    out = tmp_path / "out" / "s.tsv"
    profile = clean_and_profile_file(spark, path, out, "S1-")
    lines = out.read_text(encoding="utf-8").splitlines()
    assert lines[0].split("\t") == OUTPUT_COLUMNS
    assert [x.split("\t")[0] for x in lines[1:]] == [f"S1-{i:03}" for i in range(200)] + ["S1-900"]
    assert lines[-1] == "S1-900\tMaße\t \tDE\tmasse\t\tde\tFalse\tTrue\tFalse"
    assert profile["row_count"] == 201
    assert profile["missing_counts"] == {"business_name": 0, "business_address": 1, "country": 40}
    assert profile["empty_string_counts"]["business_address"] == 0
    assert profile["repeated_values"]["name"] == {"values": 7, "rows": 200}
    assert cleaning.verify_file_quality(spark, str(path), str(out), "S1-")["status"] == "PASSED"
    for old, new, broken in (("masse", "other", "normalized_columns_present"), ("masse\t\tde", "masse\tUnknown\tde", "normalized_missing_not_fabricated"), ("Maße", "Masse", "original_values_unaltered")):
        bad = tmp_path / "bad.tsv"
        bad.write_text("\n".join([*lines[:-1], lines[-1].replace(old, new)]) + "\n", encoding="utf-8")
        found = cleaning.verify_file_quality(spark, str(path), str(bad), "S1-")
        assert found["status"] == "FAILED"
        assert not found["invariants"][broken]
    bad.write_text("\n".join([lines[0].replace("country", "land", 1), *lines[1:]]) + "\n", encoding="utf-8")
    assert [k for k, v in cleaning.verify_file_quality(spark, str(path), str(bad), "S1-")["invariants"].items() if not v] == ["output_headers_correct"]
    assert cleaning.verify_file_quality(spark, str(bad), str(out), "S1-")["invariants"]["source_columns_present"] is False
    bad.write_text("\n".join(lines[:-1]) + "\n", encoding="utf-8")
    assert not cleaning.verify_file_quality(spark, str(path), str(bad), "S1-")["invariants"]["row_count_match"]


def test_cleaning_repeats(spark, tmp_path):
    """Two runs publish the same bytes, and the manifest's digests are the files'."""
    for n in (1, 2, 3):
        write(tmp_path / "in" / "train" / f"train_source{n}.tsv", *[f"S{n}-{i}\tАльфа {i}\t1 Main\tUS" for i in range(50)])
    seen = []
    for out in ("a", "b"):
        run_cleaning_pipeline(spark, tmp_path / "in", tmp_path / out, ["train"])
        manifest = json.loads((tmp_path / out / "reports" / "manifest.json").read_text())["files"]
        assert all(hashlib.sha256((tmp_path / out / name).read_bytes()).hexdigest() == f["sha256"] for name, f in manifest.items())
        seen.append(manifest)
    assert seen[0] == seen[1]


def test_cleaning_failure_leaves_nothing(spark, tmp_path):
    for n in (1, 2, 3):
        write(tmp_path / "in" / "train" / f"train_source{n}.tsv", f"S{n}-1\ta\tb\tUS" if n < 3 else "S9-1\ta\tb\tUS")
    with pytest.raises(StructuralIntegrityError):
        run_cleaning_pipeline(spark, tmp_path / "in", tmp_path / "out", ["train"])
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").iterdir())


def test_quantiles(spark, tmp_path):
    path = write(tmp_path / "s.tsv", *[f"S1-{i}\t{'x' * n}\ta\tUS" for i, n in enumerate((10, 20, 20, 30, 40, 50, 100))])
    summary = clean_and_profile_file(spark, path, tmp_path / "o.tsv")["length_summaries"]["business_name"]
    assert (summary["min"], summary["max"], summary["quantiles"]["p50"]) == (10, 100, 30)


def test_pipeline_and_rollback(spark, tmp_path):
    for split in ("train", "test"):
        for n in (1, 2, 3):
            write(tmp_path / "in" / split / f"{split}_source{n}.tsv", f"S{n}-1\tAlpha Inc.\t1 Main\tUS")
    out = tmp_path / "out"
    run_cleaning_pipeline(spark, tmp_path / "in", out, ["train", "test"])
    assert json.loads((out / "reports" / "quality_checks.json").read_text())["status"] == "PASSED"
    before = {p.relative_to(out): p.read_bytes() for p in out.rglob("*") if p.is_file()}
    for point in ("backup 1", "publish 1", "publish 2"):

        def fail(at, point=point):
            if at == point:
                raise RuntimeError(at)

        with pytest.raises(PublicationTransactionError):
            run_cleaning_pipeline(spark, tmp_path / "in", out, ["train", "test"], fail=fail)
        assert {p.relative_to(out): p.read_bytes() for p in out.rglob("*") if p.is_file()} == before
        assert not [p for p in out.iterdir() if p.name.startswith(".")]
    run_cleaning_pipeline(spark, tmp_path / "in", out, ["train"])
    assert (out / "test" / "test_source1.tsv").exists()


def test_line_numbers_over_many_splits(spark, tmp_path):
    from kinforge.sources import tsv

    path = write(tmp_path / "s.tsv", *[f"S1-{i}\t{'x' * (i % 37)}\ta\tUS" for i in range(500)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    try:
        rows = tsv.read_raw(spark, str(path))
        assert rows.rdd.getNumPartitions() > 3
        assert {r["entity_id"]: r["line"] for r in rows.collect()} == {f"S1-{i}": i + 2 for i in range(500)}
        out = tmp_path / "again.tsv"
        tsv.write_lines(tsv.lines(spark, str(path)), "line", out, HEADER)
        assert out.read_bytes() == path.read_bytes()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
