"""Cleaned columns, the validation gate, and the invariants that a cleaned table must hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_missing, normalize_country, normalize_text
from ..functions.unicode_classes import SPACE
from ..schema import FLAG_COLUMNS, INPUT_COLUMNS, NORMALIZED_COLUMNS, OUTPUT_COLUMNS, TEXT_COLUMNS, StructuralIntegrityError
from ..sources import tsv

NULL_TOKENS = ["None", "null", "NULL", "NaN", "nan"]


def clean(rows: DataFrame) -> DataFrame:
    """rows with the normalized columns and the missing flags; all other columns stay as they are."""
    name, address, country = TEXT_COLUMNS
    return rows.withColumns(
        {f"{name}_normalized": normalize_text(F.col(name)), f"{address}_normalized": normalize_text(F.col(address)), f"{country}_normalized": normalize_country(F.col(country))}
        | {f"{c}_is_missing": is_missing(F.col(c)) for c in TEXT_COLUMNS}
    )


def violations(lines: DataFrame, prefix: str = "") -> DataFrame:
    """line, rule (its rank) and detail of each line that breaks the raw format. lines: value, line."""
    cut = tsv.fields(F.col("value"))
    rows = lines.select("line", "value", F.size(cut).alias("n"), cut[0].alias("id"))
    blank = F.col("id").rlike(rf"\A[{SPACE}]*\z")
    rule = (
        F.when(~F.is_valid_utf8("value"), F.lit("8Line is not valid UTF-8"))
        .when(F.col("n") != 4, F.concat(F.lit("4Expected exactly 4 tab-delimited columns, found "), F.col("n").cast("string")))
        .when(blank, F.lit("5Empty or whitespace-only entity_id"))
        .when(~F.col("id").startswith(prefix), F.concat(F.lit("6Inconsistent entity_id prefix: '"), F.col("id"), F.lit(f"', expected '{prefix}'")))
    )
    single = rows.withColumn("rule", rule).where("rule is not null").select("line", F.substring("rule", 1, 1).cast("int").alias("rule"), F.expr("substring(rule, 2)").alias("detail"))
    whole = rows.where(F.col("n") == 4).select("id", "line")
    repeated = whole.groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.min("line").alias("first")).where("c > 1").select(F.col("id").alias("id_"), "first")
    again = whole.join(repeated, F.col("id") == F.col("id_")).where("line > first").groupBy("id").agg(F.min("line").alias("line"))
    return single.unionByName(again.select("line", F.lit(7).alias("rule"), F.concat(F.lit("Duplicate entity_id detected: '"), F.col("id"), F.lit("'")).alias("detail")))


def validate_input_file(spark: SparkSession, path: str, expected_prefix: str = "") -> int:
    """The number of data rows; raises on the first violation by line, then by rule."""
    if not tsv.exists(spark, path):
        raise StructuralIntegrityError(path, 0, "File does not exist")
    if tsv.is_empty(spark, path):
        raise StructuralIntegrityError(path, 0, "File is empty")
    found = tsv.header(spark, path)
    if found != "\t".join(INPUT_COLUMNS).encode():
        raise StructuralIntegrityError(path, 1, f"Expected header {INPUT_COLUMNS}, got {found!r}")
    lines = tsv.lines(spark, path)
    first = violations(lines, expected_prefix).orderBy("line", "rule").first()
    if first:
        raise StructuralIntegrityError(path, first["line"], first["detail"])
    return lines.count()


def expected_prefix(filename: str, custom: str | None = None) -> str:
    """The id prefix that a file's name tells."""
    if custom is not None:
        return custom
    return next((f"S{n}-" for n in (1, 2, 3) if f"source{n}" in filename.lower()), "")


INVARIANTS = [
    "column_count_valid", "entity_ids_preserved", "entity_id_prefix_consistent", "original_values_unaltered",
    "missing_flags_valid", "missing_flags_consistent", "normalized_missing_not_fabricated", "normalized_columns_present",
    "no_null_tokens", "row_count_match",
]
HEADER_INVARIANTS = ["source_columns_present", "output_headers_correct"]


def check_invariants(raw: DataFrame, cleaned: DataFrame, prefix: str = "") -> DataFrame:
    """line and a boolean for each invariant, of each pair of a raw row and the cleaned row in its place.

    raw: line and the input columns. cleaned: line, fields (array of the columns as text). A row without its
    partner breaks row_count_match alone.
    """
    pairs = raw.join(cleaned.select(F.col("line").alias("line_"), "fields"), F.col("line") == F.col("line_"), "full_outer")
    both = F.col("line").isNotNull() & F.col("line_").isNotNull()
    at = {c: F.get("fields", F.lit(i)) for i, c in enumerate(OUTPUT_COLUMNS)}
    again = clean(raw.sparkSession.range(0).select(*[F.lit("").alias(c) for c in INPUT_COLUMNS])).columns  # names only
    assert again == OUTPUT_COLUMNS
    truth = {"True": True, "False": False}
    flags_valid = F.lit(True)
    flags_agree, not_made_up, present = F.lit(True), F.lit(True), F.lit(True)
    for c in TEXT_COLUMNS:
        flag, normal = at[f"{c}_is_missing"], at[f"{c}_normalized"]
        gone = is_missing(F.col(c))
        flags_valid = flags_valid & flag.isin(*truth)
        flags_agree = flags_agree & (flag == F.when(gone, "True").otherwise("False"))
        not_made_up = not_made_up & (~gone | (normal == ""))
        present = present & (normal == (normalize_country if c == "country" else normalize_text)(F.col(c)))
    raw_same = F.lit(True)
    for c in INPUT_COLUMNS:
        raw_same = raw_same & (at[c] == F.col(c))
    tokens = F.lit(False)
    for c in NORMALIZED_COLUMNS + FLAG_COLUMNS:
        source = F.col(c.removesuffix("_normalized")) if c in NORMALIZED_COLUMNS else F.lit("")
        tokens = tokens | (at[c].isin(*NULL_TOKENS) & ~F.trim(source).isin(*NULL_TOKENS, *[t.lower() for t in NULL_TOKENS], "NONE", "Null", "NAN", "Nan"))
    conditions = {
        "column_count_valid": F.size("fields") == len(OUTPUT_COLUMNS),
        "entity_ids_preserved": at["entity_id"] == F.col("entity_id"),
        "entity_id_prefix_consistent": at["entity_id"].startswith(prefix),
        "original_values_unaltered": raw_same,
        "missing_flags_valid": flags_valid,
        "missing_flags_consistent": flags_agree,
        "normalized_missing_not_fabricated": not_made_up,
        "normalized_columns_present": present,
        "no_null_tokens": ~tokens,
    }
    return pairs.select(F.coalesce("line", "line_").alias("line"), *[(~both | F.coalesce(v, F.lit(False))).alias(k) for k, v in conditions.items()], both.alias("row_count_match"))


def verify_file_quality(spark: SparkSession, input_path: str, cleaned_path: str, prefix: str = "") -> dict:
    """The invariants of a cleaned file against its input, each with the first line that breaks it; headers are line 1."""
    cleaned = tsv.lines(spark, cleaned_path).select("line", tsv.fields(F.col("value")).alias("fields"))
    checked = check_invariants(tsv.read_raw(spark, input_path), cleaned, prefix)
    row = checked.agg(F.count(F.lit(1)).alias("rows"), *[F.min(F.when(~F.col(k), F.col("line"))).alias(k) for k in INVARIANTS]).first()
    first = {k: row[k] for k in INVARIANTS}
    for name, path, columns in zip(HEADER_INVARIANTS, (input_path, cleaned_path), (INPUT_COLUMNS, OUTPUT_COLUMNS), strict=True):
        first[name] = None if tsv.header(spark, path) == "\t".join(columns).encode() else 1
    return {"status": "PASSED" if not any(first.values()) else "FAILED", "rows_checked": row["rows"], "invariants": {k: v is None for k, v in first.items()}, "errors": [f"line {v}: {k}" for k, v in sorted(first.items(), key=lambda x: x[1] or 0) if v]}
