"""Tab-separated text with its order kept, and files written in order."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.unicode_classes import SPACE
from ..schema import INPUT_COLUMNS, OUTPUT_COLUMNS
from .shared import file_system, stage


def lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines after the first: value, and line (its number in the file, the header being 1).

    Numbers come from the lines of each split of the file, counted once; no line is sorted or moved.
    """
    raw = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_block_start").alias("block"), F.spark_partition_id().alias("part"))
    counts = raw.groupBy("block", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).orderBy("block", "first").collect()
    before, rows = 0, []
    for c in counts:
        rows.append((c["block"], c["part"], c["first"], before))
        before += c["n"]
    starts = spark.createDataFrame(rows, "block long, part int, first long, before long")
    numbered = raw.join(F.broadcast(starts), ["block", "part"]).select("value", (F.col("at") - F.col("first") + F.col("before") + 1).alias("line"))
    return numbered.where("line > 1")


def exists(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, str(path))
    return files.exists(at)


def header(spark: SparkSession, path: str) -> bytes:
    """The first line's bytes without its end, byte-order mark included; of any file that Spark can read."""
    files, at = file_system(spark, str(path))
    stream, found = files.open(at), b""
    try:
        while b"\n" not in found and (more := bytes(stream.readNBytes(1 << 16))):
            found += more
    finally:
        stream.close()
    return found.split(b"\n", 1)[0].rstrip(b"\r")


def is_empty(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, str(path))
    return files.getFileStatus(at).getLen() == 0


def fields(value: Column) -> Column:
    return F.split(value, "\t", -1)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """line and the four input columns; check the file before."""
    cut = fields(F.col("value"))
    return lines(spark, path).select("line", *[cut[i].alias(c) for i, c in enumerate(INPUT_COLUMNS)])


def read_cleaned(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """line and ten columns of a cleaned file; rows with fewer are skipped. max_rows: in the file's order."""
    if len(header(spark, path).split(b"\t")) < len(OUTPUT_COLUMNS):
        raise AssertionError(f"{path}: a cleaned file has at least {len(OUTPUT_COLUMNS)} columns")
    cut = fields(F.col("value"))
    found = lines(spark, path).where(F.size(cut) >= len(OUTPUT_COLUMNS)).select("line", *[cut[i].alias(c) for i, c in enumerate(OUTPUT_COLUMNS)])
    return found if max_rows is None else found.orderBy("line").limit(max_rows)


def strip(value: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(value, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def truth_lines(spark: SparkSession, path: str) -> DataFrame:
    """s1_id and told (the list as it is written); of rows that repeat an id the last holds. Lists can be long, so only
    the ids are shuffled to find those that are repeated."""
    cut = fields(F.col("value"))
    rows = lines(spark, path).select("line", cut[0].alias("s1_id"), F.coalesce(F.get(cut, F.lit(1)), F.lit("")).alias("told"))
    repeated = rows.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"), F.max("line").alias("last")).where("n > 1")
    return rows.join(stage(repeated.drop("n"), "repeated-truth"), "s1_id", "left").where("last is null or line = last").select("s1_id", "told")


def matched(told: Column) -> Column:
    """The distinct ids of a list as it is written."""
    return F.array_distinct(F.array_remove(F.split(told, ",", -1), ""))


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """s1_id and matched (array of distinct ids), as they stand; of rows that repeat an id the last holds."""
    return truth_lines(spark, path).select("s1_id", matched(F.col("told")).alias("matched"))


def first_column(spark: SparkSession, path: str) -> DataFrame:
    """The distinct, stripped values of the first column after the header; blank lines are skipped."""
    return lines(spark, path).where(strip(F.col("value")) != "").select(strip(fields(F.col("value"))[0]).alias("id")).distinct()


def write_lines(rows: DataFrame, order: str | None, path: Path | str, first: str | None = None) -> None:
    """Write column value in order into one file of any file system: parts by range of order, then joined as streams,
    each removed when it is joined, and moved. Without an order the rows aren't shuffled."""
    spark, target = rows.sparkSession, str(path)
    folder, _, name = target.rpartition("/")
    parts, temporary = (f"{folder}/{'.' if folder else './.'}{name}.{end}" for end in ("parts", "tmp"))
    (rows.orderBy(order) if order else rows).select("value").write.mode("overwrite").option("lineSep", "\n").text(parts)
    files, at = file_system(spark, temporary)
    out = files.create(at, True)
    try:
        if first is not None:
            out.write(first.encode() + b"\n")
        found = files.globStatus(file_system(spark, f"{parts}/part-*")[1])
        for part in sorted(str(f.getPath()) for f in found):
            stream = files.open(file_system(spark, part)[1])
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
            stream.close()
            files.delete(file_system(spark, part)[1], False)
    finally:
        out.close()
    files.delete(file_system(spark, parts)[1], True)
    end = file_system(spark, target)[1]
    files.delete(end, False)
    if not files.rename(at, end):
        raise OSError(f"{temporary} could not be moved to {target}")


def sha256_file(path: Path, block: int = 1 << 20) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while data := f.read(block):
            digest.update(data)
    return digest.hexdigest()


def write_json(path: Path, data: dict) -> None:
    path.write_text(json.dumps(data, indent=2, ensure_ascii=False), encoding="utf-8")
