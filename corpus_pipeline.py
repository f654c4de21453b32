"""A corpus from documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from kinforge.llm import exact_dedup, near_dedup, packing, quality_classifier, quality_rules
from kinforge.llm.arrow_text import bound_reads
from kinforge.llm.staging import stage


def _bounded(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage whose texts, and those that are read to write its result, are read few at a time."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_reads(spark)
        return function(spark, docs, sf_dir)

    return run


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier learns from labelled rows of the whole corpus that are not held out: the rules have taken most of
    the bad ones from docs."""
    return quality_classifier.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedupe(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.dedupe(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", keep_by_rules),
    ("quality classifier", keep_by_classifier),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("best-fit packing", pack),
]
STAGES = [(name, _bounded(function)) for name, function in STAGES]

#: Hashes, a trained model and a packing plan decide; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{k}")
    return docs
