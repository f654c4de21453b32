"""Registered queries over the entity view, one or more for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import checker, cleaning, evaluation, passes, profiling, ranking
from ..schema import FLAG_COLUMNS, INPUT_COLUMNS, OUTPUT_COLUMNS, BlockingConfig
from . import entities, file_queries
from .blocking import Blocking
from .sweep import cap_summary

CAPS = (1, 2, 3, 5, 10)
RATIO, SALT = 0.5, entities.CONFIG.holdout_salt


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.records(entities.cleaned(spark, sf_dir))


def _blocking(spark: SparkSession, sf_dir: str) -> Blocking:
    return Blocking(_records(spark, sf_dir), entities.CONFIG)


def _joined(array) -> F.Column:
    return F.concat_ws(",", array)


def normalized_columns(spark, sf_dir):
    return entities.cleaned(spark, sf_dir).select("entity_id", "business_name_normalized", "business_address_normalized", "country_normalized")


def missing_flags(spark, sf_dir):
    return entities.cleaned(spark, sf_dir).select("entity_id", *FLAG_COLUMNS)


def missing_counts(spark, sf_dir):
    return profiling.missing_counts(entities.raw(spark, sf_dir))


def source_counts(spark, sf_dir):
    from ..operators.postings import totals

    return totals(_records(spark, sf_dir))


def validate_violations(spark, sf_dir):
    """Raw lines, some of them broken on purpose: a column too few, a blank id, a wrong prefix, a repeated id."""
    rows = entities.raw(spark, sf_dir)
    d = F.col("doc_id")
    entity = F.when(d % 50 == 11, F.lit(" ")).when(d % 50 == 21, F.concat(F.lit("X"), F.col("entity_id"))).when(d % 50 == 31, F.lit("S1-dup")).otherwise(F.col("entity_id"))
    value = F.when(d % 50 == 1, F.concat_ws("\t", entity, "business_name")).otherwise(F.concat_ws("\t", entity, *INPUT_COLUMNS[1:]))
    found = cleaning.violations(rows.select(value.alias("value"), (d + 2).alias("line")), "S")
    return found.select("line", F.col("rule").cast("long").alias("rule"))


def quality_invariants(spark, sf_dir):
    """How many rows hold each invariant, where some cleaned rows are broken on purpose."""
    rows = entities.cleaned(spark, sf_dir)
    d = F.col("doc_id")
    name = F.when(d % 40 == 3, F.concat("business_name_normalized", F.lit("!"))).otherwise(F.col("business_name_normalized"))
    country = F.when(d % 40 == 6, F.lit("null")).otherwise(F.col("country_normalized"))
    raw_name = F.when(d % 40 == 9, F.lit("other")).otherwise(F.col("business_name"))
    shown = {c: F.when(F.col(c), "True").otherwise("False") for c in FLAG_COLUMNS} | {"business_name_normalized": name, "country_normalized": country, "business_name": raw_name}
    line = (d + 2).alias("line")
    written = rows.where(d % 40 != 12).select(line, F.array(*[shown.get(c, F.col(c)) for c in OUTPUT_COLUMNS]).alias("fields"))
    checked = cleaning.check_invariants(rows.select(line, *INPUT_COLUMNS), written, "S")
    return checked.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(k)).alias(k) for k in cleaning.INVARIANTS])


def repeated_values(spark, sf_dir):
    return profiling.repeats(entities.cleaned(spark, sf_dir)).select("kind", F.col("values").alias("n_values"), F.col("rows").alias("n_rows"))


def country_counts(spark, sf_dir):
    return profiling.country_counts(entities.raw(spark, sf_dir))


def length_quantiles(spark, sf_dir):
    return profiling.length_quantiles(profiling.length_counts(entities.cleaned(spark, sf_dir))).withColumnRenamed("column", "col")


def length_counts(spark, sf_dir):
    return profiling.length_counts(entities.cleaned(spark, sf_dir)).select(F.col("column").alias("col"), F.col("length").cast("long").alias("len"), "n")


def length_examples(spark, sf_dir):
    return profiling.length_examples(entities.cleaned(spark, sf_dir)).withColumnRenamed("column", "col").withColumnRenamed("value", "val")


def script_counts(spark, sf_dir):
    return profiling.script_counts(entities.raw(spark, sf_dir)).withColumnRenamed("column", "col")


def suspicious_counts(spark, sf_dir):
    """Names with a control and a replacement character put into some."""
    rows = entities.raw(spark, sf_dir)
    d = F.col("doc_id")
    name = F.when(d % 7 == 0, F.concat(F.lit("\x01\x1f"), "business_name")).when(d % 7 == 1, F.concat(F.lit("\ufffd\x85"), "business_name")).when(d % 7 == 2, F.concat(F.lit("\ue000"), "business_name")).otherwise(F.col("business_name"))
    return profiling.suspicious_counts(rows.withColumn("business_name", name)).withColumnRenamed("column", "col")


def _keys(make: Callable, column: str) -> Callable:
    return lambda spark, sf_dir: _records(spark, sf_dir).select("entity_id", _joined(make(F.col(column))).alias("found"))


def _frequent(family: str) -> Callable:
    def query(spark, sf_dir):
        return _blocking(spark, sf_dir).frequencies.where(F.col("family") == family).select("source", "country", "key", "n", "filtered")

    return query


def _pass(family: str) -> Callable:
    return lambda spark, sf_dir: _blocking(spark, sf_dir).blocks(family).pairs().select("s1_id", "cand_id").distinct()


def exact_name_block(spark, sf_dir):
    return _blocking(spark, sf_dir).exact_name().select("s1_id", "cand_id")


def overflow_events(spark, sf_dir):
    return _blocking(spark, sf_dir).blocks().events()


def missing_country_block(spark, sf_dir):
    return _blocking(spark, sf_dir).missing_country().select("s1_id", "cand_id")


def global_fallback_block(spark, sf_dir):
    return _blocking(spark, sf_dir).global_fallback().select("s1_id", "cand_id")


def cross_country_block(spark, sf_dir):
    return _blocking(spark, sf_dir).cross_country(("s1_id", "cand_id"))


def candidate_pairs(spark, sf_dir):
    return _blocking(spark, sf_dir).listed().select("s1_id", "cand_id", F.col("provenance").cast("long").alias("provenance"))


def candidate_pairs_defaults(spark, sf_dir):
    """All passes with the default thresholds: blocks of up to a thousand."""
    pairs = Blocking(_records(spark, sf_dir), BlockingConfig()).listed()
    return pairs.select("s1_id", "cand_id", F.col("provenance").cast("long").alias("provenance"))


def provenance_breakdown(spark, sf_dir):
    masks = _blocking(spark, sf_dir).found().select("source", F.inline("masks"))
    return ranking.breakdown_of_masks(masks.groupBy("provenance", "source").agg(F.sum("n").alias("n")))


def evidence_tiers(spark, sf_dir):
    names = ["exact", "bits", "rare", "num_loc", "addr", "ngram", "missing", "cross"]
    return _blocking(spark, sf_dir).listed().select("s1_id", "cand_id", *[t.cast("long").alias(f"tier_{n}") for t, n in zip(ranking.evidence_tier(), names, strict=True)])


def ranked_capped(spark, sf_dir):
    return ranking.ranked(_blocking(spark, sf_dir).found(3)).select("s1_id", "cand_id", F.col("rank").cast("long").alias("rank_no"))


def cap_counts(spark, sf_dir):
    return ranking.capped_sizes(_blocking(spark, sf_dir).found(), 3)


def export_rows(spark, sf_dir):
    blocking, cap = _blocking(spark, sf_dir), entities.CONFIG.max_candidates_per_source
    return ranking.export(blocking.s1.select(F.col("entity_id").alias("s1_id")), ranking.ranked(blocking.found(cap)), cap)


def candidate_distribution(spark, sf_dir):
    blocking = _blocking(spark, sf_dir)
    counts = evaluation.candidate_counts(blocking.s1.select(F.col("entity_id").alias("s1_id")), blocking.found())
    found = ranking.distribution(counts, "n")
    return found.select(*[F.col(c).alias(f"d_{c}") for c in found.columns])


def holdout_members(spark, sf_dir):
    return _records(spark, sf_dir).where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), evaluation.in_holdout(F.col("entity_id"), RATIO, SALT).alias("held_out"))


def ground_truth(spark, sf_dir):
    return entities.ground_truth(_records(spark, sf_dir)).select("s1_id", _joined(F.col("matched")).alias("matched"))


def recall_metrics(spark, sf_dir):
    blocking = _blocking(spark, sf_dir)
    truth = entities.ground_truth(blocking.records)
    found = blocking.found(0, evaluation.truth_pairs(truth))
    return evaluation.recall(truth, ranking.ranked(found), found)


def cap_sweep_summary(spark, sf_dir):
    blocking = _blocking(spark, sf_dir)
    truth = entities.ground_truth(blocking.records)
    return cap_summary(blocking.s1.select(F.col("entity_id").alias("s1_id")), blocking.found(0, evaluation.truth_pairs(truth)), truth, CAPS)


def macro_f05(spark, sf_dir):
    blocking = _blocking(spark, sf_dir)
    answers = ranking.ranked(blocking.found(1))
    return evaluation.macro_f05(entities.ground_truth(blocking.records), answers).withColumn("f05", F.round("f05", 9))


def _results(blocking: Blocking) -> DataFrame:
    """Result lists made from the truth, with faults put in by number."""
    truth = entities.ground_truth(blocking.records)
    n = F.substring("s1_id", 4, 8).cast("int")
    ids = F.when(n % 10 == 0, F.concat("matched", "matched")).when(n % 10 == 3, F.concat("matched", F.array(F.lit("S1-00000001"), F.lit("")))).when(n % 10 == 6, F.concat("matched", F.array(F.lit("S2-unknown")))).otherwise(F.col("matched"))
    return truth.where(n % 11 != 5).select(n.alias("line"), "s1_id", ids.alias("ids"))


def check_errors(spark, sf_dir):
    blocking = _blocking(spark, sf_dir)
    required = blocking.s1.select(F.col("entity_id").alias("s1_id"))
    return checker.list_errors(_results(blocking), required, blocking.candidates.select(F.col("entity_id").alias("id")))


def matched_not_candidate(spark, sf_dir):
    blocking = _blocking(spark, sf_dir)
    exported = ranking.export(blocking.s1.select(F.col("entity_id").alias("s1_id")), ranking.ranked(blocking.found(1)), 1)
    return checker.not_candidates(_results(blocking), exported.select("s1_id", F.filter(F.split("candidates", ","), lambda c: c != "").alias("ids")))


def merged_passes(spark, sf_dir):
    """The two smallest passes, joined by or."""
    blocking = _blocking(spark, sf_dir)
    return passes.merge(blocking.exact_name(), blocking.blocks("num_loc").pairs()).select("s1_id", "cand_id", F.col("provenance").cast("long").alias("provenance"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalized_columns": normalized_columns,
    "missing_flags": missing_flags,
    "missing_counts": missing_counts,
    "source_counts": source_counts,
    "validate_violations": validate_violations,
    "quality_invariants": quality_invariants,
    "repeated_values": repeated_values,
    "country_counts": country_counts,
    "length_counts": length_counts,
    "length_quantiles": length_quantiles,
    "length_examples": length_examples,
    "script_counts": script_counts,
    "suspicious_counts": suspicious_counts,
    "name_tokens": _keys(keys.name_tokens, "name"),
    "address_tokens": _keys(keys.address_tokens, "address"),
    "address_numbers": _keys(keys.address_numbers, "address"),
    "num_loc_keys": _keys(keys.number_location_keys, "address"),
    "compact_ngrams": _keys(keys.compact_ngrams, "name"),
    "df_name": _frequent("name"),
    "df_addr": _frequent("addr"),
    "df_num_loc": _frequent("num_loc"),
    "df_ngram": _frequent("ngram"),
    "exact_name_block": exact_name_block,
    "rare_token_block": _pass("name"),
    "address_token_block": _pass("addr"),
    "num_loc_block": _pass("num_loc"),
    "ngram_block": _pass("ngram"),
    "overflow_events": overflow_events,
    "missing_country_block": missing_country_block,
    "global_fallback_block": global_fallback_block,
    "cross_country_block": cross_country_block,
    "merged_passes": merged_passes,
    "candidate_pairs": candidate_pairs,
    "candidate_pairs_defaults": candidate_pairs_defaults,
    "provenance_breakdown": provenance_breakdown,
    "evidence_tiers": evidence_tiers,
    "ranked_capped": ranked_capped,
    "cap_counts": cap_counts,
    "export_rows": export_rows,
    "candidate_distribution": candidate_distribution,
    "holdout_members": holdout_members,
    "ground_truth": ground_truth,
    "recall_metrics": recall_metrics,
    "cap_sweep_summary": cap_sweep_summary,
    "macro_f05": macro_f05,
    "check_errors": check_errors,
    "matched_not_candidate": matched_not_candidate,
} | file_queries.QUERIES
