"""All passes at once: no query may write or shuffle a row for each pair, and what it keeps must be what all pairs give."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kinforge.operators import matching, passes, ranking
from kinforge.plans import blocking, file_queries, linkage
from kinforge.plans.blocking import Blocking
from kinforge.schema import BlockingConfig

SF = "/root/testdata/sf0.001"
RECORD = "source string, entity_id string, name string, address string, country string"
#: Tables with rows that grow with the pairs.
PAIRWISE = {"pairs", "other-passes"}
QUERIES = [
    "ranked_capped",
    "provenance_breakdown",
    "file_diagnostics",
    "file_sweep",
    "cross_country_block",
    "evidence_tiers",
    "candidate_pairs_defaults",
    "candidate_pairs",
    "candidate_distribution",
    "stream_pairs",
    "recall_metrics",
    "production_projection",
    "matched_not_candidate",
    "macro_f05",
    "file_candidates",
    "export_rows",
    "cap_sweep_summary",
    "cap_counts",
]


def records(spark, n=240):
    rng = random.Random(3)
    words = [f"w{c}" for c in "abcdefghijkl"]
    make = lambda: " ".join(rng.choices(words, k=rng.randint(0, 5)))
    return spark.createDataFrame([(f"S{1 + i % 3}", f"S{1 + i % 3}-{i:04}", make(), f"{rng.randint(1, 9)} {make()}", rng.choice(["", "fr", "us", "de"])) for i in range(n)], RECORD)


@pytest.mark.parametrize("name", QUERIES)
def test_no_table_of_all_pairs(spark, monkeypatch, name):
    staged = []
    for module in (blocking, linkage):
        monkeypatch.setattr(module, "stage", lambda df, name, *a, real=module.stage: staged.append(name) or real(df, name, *a))
    entry.queries()[name](spark, SF)
    assert not PAIRWISE & set(staged)


@pytest.mark.parametrize("entries", [1 << 19, 50])
def test_found_is_what_all_pairs_give(spark, monkeypatch, entries):
    monkeypatch.setattr(matching, "ENTRIES", entries)
    b = Blocking(records(spark), BlockingConfig(max_block_size=3, max_name_df_relative=1.0, max_addr_df_relative=1.0, max_ngram_df_relative=1.0))
    pairs = [tuple(r) for r in b.pairs.select("s1_id", "source", "cand_id", "provenance").collect()]
    assert len(pairs) == len({p[:3] for p in pairs}) > 500
    whole = spark.createDataFrame(pairs, matching.PAIR)
    wanted = spark.createDataFrame([(a, c) for a, _, c, _ in pairs[::7]] + [("S1-0000", "S2-none")], "s1_id string, cand_id string")
    found = b.found(2, wanted)
    asked = {(a, c) for a, _, c, _ in pairs[::7]}
    expected = {tuple(r) for r in ranking.rank(whole).select("s1_id", "source", "cand_id", "provenance", "rank").collect() if r["rank"] <= 2 or (r["s1_id"], r["cand_id"]) in asked}
    assert {tuple(r) for r in ranking.ranked(found).collect()} == expected
    assert sorted(ranking.capped_sizes(found, 3).collect()) == sorted(ranking.counts(whole, 3).collect())
    masks = found.select("source", F.inline("masks")).groupBy("provenance", "source").agg(F.sum("n").alias("n"))
    assert sorted(ranking.breakdown_of_masks(masks).collect()) == sorted(ranking.provenance_breakdown(whole).collect())


def test_repeated_ids_and_no_candidates(spark):
    rows = records(spark, 60)
    once, twice = (Blocking(r, BlockingConfig(max_name_df_relative=1.0, max_addr_df_relative=1.0, max_ngram_df_relative=1.0)) for r in (rows, rows.unionByName(rows)))
    assert {tuple(r) for r in twice.pairs.collect()} == {tuple(r) for r in once.pairs.collect()}
    assert twice.pairs.count() == once.pairs.count()
    alone = Blocking(rows.where("source = 'S1'"), BlockingConfig())
    assert alone.pairs.count() == alone.found(1).count() == alone.cross_country().count() == 0


def crossed(rows, config, size=50):
    """Cell, record and candidate of each pair of the pass of other countries, made here."""
    told = matching._answers(iter(rows.to_batches(max_chunksize=size)), config, frozenset({"cross"}))
    return [(cell, part.column("id")[i].as_py(), index.ids[j].as_py()) for cell, part, index, row, cand, *_ in told for i, j in zip(row.tolist(), cand.tolist(), strict=True)]


@pytest.mark.parametrize("least", [1, 2, 3])
@pytest.mark.parametrize("entries", [1 << 19, 5])
@pytest.mark.parametrize("repeated", ["", "S1", "S2", "S1 S2 S3"])
def test_other_countries_by_name_are_those_by_record(spark, monkeypatch, entries, repeated, least):
    monkeypatch.setattr(matching, "ENTRIES", entries)
    config = BlockingConfig(max_block_size=3, cross_country_min_rare_tokens=least)
    some = records(spark, 150)
    copies = some.where("substr(entity_id, 4, 4) % 4 < 2").select("source", F.concat("entity_id", F.lit("-copy")).alias("entity_id"), "name", "address", F.expr("nullif(country, 'fr')").alias("country"))
    again = some.where(F.col("source").isin(*repeated.split())).select("source", "entity_id", F.reverse("name").alias("name"), "address", F.lit("de").alias("country"))
    rows = Blocking(some.unionByName(copies).unionByName(again), config)._cells().toArrow()
    found = crossed(rows, config)
    monkeypatch.setattr(matching, "index_of", matching.Index)
    expected = crossed(rows, config)
    assert sorted(found) == sorted(set(expected))
    assert len(found) == len(expected) > 100


def test_other_countries_are_asked_once_for_each_name(spark, monkeypatch):
    made, real = [], matching.Index._tokens
    monkeypatch.setattr(matching.Index, "_tokens", lambda self, *a: made.append(len(out := real(self, *a))) or out)
    rows = spark.createDataFrame([(f"S{s}", f"S{s}-{i:03}", "alpha beta gamma", "12 elm", "us" if s == 1 else "de") for s in (1, 2) for i in range(200)], RECORD)
    config = BlockingConfig(max_block_size=3)
    assert len(set(crossed(Blocking(rows, config)._cells().toArrow(), config, 1000))) == 40_000
    assert sum(made) < 40


def test_other_countries_read_few_keys_and_tell_what_is_asked(spark, monkeypatch):
    told = []
    monkeypatch.setattr(matching, "pairs", lambda rows, *a, real=matching.pairs: told.append(rows) or real(rows, *a))
    assert entry.queries()["cross_country_block"](spark, SF).columns == ["s1_id", "cand_id"]
    keys = told[0].agg(*[F.sum(F.size(f"k{i}")).alias(f"k{i}") for i in range(5)]).first()
    assert keys["k0"] and keys["k2"] and keys["k4"] and keys["k1"] == keys["k3"] == 0


def test_scores_order_as_evidence_tiers(spark):
    masks = spark.range(128).select(F.col("id").cast("int").alias("provenance"))
    tiers = {r["provenance"]: tuple(r["t"]) for r in masks.select("provenance", F.array(*ranking.evidence_tier()).alias("t")).collect()}
    assert sorted(tiers, key=tiers.get) == sorted(tiers, key=matching.scores().__getitem__)


@pytest.mark.parametrize("relative", [1.0, 0.0])
def test_events_are_those_of_the_joins(spark, relative):
    rows = records(spark).unionByName(spark.createDataFrame([("S1", "S1-alone", "wa", "", "us")], RECORD))
    b = Blocking(rows, BlockingConfig(max_block_size=3, max_name_df_relative=relative, max_addr_df_relative=1.0, max_ngram_df_relative=1.0))
    kind = F.when(F.col("is_filtered"), "filtered").when(F.col("refined"), "refined").otherwise("retained")
    expected = {(r["s1_id"], r["source"], r["kind"]): r["count"] for r in b.blocks().events().groupBy("s1_id", "source", kind.alias("kind")).count().collect()}
    met = b.found(1, events=True)
    assert {(r["s1_id"], r["source"], k): r[k] for r in met.collect() for k in matching.EVENTS if r[k]} == expected
    assert {k for _, _, k in expected} == {"refined", "retained", "filtered"} - ({"filtered"} if relative else set())
    assert sorted(map(str, met.where("generated > 0").drop(*matching.EVENTS).collect())) == sorted(map(str, b.found(1).collect()))
    told = linkage.overflow_summary(met)
    assert told["total_overflow_events"] == sum(expected.values())
    assert told["s3_overflows"] == sum(n for (_, s, _), n in expected.items() if s == "S3")


@pytest.mark.parametrize("name", ["file_diagnostics", "production_projection"])
def test_files_without_joins_of_blocks(spark, monkeypatch, name):
    staged = []
    for module in (blocking, linkage, passes):
        monkeypatch.setattr(module, "stage", lambda df, name, *a, real=module.stage: staged.append(name) or real(df, name, *a))
    file_queries._blocked.cache_clear()
    assert entry.queries()[name](spark, SF).count()
    assert "keyed" in staged
    assert not {"postings", "key-counts", "asked-keys", "met-keys"} & set(staged)


def test_run_over_files_makes_no_ground_truth(spark, monkeypatch):
    monkeypatch.setattr(file_queries, "entities", type("Entities", (), {"raw": staticmethod(file_queries.entities.raw), "CONFIG": file_queries.entities.CONFIG}))
    for made in (file_queries._made, file_queries._blocked):
        made.cache_clear()
    assert entry.queries()["production_projection"](spark, SF).count() == 1
