import random

import pytest
from pyspark.sql import functions as F

from kinforge.operators import evaluation, lists, passes, ranking
from kinforge.operators.store import CandidateStore
from kinforge.plans.blocking import Blocking, CandidateIndex, candidates_for
from kinforge.schema import PROVENANCE, BlockingConfig

RECORD = "source string, entity_id string, name string, address string, country string"


def block(spark, rows, **settings):
    return Blocking(spark.createDataFrame(rows, RECORD), BlockingConfig(**settings))


def s2(i, name, address="", country="us"):
    return ("S2", f"S2-{i}", name, address, country)


def s1(i, name, address="", country="us"):
    return ("S1", f"S1-{i}", name, address, country)


def found(frame):
    return {(r["s1_id"], r["cand_id"]) for r in frame.collect()}


def test_frequent_keys_are_filtered(spark):
    b = block(spark, [s2(i, "popular biz") for i in range(10)] + [s2(99, "rare biz"), s1(1, "popular"), s1(2, "rare")], max_name_df_absolute=3)
    flags = {r["key"]: r["filtered"] for r in b.frequencies.where("family = 'name'").collect()}
    assert flags["popular"]
    assert not flags["rare"]
    assert found(b.blocks("name").pairs()) == {("S1-2", "S2-99")}
    event = b.blocks("name").events().where("is_filtered").first()
    assert (event["key"], event["generated_count"], event["retained_count"]) == ("popular", -1, 0)


def test_overflow_is_kept_and_told(spark):
    b = block(spark, [s2(i, "overflowing") for i in range(3)] + [s1(1, "overflowing")], max_block_size=2)
    blocks = b.blocks("name")
    assert len(found(blocks.pairs())) == 3
    event = blocks.events().collect()
    assert len(event) == 1
    assert event[0].asDict() == {"s1_id": "S1-1", "source": "S2", "block_family": "rare_name_token", "key": "overflowing", "generated_count": 3, "retained_count": 3, "truncated_count": 0, "is_filtered": False, "refinement_attempted": True, "refined": False}


def test_refinement(spark):
    b = block(spark, [s2(1, "phoenix aerospace"), s2(2, "phoenix logistics"), s2(3, "phoenix dynamics"), s1(1, "phoenix aerospace")], max_block_size=2)
    assert found(b.blocks("name").pairs()) == {("S1-1", "S2-1")}


def oracle(asked, posted, filtered, size, apart):
    """One record's candidates, key by key."""
    out, events = set(), []
    for i, key in enumerate(asked):
        block = posted.get(key, set())
        if key in filtered or not block:
            continue
        if len(block) <= size:
            out |= block
            continue
        for j, other in enumerate(asked):
            both = block & posted.get(other, set())
            if apart(i, j) and other not in filtered and 0 < len(both) <= size:
                out |= both
                events.append((f"{key}+{other}", len(block), len(both), True))
                break
        else:
            out |= block
            events.append((key, len(block), len(block), False))
    return out, events


@pytest.mark.parametrize("family", ["name", "ngram"])
def test_refinement_against_loop(spark, family):
    rng = random.Random(5)
    if family == "name":
        make = lambda: " ".join(rng.sample([f"w{c}" for c in "abcdefgh"], rng.randint(1, 5)))
        cut = lambda n: list(dict.fromkeys(n.split()))
        apart = lambda i, j: i != j
    else:
        make = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(3, 12)))
        cut = lambda n: list(dict.fromkeys([n] if len(n) < 4 else [n[i : i + 4] for i in range(len(n) - 3)]))
        apart = lambda i, j: abs(i - j) >= 4
    rows = [s2(i, make()) for i in range(60)] + [s1(i, make()) for i in range(30)]
    b = block(spark, rows, max_block_size=4, max_name_df_absolute=25, max_name_df_relative=1.0, max_ngram_df_absolute=25, max_ngram_df_relative=1.0)
    posted = {}
    for _, i, name, _, _ in rows[:60]:
        for k in cut(name):
            posted.setdefault(k, set()).add(i)
    filtered = {k for k, v in posted.items() if len(v) > 25}
    pairs, events = set(), set()
    for _, i, name, _, _ in rows[60:]:
        got, said = oracle(cut(name), posted, filtered, 4, apart)
        pairs |= {(i, c) for c in got}
        events |= {(i, *e) for e in said}
    blocks = b.blocks(family)
    assert found(blocks.pairs()) == pairs
    assert {(e["s1_id"], e["key"], e["generated_count"], e["retained_count"], e["refined"]) for e in blocks.events().where("not is_filtered").collect()} == events


def test_missing_countries(spark):
    b = block(spark, [s2(1, "omni tech", country=""), s2(2, "omni tech"), s1(1, "omni tech", country=""), s1(2, "omni tech", country="france")])
    bits = {(r["s1_id"], r["cand_id"]): r["provenance"] for r in b.pairs.collect()}
    assert bits[("S1-1", "S2-1")] == bits[("S1-1", "S2-2")] == PROVENANCE["missing_country_fallback"]
    assert bits[("S1-2", "S2-1")] == PROVENANCE["missing_country_fallback"]


def test_cross_country(spark):
    stored = [s2(1, "hyperion robotics", country="france"), s2(2, "hyperion logistics", country="france"), s2(3, "quantum cybernetics labs", country="france")]
    b = block(spark, [*stored, s1(1, "hyperion robotics"), s1(2, "hyperion"), s1(3, "quantum cybernetics")])
    assert found(b.cross_country()) == {("S1-1", "S2-1"), ("S1-3", "S2-3")}
    near = [s2(i, "", "7 elm", "france") for i in range(3)]
    assert len(found(block(spark, [*near, s1(1, "", "7 elm")], max_block_size=3).cross_country())) == 3
    assert not found(block(spark, [*near, s1(1, "", "7 elm")], max_block_size=2).cross_country())


def test_merge_and_rank(spark):
    rows = [("S1-1", "S2", "S2-001", 16), ("S1-1", "S2", "S2-002", 1), ("S1-1", "S2", "S2-002", 2), ("S1-1", "S2", "S2-003", 8), ("S1-1", "S2", "S2-003", 4), ("S1-1", "S2", "S2-004", 1)]
    pairs = passes.merge(spark.createDataFrame(rows, "s1_id string, source string, cand_id string, bit int"))
    assert {r["cand_id"]: r["provenance"] for r in pairs.collect()} == {"S2-001": 16, "S2-002": 3, "S2-003": 12, "S2-004": 1}
    assert found(ranking.rank(pairs, 2)) == {("S1-1", "S2-002"), ("S1-1", "S2-004")}
    assert ranking.counts(pairs, 2).first()["truncated"] == 2


def test_export(spark):
    pairs = spark.createDataFrame([("S1-01", "S2", "S2-10", 1), ("S1-01", "S3", "S3-01", 1), ("S1-03", "S3", "S3-20", 1), ("S1-03", "S9", "S9-1", 1)], "s1_id string, source string, cand_id string, provenance int")
    ids = spark.createDataFrame([("S1-01",), ("S1-02",), ("S1-03",)], "s1_id string")
    assert {r["s1_id"]: r["candidates"] for r in ranking.export(ids, pairs, 5).collect()} == {"S1-01": "S2-10,S3-01", "S1-02": "", "S1-03": "S3-20"}


def test_distribution(spark):
    values = spark.range(1, 101).select(F.col("id").alias("n"))
    got = ranking.distribution(values, "n").first().asDict()
    assert got == {"min": 1, "median": 51, "mean": 50.5, "p95": 96, "p99": 100, "max": 100}
    assert ranking.distribution(values.where("n < 0"), "n").first().asDict() == {"min": 0, "median": 0, "mean": 0.0, "p95": 0, "p99": 0, "max": 0}


def test_recall_and_f05(spark):
    truth = spark.createDataFrame([("S1-1", ["S2-10", "S3-20"]), ("S1-2", []), ("S1-3", ["S2-30"])], "s1_id string, matched array<string>")
    pairs = spark.createDataFrame([("S1-1", "S2", "S2-10", 1), ("S1-3", "S2", "S2-30", 3)], "s1_id string, source string, cand_id string, provenance int")
    got = evaluation.recall(truth, pairs).first().asDict()
    assert (got["true_pairs"], got["hits"], got["s1_with_hits"], got["singletons"], got["without_candidates"], got["only_exact_name"]) == (3, 2, 2, 1, 1, 1)
    scores = {r["s1_id"]: round(r["f05"], 3) for r in evaluation.macro_f05(truth, pairs).collect()}
    assert scores == {"S1-1": 0.833, "S1-2": 1.0, "S1-3": 1.0}


def test_empty_tables(spark):
    b = block(spark, [])
    assert b.pairs.count() == 0
    assert b.blocks().events().count() == 0


def test_store(spark, tmp_path):
    store = CandidateStore(spark, str(tmp_path / "store"))
    assert store.pairs().count() == 0
    schema = "s1_id string, source string, cand_id string, provenance int"
    store.add(spark.createDataFrame([("S1-1", "S2", "S2-1", 1), ("S1-1", "S3", "S3-1", 4)], schema))
    store.add(spark.createDataFrame([("S1-1", "S2", "S2-1", 2), ("S1-2", "S2", "S2-9", 16)], schema))
    for _ in range(2):
        assert {(r["s1_id"], r["cand_id"]): r["provenance"] for r in store.pairs().collect()} == {("S1-1", "S2-1"): 3, ("S1-1", "S3-1"): 4, ("S1-2", "S2-9"): 16}
        told = store.diagnostics()
        assert (told["total_candidate_pairs"], told["candidate_pairs_by_source"], told["provenance_breakdown"]["rare_name_token"]) == (3, {"S2": 2, "S3": 1}, 1)
        store.compact()
    assert store.s1_ids().count() == 2
    assert store.capped(1).count() == 3


def test_store_export(spark, tmp_path):
    store = CandidateStore(spark, str(tmp_path / "store"))
    store.add(spark.createDataFrame([("S1-2", "S3", "S3-1", 1), ("S1-2", "S2", "S2-9", 1), ("S1-2", "S2", "S2-1", 2)], "s1_id string, source string, cand_id string, provenance int"))
    (tmp_path / "s1.tsv").write_text("entity_id\tname\nS1-9\tx\nS1-2\ty\n")
    told = store.export_tsv(str(tmp_path / "lists.tsv"), str(tmp_path / "s1.tsv"), 1)
    assert (tmp_path / "lists.tsv").read_text() == "S1-9\t\nS1-2\tS2-9,S3-1\n"
    assert (told["total_candidate_pairs_generated"], told["total_candidate_pairs_truncated_by_caps"], told["s1_capped_by_safety_budget"]) == (3, 1, 1)
    # a compaction that was cut off after the old files lost their name
    (tmp_path / "store").rename(tmp_path / "store.old")
    assert store.pairs().count() == 3


ODD = ["", "S2-9", "S2-10", "S2-009", "S2-08", "x", "S3-last", "S2-" + "7" * 20, "a1\n", "12", "0", "S2-9" + "0" * 17, "é3", "٣", None]


@pytest.mark.parametrize("at_once", [1 << 20, 3])
def test_store_of_odd_ids(spark, tmp_path, monkeypatch, at_once):
    """Ids of any form, masks of any bits, pairs that repeat within and between batches: as groups and ranks of all pairs."""
    monkeypatch.setattr(lists, "AT_ONCE", at_once)
    rng = random.Random(1)
    batches = [[(rng.choice(["S1-1", "S1-2", "", None]), rng.choice(["S2", "S3"]), rng.choice(ODD + [f"S2-{rng.randint(0, 10**rng.randint(1, 9)):09}"]), rng.choice([0, 1, 64, 127, 128, 1 << 20, -1, 3])) for _ in range(300)] for _ in range(3)]
    schema = "s1_id string, source string, cand_id string, provenance int"
    store, every = CandidateStore(spark, str(tmp_path / "store")), spark.createDataFrame(sum(batches, []), schema)
    whole = every.groupBy("s1_id", "source", "cand_id").agg(F.bit_or("provenance").alias("provenance"))
    for batch in batches:
        store.add(spark.createDataFrame(batch, schema))
    told = lambda frame: sorted(map(str, frame.collect()))
    # evidence_tier sees a mask's seven bits and counts all bits
    for _ in range(2):
        assert told(store.pairs()) == told(whole)
        assert told(store.capped(4).select("s1_id", "source", "cand_id", "provenance", "rank")) == told(ranking.rank(whole, 4))
        monkeypatch.setattr("kinforge.operators.store.COMPACTED", 1000)
        store.compact()
    assert store.s1_ids().count() == 4


def test_store_takes_lists_of_numbers(spark, tmp_path):
    """A store of whole blocks has no row for each pair, and cuts the bits of lists as of pairs."""
    rows = [s2(i, "popular biz", address="1 main lane") for i in range(100, 300)] + [s1(i, "popular biz", address="1 main lane") for i in range(20)]
    b = block(spark, rows)
    made = b.lists()
    assert made.count() == 20
    assert b.pairs.count() == 4000
    assert made.agg(F.sum(F.length("gaps") + F.length("masks"))).first()[0] < 3 * 4000
    store = CandidateStore(spark, str(tmp_path / "store"))
    for bits in (15, 124):
        store.add(lists.masked(made, bits))
    store.compact()
    assert store.spark.read.parquet(store.path).count() == 20
    assert sorted(map(tuple, store.pairs().collect())) == sorted(map(tuple, b.pairs.collect()))
    store.add(spark.createDataFrame([("S1-1", "S2", "S2-100", 128), ("S1-1", "S2", "S2-999", 1)], "s1_id string, source string, cand_id string, provenance int"))
    again = {r["cand_id"]: r["provenance"] for r in store.pairs().where("s1_id = 'S1-1'").collect()}
    assert len(again) == 201
    assert again["S2-100"] == 128 + again["S2-101"]


def test_index(spark, tmp_path):
    """An index answers many times, grows, and comes back from its folder."""
    rows = [s2(i, f"popular biz{i}") for i in range(8)] + [s2(20, "rare", country="fr"), s2(21, "none", country="")]
    frame = lambda part: spark.createDataFrame(part, RECORD)
    config = BlockingConfig(max_name_df_absolute=6)
    whole = CandidateIndex.build(frame(rows), config)
    grown = CandidateIndex.build(frame(rows[:5]), config).add(frame(rows[5:]))
    grown.save(f"file://{tmp_path}/index")
    back = CandidateIndex.load(spark, f"file://{tmp_path}/index", config)
    for index in (grown, back):
        assert sorted(map(tuple, index.frequencies.collect())) == sorted(map(tuple, whole.frequencies.collect()))
        assert candidates_for(("S1-1", "rare", "", "us"), index, config) == candidates_for(("S1-1", "rare", "", "us"), whole, config)
    assert {r["country"] for r in whole.countries.collect()} == {"us", "fr"}
    assert back.size_bytes() > 0


def test_one_record(spark):
    stored = spark.createDataFrame([s2(1, "omega works"), s2(2, "delta")], RECORD)
    assert candidates_for(("S1-1", "omega works", "", "us"), stored, BlockingConfig()) == {"S2-1": PROVENANCE["exact_name"] | PROVENANCE["rare_name_token"] | PROVENANCE["compact_char_ngram"]}
