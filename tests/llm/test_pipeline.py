import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kinforge.llm import arrow_text, quality_classifier, quality_rules, queries
from tests.llm.test_dedup import linked, sets
from tests.llm.test_text_operators import check_packed, plain_score, verdicts
from tests.test_queries import plain

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    """Each stage on its own input, against plain code."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, docs, SF).persist()
        seen.append((docs, out))
        if k < 4:
            assert out.columns == docs.columns
        docs = out
    rows = lambda frame: {r["doc_id"]: r for r in frame.collect()}
    before, after = map(rows, seen[0])
    judged = quality_rules.judge(seen[0][0]).collect()
    expected = set()
    for lang in {r["row"]["lang"] for r in judged}:
        expected |= {i for i, kept in verdicts([r for r in judged if r["row"]["lang"] == lang]).items() if kept}
    assert set(after) == expected
    assert set(after) < set(before)
    before, after = map(rows, seen[1])
    weights = quality_classifier.train(seen[0][0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert set(after) == {i for i, r in before.items() if plain_score(r["text"], weights) >= 0.7}
    assert 0 < len(after) < len(before)
    before, after = map(rows, seen[2])
    newest = {}
    for i, r in before.items():
        newest[r["text"].lower()] = max(i, newest.get(r["text"].lower(), -1))
    assert set(after) == set(newest.values())
    before, after = map(rows, seen[3])
    assert set(after) == {i for i, c in linked(sets(before.values(), 5), 80).items() if i == c}
    check_packed(seen[4][1].collect(), {i: r["text"] for i, r in after.items()})
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(r["doc_id"] for r in seen[4][1].collect())


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_pipeline_on_odd_tables(spark, documents, tmp_path, rows):
    """Nulls, empty and long texts, ties, repeated rows and columns with clashing names, and no rows, through all stages."""
    names = "row _first score kept rules best maybe filter block label rank length piece start sequence_id offset".split()
    docs = documents.unionByName(documents.limit(30)).select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    docs = docs.unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    if rows == "none":
        docs = docs.limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs.select("doc_id", (F.length("text") > 200).cast("int").alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, docs, str(tmp_path)).persist()
        assert k == 4 or out.columns == docs.columns
        if rows == "none":
            assert out.count() == 0
        docs = out
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_long_texts_are_taken_few_at_a_time(spark, monkeypatch):
    """No array of thousands of texts in a task, and no second copy of what is learnt from on the driver."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, function in corpus_pipeline.STAGES:
        spark.conf.set(arrow_text.READ_SETTING, 4096)
        if name == "quality classifier":
            monkeypatch.setattr(type(docs), "toArrow", lambda self: pytest.fail("all rows at once"))
            monkeypatch.setattr(type(docs), "collect", lambda self: pytest.fail("all rows at once"))
        function(spark, docs, SF)
        monkeypatch.undo()
        assert int(spark.conf.get(arrow_text.READ_SETTING)) == arrow_text.READ_ROWS, name


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    frame = queries.QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    expected = con.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert plain(tuple(r) for r in frame.select(*columns).collect()) == plain(expected)


def test_all_are_registered():
    numbers = sorted(int(q.split("_")[0][2:]) for q in queries.QUERIES)
    assert numbers == list(range(1, 11))
