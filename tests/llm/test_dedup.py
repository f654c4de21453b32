import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinforge.llm import bloom, components, exact_dedup, line_dedup, near_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def groups(rows):
    out = defaultdict(list)
    for r in rows:
        out[(r["text"] or "").translate(LOWER)].append(r["doc_id"])
    return out


def test_exact(spark, documents, nothing, clashing):
    rows = documents.collect()
    expected = groups(rows)
    got = exact_dedup.annotate(documents).collect()
    assert len(got) == len(rows)
    text = {r["doc_id"]: (r["text"] or "").translate(LOWER) for r in rows}
    for r in got:
        ids = expected[text[r["id"]]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(ids), len(ids), r["id"] == max(ids))
        assert r["text_sha256"] == hashlib.sha256(text[r["id"]].encode()).hexdigest()
    kept = exact_dedup.dedupe(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(max(v) for v in expected.values())
    assert exact_dedup.annotate(nothing).count() == exact_dedup.dedupe(nothing).count() == 0


def test_exact_nulls(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "a"), (1, "A"), (None, "alone"), (2, None), (3, "")], "doc_id long, text string")
    got = [(r["keep_id"], r["group_size"]) for r in exact_dedup.annotate(rows).collect()]
    assert sorted(got, key=str) == sorted([(1, 3), (1, 3), (1, 3), (None, 1), (3, 2), (3, 2)], key=str)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in exact_dedup.dedupe(rows).collect()) == [(0, "alone"), (1, "A"), (3, "")]


def test_exact_full_filter(spark, monkeypatch):
    """A filter without room lets all rows through to the exact step and changes nothing."""
    monkeypatch.setattr(exact_dedup, "CELLS", 3)
    rows = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 120).cast("string").alias("text"))
    got = {r["id"]: r for r in exact_dedup.annotate(rows).collect()}
    assert all(got[i]["keep_id"] == (i % 120 + 120 if i % 120 < 80 else i) for i in range(200))


def test_exact_large_filter(spark, documents, monkeypatch):
    """A filter that is too large to go to all tasks meets the rows in a shuffled join, with the same result."""
    expected = sorted(map(tuple, exact_dedup.annotate(documents).collect()), key=str)
    kept = sorted(map(str, exact_dedup.dedupe(documents).collect()))
    monkeypatch.setattr(bloom, "MOST_BROADCAST", 0)
    monkeypatch.setattr(bloom, "PER_BLOCK", 2)
    assert sorted(map(tuple, exact_dedup.annotate(documents).collect()), key=str) == expected
    assert sorted(map(str, exact_dedup.dedupe(documents).collect())) == kept


def test_bloom(spark):
    inside = bloom.BloomFilter(spark.range(0, 9000).select(F.col("id").alias("key")))
    marked = inside.mark(spark.range(0, 30_000), F.col("id"))
    assert marked.where("id < 9000 and not maybe").count() == 0
    assert marked.where("id >= 9000 and maybe").count() < 1000
    assert bloom.BloomFilter(spark.range(0).select(F.col("id").alias("key"))).mark(spark.range(5), F.col("id")).where("maybe").count() == 0


def lines_of(rows, least):
    found = defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if key := line.strip(" \t\n\x0b\x0c\r").translate(LOWER):
                found[key].add((r["doc_id"], r["text"]))
    return {k for k, v in found.items() if len(v) >= least}


@pytest.mark.parametrize("batches", [1, 5])
def test_lines(spark, documents, clashing, nothing, batches):
    rng = random.Random(2)
    pool = [f"line {i}" for i in range(12)] + ["", " ", "LINE 1", "\tline 2 \r"]
    more = [(1000 + i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9))), None, None, None) for i in range(60)]
    rows = documents.unionByName(spark.createDataFrame(more, documents.schema))
    local = rows.distinct().collect()
    gone = lines_of(local, 10)
    assert gone
    got = {r["doc_id"]: r for r in line_dedup.drop_lines(rows, batches=batches, carry=["doc_id"]).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()}
    for r in local:
        lines = (r["text"] or "").split("\n")
        kept = [x for x in lines if x.strip(" \t\n\x0b\x0c\r").translate(LOWER) not in gone]
        assert (got[r["doc_id"]]["n_lines"], got[r["doc_id"]]["n_dropped"], got[r["doc_id"]]["kept_text"]) == (len(lines), len(lines) - len(kept), "\n".join(kept))
    if batches == 1:
        assert line_dedup.drop_lines(nothing).count() == 0
        assert line_dedup.drop_lines(clashing).select("row.*").columns == clashing.columns


def test_lines_of_a_growing_corpus(spark, tmp_path):
    """Batches that come later meet the runs that stand, in another Runs object too; counts are those of all."""
    rng = random.Random(5)
    rows = [(i, "\n".join(f"line {int(rng.paretovariate(0.7))}" for _ in range(rng.randint(1, 6)))) for i in range(120)]
    frame = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    folder = f"file://{tmp_path}/runs"
    got = {}
    for k in range(6):
        part = rows[20 * k : 20 * k + 20]
        for r in line_dedup.drop_lines(frame(part), batches=2, folder=folder).select("row.doc_id", "kept_text").collect():
            got[r["doc_id"]] = r["kept_text"]
        known = lines_of(frame(rows[: 20 * k + 20]).collect(), 10)
        for i, text in part:
            assert got[i] == "\n".join(x for x in text.split("\n") if x not in known)
    assert known
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    with line_dedup.Runs(spark, folder=folder) as runs, line_dedup._in_file_order(spark):
        names = [n for level in runs.levels for n in level]
        assert 1 < len(names) < 12
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (runs._merged(names[:2]), runs._unsettled(spark.table(names[0])))]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for plan in plans:
        assert "SortMergeJoin" in plan
        assert "Exchange" not in plan
        assert "Sort [" not in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("kinforge_run")]


def sets(rows, w):
    out = {}
    for r in rows:
        words = WORD.findall((r["text"] or "").translate(LOWER))
        out[r["doc_id"]] = frozenset(tuple(words[i : i + w]) for i in range(len(words) - w + 1)) if len(words) >= w else frozenset([tuple(words)]) if words else frozenset()
    return out


def linked(found, percent):
    parent = {i: i for i in found}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(found)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(found[a] & found[b])
            if found[a] and 100 * common >= percent * (len(found[a]) + len(found[b]) - common):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in found}


@pytest.mark.parametrize(("w", "percent", "small"), [(3, 85, 16), (5, 80, 16), (3, 85, 2)])
def test_near(spark, documents, clashing, nothing, monkeypatch, w, percent, small):
    """small: 2 sends nearly all buckets through the block tasks."""
    monkeypatch.setattr(near_dedup, "PAIRED", small)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 8 if small == 2 else 256)
    rng = random.Random(7)
    base = [f"v{i}" for i in range(120)]
    near = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(120), rng.randint(0, 6)):
            words[k] = f"x{rng.randint(0, 50)}"
        near.append((2000 + i, " ".join(words), None, None, None))
    rows = documents.unionByName(spark.createDataFrame(near, documents.schema))
    local = rows.collect()
    found = sets(local, w)
    expected = linked(found, percent)
    got = near_dedup.clusters(rows, w=w, percent=percent).collect()
    assert len(got) == len(local)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == (len(found[r["id"]]), expected[r["id"]])
    if small == 16:
        wide = clashing
        kept = near_dedup.dedupe(wide, w=w, percent=percent)
        assert kept.columns == wide.columns
        alone = linked(sets(documents.collect(), w), percent)
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, c in alone.items() if i == c)
        assert near_dedup.clusters(nothing, w=w, percent=percent).count() == 0


def test_near_other_ids(spark):
    rows = spark.createDataFrame([("7", "a b c"), ("9", "a b c")], "doc_id string, text string").withColumn("_first", F.lit(1))
    assert [r["doc_id"] for r in near_dedup.dedupe(rows).collect()] == ["7"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        near_dedup.dedupe(rows.withColumn("doc_id", F.lit("x"))).collect()


def test_near_nulls(spark):
    rows = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (1, "a b c d"), (2, "A b c d"), (3, None)], "doc_id long, text string")
    assert sorted(map(str, (r["doc_id"] for r in near_dedup.dedupe(rows).collect()))) == ["1", "3", "None", "None"]


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_bayes_bound(percent):
    rows, bands = near_dedup.layout(percent)
    assert (1 - (percent / 100) ** rows) ** bands <= near_dedup.BAND_MISS
    least = near_dedup.least_matches(percent)
    assert len(least) == rows * bands // near_dedup.BATCH
    assert all(a < b for a, b in zip(least, least[1:], strict=False))
    assert 0.6 < least[-1] / (rows * bands) < percent / 100


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(40)] + [(300, 300 + i) for i in range(1, 30)]
    expected = {}
    graph = defaultdict(set)
    for a, b in pairs:
        graph[a].add(b)
        graph[b].add(a)
    for start in sorted(graph):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in expected:
                expected[x] = start
                todo += graph[x]
    got = {r["id"]: r["label"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: v for k, v in expected.items() if k != v}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_kernel_against_windows():
    import pyarrow as pa

    from kinforge.llm.quality_rules import repeat_words
    from kinforge.llm.arrow_text import span_hashes, text_buffers, word_bounds

    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))) for _ in range(200)]
    raw, offsets = text_buffers(pa.array(texts))
    starts, ends, doc = word_bounds(raw, offsets)
    got = repeat_words(span_hashes(raw, starts, ends), doc, len(texts))
    for t, n in zip(texts, got.tolist(), strict=True):
        words = t.split()
        count = Counter(zip(words, words[1:], words[2:], strict=False))
        assert n == len({i + k for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for k in range(3)})
