"""Recall of near-dedup against an exact join: python -m tests.llm.recall_near [folder of tables] [w] [percent].

The exact links come from a prefix filter in one process: two sets of at least the threshold's similarity share one of
each one's rarest n - ceil(threshold * n) + 1 shingles. Told is the share of linked pairs of different sets whose
documents have one component, and whether all components agree.
"""

from __future__ import annotations

import sys
from collections import Counter, defaultdict

import pyarrow.parquet as pq
from pyspark.sql import SparkSession

from kinforge.llm import near_dedup


def exact_links(texts, w: int, percent: int) -> tuple[list[frozenset], list[tuple[int, int]]]:
    """The distinct shingle sets' hashes of each text, and pairs of different sets that reach the threshold."""
    values, counts = near_dedup.shingles(texts, w)
    ends = counts.cumsum()
    sets = [frozenset(values[e - c : e].tolist()) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
    once = list(dict.fromkeys(s for s in sets if s))
    common = Counter(x for s in once for x in s)
    index, links = defaultdict(list), []
    for k, s in enumerate(once):
        met = set()
        for x in sorted(s, key=lambda x: (common[x], x))[: len(s) + (-len(s) * percent // 100) + 1]:
            met.update(index[x])
            index[x].append(k)
        for j in met:
            both = len(s & once[j])
            if 100 * both >= percent * (len(s) + len(once[j]) - both):
                links.append((j, k))
    place = {s: k for k, s in enumerate(once)}
    return [place.get(s) for s in sets], links


def main(sf_dir: str = "/root/testdata/sf0.1", w: str = "3", percent: str = "85") -> None:
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])
    of, links = exact_links(table.column("text").combine_chunks(), int(w), int(percent))
    root = list(range(max((k for k in of if k is not None), default=-1) + 1))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    for a, b in links:
        root[find(a)] = find(b)
    ids = table.column("doc_id").to_pylist()
    least: dict[int, int] = {}
    for i, k in zip(ids, of, strict=True):
        if k is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    expected = {i: i if k is None else least[find(k)] for i, k in zip(ids, of, strict=True)}
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()
    got = {r["id"]: r["component_id"] for r in near_dedup.clusters(spark.read.parquet(f"{sf_dir}/documents.parquet"), w=int(w), percent=int(percent)).collect()}
    first = {}
    for i, k in zip(ids, of, strict=True):
        first.setdefault(k, i)
    found = sum(got[first[a]] == got[first[b]] for a, b in links)
    print(f"{sf_dir}, w {w}, {percent} %: {len(ids)} documents, {len(root)} sets, {len(links)} links between sets, recall {found / max(1, len(links)):.6f}, documents in another component {sum(got[i] != c for i, c in expected.items())}")


if __name__ == "__main__":
    main(*sys.argv[1:])
