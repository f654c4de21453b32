import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randint(0, words)}" for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    """Small documents with all that the operators must stand: nulls, empty and long texts, copies, repeats."""
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    texts += [None, "", " ", "\n\n", "a", "a b", "A  B\n", "É é", "日本語 テキスト 😀", prose(rng, 30_000), "word " * 5000, "x" * 20_000]
    texts += [texts[3], texts[3].upper(), texts[3] + " tail", texts[4].replace("w1 ", "w2 ", 1), "a\tb", "line\n" * 30]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", len(t) if t else None) for i, t in enumerate(texts)]
    rows.append(rows[5])  # a row twice
    return spark.createDataFrame(rows, DOCS).persist()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(documents):
    """Extra columns named as the operators name their own."""
    from pyspark.sql import functions as F

    names = "row text_ id score kept digest keep_id group_size rules best at maybe block filter cell places same n bands signature label rank salt length piece start ids _first key query asks class classes hash before k settled places_ row_no h1 h2 again first hashes pattern verdict".split()
    return documents.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])


def by_id(rows, key="doc_id"):
    return {r[key]: r for r in rows}
