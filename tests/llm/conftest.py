import random

import pytest

T = "one two three four five six seven eight nine ten eleven twelve thirteen"
SCHEMA = "doc_id long, text string, lang string, source string, size int, Shard string, __at string, copies string, tail_prob string, fp string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and very long texts, repeated rows, equal texts, and columns whose names clash with results or helpers."""
    long = " ".join(f"w{i % 9000}" for i in range(40_000)) + "\n" + "x" * 70_000
    rest = ("en", "a", 5, "x", "y", "z", "t", "f")
    rows = [(1, T, *rest), (1, T, *rest), (2, None, "en", None, *rest[2:]), (3, "", "en", "b", *rest[2:]), (None, T + " more", *rest), (4, " \t\n", *rest),
            (5, long, "en", "b", *rest[2:]), (6, T, *[None] * 8), (7, "Ein Wort", *rest), (8, "A b\nA b\n\nA b", *rest)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def prose():
    """[(doc_id, text)]: random prose with exact and near copies."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randrange(1, 8))) for _ in range(400)]
    texts = []
    for k in range(120):
        if k % 6 == 5:
            w = rng.choice(texts).split(" ")
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w))
        else:
            texts.append("".join(rng.choice(words) + rng.choice(["  ", " ", " ", ".\n"]) for _ in range(rng.randrange(1, 150))))
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def prose_docs(spark, prose):
    return spark.createDataFrame([(i, t, "en", f"s{i % 4}") for i, t in prose], "doc_id long, text string, lang string, source string").repartition(4)
