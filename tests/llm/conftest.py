import random

import pytest

SCHEMA = "doc_id long, text string, source string, lang string, kept boolean, size long, shard string, _row long, _copies int"


def words(rng, n, stock=400):
    return " ".join(f"{rng.choice('bcdfg')}{rng.randrange(stock)}" for _ in range(n))


def awkward_documents():
    """Nulls in every column, empty and very long texts, ties, repeated rows, near and exact copies."""
    rng = random.Random(3)
    rows = []
    base = words(rng, 120)
    shared = words(rng, 60)
    for i in range(60):
        text = words(rng, rng.choice([1, 3, 4, 5, 12, 13, 14, 40, 200]))
        rows.append((i, text))
    for i in range(60, 70):  # near copies
        w = base.split()
        w[rng.randrange(len(w))] = f"new{i}"
        rows.append((i, " ".join(w)))
    for i in range(70, 80):  # copies but for white space, a shared passage
        rows.append((i, base.replace(" ", rng.choice([" ", "\n", "  ", "\t"]))))
        rows.append((i + 20, words(rng, 30) + " " + shared + "\n" + words(rng, 30)))
    rows += [(200, ""), (201, None), (202, " \n\t "), (203, "é ü ñ 日本 語  x <|endoftext|> don't"), (204, words(rng, 9000)), (205, "same same " * 30), (206, "same " * 61), (None, base), (None, None), (0, rows[0][1]), (61, rows[61][1])]
    return [(i, t, None if k % 11 == 0 else f"s{k % 4}", None if k % 7 == 0 else "xx", True, 5, "a", 1, 2) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def rows():
    return awkward_documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def unique(rows):
    """Rows with an id of their own."""
    seen = {}
    for r in rows:
        if r[0] is not None:
            seen.setdefault(r[0], r)
    return list(seen.values())
