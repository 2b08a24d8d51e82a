"""Language ID, toxicity and nearest neighbours on given tables and awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from syncspark.llm import neighbours
from syncspark.llm.langid import address_code, document_evidence, fit, host_of, identify, page_evidence
from syncspark.llm.neighbours import nearest
from syncspark.llm.toxicity import score_toxicity

TABLES = "/root/testdata/sf0.01"


def test_languages_of_documents_held_out(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    model = fit(docs.filter("doc_id % 2 = 0"))
    found = identify(document_evidence(docs.filter("doc_id % 2 = 1")), model, ["doc_id"]).join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r["language"] == r["lang"] for r in found)
    assert len(found) == 500 and right >= 0.98 * len(found) and sum(r["accepted"] for r in found) >= 0.98 * len(found)


def test_pages_by_all_evidence(spark):
    docs, pages = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "pages"))
    declared = pages.select("page_id", F.regexp_extract("html", 'lang="(..)"', 1).alias("lang"))
    found = identify(page_evidence(pages), fit(docs), ["page_id"]).join(declared, "page_id").collect()
    assert sum(r["language"] == r["lang"] for r in found) >= 0.95 * len(found)


def test_other_evidence_decides_where_the_text_does_not(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    model = fit(docs)
    rows = docs.select(F.col("doc_id").alias("k"), "text", F.col("lang").alias("declared"), F.col("lang").alias("address"), F.concat("lang", F.lit(".example.org")).alias("host"))
    vague = spark.createDataFrame([(-1, "1", "fr", "fr", "fr.example.org"), (-3, None, "fr", "fr", "fr.example.org"), (-4, "日本語 漢字 平仮名 片仮名", None, None, None), (-5, "", None, None, None)], rows.schema)
    found = {r["k"]: r for r in identify(rows.union(vague), model, ["k"]).filter("k < 0").collect()}
    assert found[-1]["language"] == "fr" and found[-1]["accepted"]
    assert not any(found[k]["accepted"] for k in (-3, -4, -5)) and found[-4]["language"] == "other"


def test_addresses(spark):
    rows = [("https://u@a.B.example.com:80/fr/x?y", "a.b.example.com", "fr"), ("http://x.de/page", "x.de", "de"), ("http://x.org/fr-CA", "x.org", "fr"), ("http://x.org/free", "x.org", None), ("nothing", "", None), (None, None, None)]
    df = spark.createDataFrame([r[:1] for r in rows], "url string")
    assert [(r[0], r[1]) for r in df.select(host_of(F.col("url")), address_code(F.col("url"))).collect()] == [r[1:] for r in rows]


def test_awkward_documents_have_a_language_each(docs, rows, none):
    found = identify(document_evidence(docs), fit(docs), ["doc_id"]).collect()
    assert len(found) == len(rows) and all(r["language"] in ("xx", "other") for r in found)
    assert not any(r["accepted"] for r in found if r["n_words"] == 0)
    assert identify(document_evidence(none), fit(none), ["doc_id"]).count() == 0
    assert not any(r["accepted"] for r in identify(document_evidence(docs), fit(none), ["doc_id"]).collect())


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = score_toxicity(docs, labels).join(labels.filter("toxic is not null").select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    p, y = np.array([r["score"] for r in found]), np.array([r["toxic"] for r in found])
    order = np.argsort(np.argsort(p))
    area = (order[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    caught, wrong = (p[y == 1] >= 0.7).mean(), (p[y == 0] >= 0.7).mean()
    assert area > 0.92 and caught > 0.65 and wrong < 0.03, (area, caught, wrong)


def test_misspelt_words_are_scored_by_their_parts(spark):
    rng = random.Random(2)
    plain = [f"{a}{b}{c}" for a in "bdg" for b in "aeo" for c in ("rin", "lot", "mus", "ten")]
    rows = []
    for i in range(900):
        w = [rng.choice(plain) for _ in range(40)]
        if i % 5 == 0:
            w[rng.randrange(40)] = rng.choice(["grubworm", "snotface", "dunghead"])
        rows.append((i, " ".join(w), int(i % 5 == 0)))
    new = [(5000, "darin gelot grubwurm bamus", 0), (5001, "darin gelot bamus", 0), (5002, None, 0), (None, "", 0)]
    df = spark.createDataFrame(rows + new, "doc_id long, text string, toxic int")
    found = {r["doc_id"]: r for r in score_toxicity(df.select("doc_id", "text"), df.filter("doc_id < 5000").select("doc_id", "toxic")).collect()}
    assert found[5000]["score"] > 10 * found[5001]["score"] and found[5001]["predicted"] == 0
    assert 0 <= found[5002]["score"] < 0.7 and found[None]["held_out"] is False
    assert sum(found[i]["predicted"] != int(i % 5 == 0) for i in range(900)) < 20


def test_toxicity_without_labels(docs, rows, none, spark):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert {r["predicted"] for r in score_toxicity(docs, labels).collect()} == {0}
    assert score_toxicity(none, labels).count() == 0


def test_neighbours_of_few_rows_are_all_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.0, 3.0]), (1, [4.0, 3.0]), (2, [0.0, 3.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, 2.0, 3.0]), (100, [0.0, -3.0]), (100, [0.0, -3.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    found = {}
    for r in nearest(df, df.filter("vec_id % 100 = 0")).orderBy("rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found == {0: [(2, 0.0), (1, 4.0), (100, 6.0)], 100: [(0, 6.0), (2, 6.0), (1, pytest.approx(52**0.5))]}
    assert nearest(df.filter("false"), df).count() == nearest(df, df.filter("false")).count() == 0


def test_neighbours_recall_with_copies(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(3000, 16))
    vectors[1000:2000] = vectors[0]  # a third are one vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").cache()
    exact = np.array([r["embedding"] for r in df.orderBy("vec_id").collect()], np.float64)
    found = {}
    for r in nearest(df, df.filter("vec_id % 100 = 0")).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = 0
    for q in range(0, 3000, 100):
        distance = np.sqrt(((exact - exact[q]) ** 2).sum(1))
        distance[q] = np.inf
        best = np.lexsort((np.arange(3000), distance))[:10]
        mine = [found[q][k] for k in range(1, 11)]
        assert mine == sorted(mine, key=lambda x: (x[1], x[0])) and all(abs(distance[i] - d) < 1e-12 for i, d in mine)
        hits += len({i for i, _ in mine} & set(best.tolist()))
    assert hits >= 0.9 * 300 and [found[1500][k][0] for k in range(1, 11)] == [0, *range(1000, 1009)]


def test_neighbours_of_near_equal_vectors_are_dealt_over_parts(spark, monkeypatch):
    """A third of the vectors have the same strings; no group gets many more than a slice."""
    from pyspark.sql.pandas.group_ops import PandasCogroupedOps

    whole = PandasCogroupedOps.applyInPandas

    def bounded(self, function, schema):
        def run(key, own, ask):
            assert len(own) <= 250, f"{len(own)} entries in one group"
            return function(key, own, ask)

        return whole(self, run, schema)

    monkeypatch.setattr(neighbours, "SLICE", 100)
    monkeypatch.setattr(PandasCogroupedOps, "applyInPandas", bounded)
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(3000, 16))
    vectors[1000:2000] = vectors[0] + rng.normal(size=(1000, 16)) * 1e-9
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").cache()
    found = {}
    for r in nearest(df, df.filter("vec_id % 100 = 0")).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, 3000, 100):
        distance = ((vectors - vectors[q]) ** 2).sum(1)
        distance[q] = np.inf
        best = set(np.lexsort((np.arange(3000), distance))[:10].tolist())
        assert len(found[q]) == 10 and (found[q] == best or not 1000 <= q < 2000)
        hits += len(found[q] & best)
    assert hits >= 0.9 * 300
