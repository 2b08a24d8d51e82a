"""The stages over awkward rows, each against what its operator says."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
import __spark_entry__ as entry
from syncspark.llm.mixing import mix_sources

from .conftest import SCHEMA
from .test_copies import WORD, brute_components, last

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing"]
    counts = []
    for _, stage in pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, folder).cache()
        counts.append(docs.count())
        assert docs.columns == COLUMNS
        assert not {r[0] for r in docs.select("doc_id").collect()} - {r[0] for r in before.select("doc_id").collect()}
    packed = pipeline.STAGES[-1][1](spark, docs, folder).collect()
    first = Counter(r["doc_id"] for r in packed if r["piece"] == 0)
    assert first == Counter(r["doc_id"] for r in docs.collect())
    assert counts[0] == 200 and counts[2] <= counts[1] < counts[0]


def test_stages_keep_awkward_rows_and_columns(spark, docs):
    for name, stage in pipeline.STAGES[1:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() > 0, name
    assert pipeline.STAGES[4][1](spark, docs, "").count() >= docs.count()


def test_stages_take_empty_tables(spark, docs, none):
    for name, stage in pipeline.STAGES[:4]:
        out = stage(spark, none, "")
        assert out.columns == none.columns and out.count() == 0, name
    assert pipeline.STAGES[4][1](spark, none, "").count() == 0


def test_rare_languages_are_learnt(spark):
    """Five rows of a language among thousands keep their documents."""
    common = [(i, " ".join(f"the{(i * k) % 97} and{k} of{(i + k) % 50}" for k in range(12)), "en") for i in range(5000)]
    rare = [(9000 + i, " ".join(f"zxq{k}vü jjk{(i + k) % 9}ö" for k in range(40)), "zz") for i in range(5)]
    docs = spark.createDataFrame(common + rare, "doc_id long, text string, lang string").withColumn("source", F.lit("s")).repartition(4)
    kept = {r["doc_id"] for r in pipeline.identify_languages(spark, docs, "").select("doc_id").collect()}
    assert {r[0] for r in rare} <= kept


def near(spark, docs):
    """The rows that stay of near copies, by brute force over rows in the order of ids."""
    order = sorted(docs, key=lambda r: last(r[0]))
    roots = brute_components(dict(enumerate(r[1] for r in order)))
    return Counter(r for k, r in enumerate(order) if roots[k][1] == k)


def test_stages_decide_by_row(spark, rows):
    """Rows without an id, or that repeat one, go and stay each by its own text."""
    clean = [(r[0], r[1], "s0", "xx", True, 5, "a", 1, 2) for r in rows if r[0] is not None and r[0] < 100]
    text = {r[0]: r[1].split() for r in clean}
    one, other = " ".join(text[60][::-1]), " ".join(text[95][::-1])
    bad = [(i, text, "s0", None, True, 5, "a", 1, 2) for i in (None, 3) for text in (None, "", "日本語 漢字 平仮名 片仮名 " * 9)]
    good = [(None, one, "s0", None, True, 5, "a", 1, 2), (None, other, "s1", None, True, 5, "a", 1, 2), (3, other + " " + text[60][0], "s1", None, True, 5, "a", 1, 2), (3, one.rsplit(" ", 1)[0], "s1", None, True, 5, "a", 1, 2)]
    docs = spark.createDataFrame(clean + bad + good, SCHEMA).repartition(3)
    found = Counter(map(tuple, pipeline.identify_languages(spark, docs, "").collect()))
    assert not set(found) & set(bad) and all(found[r] == 1 for r in good) and not found - Counter(clean + good)

    found = Counter(map(tuple, pipeline.remove_near_copies(spark, docs, "").collect()))
    want = near(spark, clean + bad + good)
    assert found == want and sum(want.values()) < len(clean + bad + good)

    taken = Counter(map(tuple, pipeline.mix(spark, docs, "").collect()))
    plan = Counter()
    for r in mix_sources(docs).collect():
        plan[r["doc_id"], r["source"], r["size"]] += r["copies"]
    by = Counter()
    for r, n in taken.items():
        by[r[0], r[2], len(WORD.findall(r[1] or ""))] += n
    assert by == plan


def test_mixing_keeps_targets_without_ids(spark):
    docs = spark.range(400).selectExpr("cast(null as long) as doc_id", "concat('w', id, repeat(' w', cast(id % 7 as int))) as text", "cast(id % 3 as string) as source").repartition(3)
    words = Counter()
    for r in pipeline.mix(spark, docs, "").collect():
        words[r["source"]] += len(r["text"].split())
    targets = {r["source"]: r["target"] for r in mix_sources(docs).select("source", "target").distinct().collect()}
    assert all(abs(words[s] - t) <= 7 for s, t in targets.items())


def test_entry_has_all_operators():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
