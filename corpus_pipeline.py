"""From raw documents to packed sequences, stage by stage.

Each stage works on all that the one before kept, and its decisions take effect. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncspark.llm.common import carried, written
from syncspark.llm.exact import drop_exact_copies
from syncspark.llm.jaccard import similar_documents
from syncspark.llm.langid import document_evidence, fit, identify
from syncspark.llm.mixing import repeat_documents
from syncspark.llm.packing import pack_documents
from syncspark.session import prepare


def _without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """Numbered rows but those whose numbers are in ``dropped``. These are written first, so
    that Spark knows their size: few go to all tasks and the texts stay where they are."""
    dropped = written(dropped.select("_row"), "dropped")
    return rows.select("_row", "row").join(dropped, "_row", "left_anti").select("row.*")


def _by_row(rows: DataFrame) -> DataFrame:
    """Numbered rows as documents whose id is the number."""
    return rows.select(F.col("_row").alias("doc_id"), "text", "source")


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose text is in none of the languages of the labels, or undecided.

    A null or empty text, however many rows have it, is undecided and goes. Texts are read
    whole. Rows that repeat an id, or have none, are judged each. No rows give no rows.
    """
    rows = carried(docs)
    found = identify(document_evidence(_by_row(rows)), fit(docs), ["doc_id"])
    return _without(rows, found.filter("not accepted").withColumnRenamed("doc_id", "_row"))


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest original of equal texts stays, then the smallest id, a missing one last. Null
    and empty texts are equal; of repeated rows one stays. No rows give no rows."""
    return drop_exact_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of documents that similarity links stays, a missing one last. Rows
    that repeat an id, or have none, are documents each. Null and empty texts are near nothing
    and stay. No rows give no rows."""
    rows = carried(docs)
    linked = similar_documents(_by_row(rows)).filter("component_id <> doc_id").select(F.col("component_id").alias("c"), F.col("doc_id").alias("_row"))
    linked = written(linked, "linked")
    members = linked.union(linked.select("c", F.col("c").alias("_row")).distinct()).join(rows.select("_row", "doc_id"), "_row")
    members = members.select("c", "_row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row").alias("at"))
    kept = members.groupBy("c").agg(F.min("at").alias("kept"))
    return _without(rows, members.join(kept, "c").filter(F.col("_row") != F.col("kept._row")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for, none at all included. A null
    source is a source; a null or empty text has no words and is taken as its source's whole
    part says. No rows give no rows."""
    return repeat_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences. A null or empty text is its end token alone;
    a very long one is cut into pieces. No rows give no rows."""
    return pack_documents(docs)


STAGES = [
    ("language ID", identify_languages),
    ("exact dedup", remove_exact_copies),
    ("n-gram Jaccard join", remove_near_copies),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

# Language models and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
