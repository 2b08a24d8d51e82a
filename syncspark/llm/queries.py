"""One query per operator over whole tables, with SQL where it can be said in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncspark.session import prepare

from . import oracle
from .auction import repair_conversations
from .common import new_path
from .decontaminate import contamination
from .exact import exact_dedup
from .jaccard import similar_documents
from .langid import document_evidence, fit, identify, page_evidence
from .mixing import mix_sources
from .neighbours import nearest
from .packing import pack_documents
from .prefixes import conversation_trie
from .repair import read_tokens, write_tokens
from .sharding import shard_documents
from .substrings import remove_repeats
from .toxicity import score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLE[run.__name__] = sql.strip()
        return run

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


@_query(r"""
with d as (select doc_id, length(coalesce(text, '')) as chars,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
g as (select *, row_number() over w as i, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size
      from d window w as (partition by text_sha256 order by chars desc, doc_id nulls last))
select doc_id, keep_id, group_size, i = 1 as kept, text_sha256 from g
""")
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(_table(spark, folder, "documents"))


@_query()
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mix = mix_sources(_table(spark, folder, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@_query()
def op3_pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_table(spark, folder, "documents"))


@_query()
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by text and source, web pages by text, markup, address and host."""
    docs, pages = _table(spark, folder, "documents"), _table(spark, folder, "pages")
    rows = document_evidence(docs).withColumn("page_id", F.lit(None).cast("long"))
    rows = rows.unionByName(page_evidence(pages).withColumn("doc_id", F.lit(None).cast("long")))
    return identify(rows, fit(docs), ["doc_id", "page_id"])


@_query()
def op5_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(_table(spark, folder, "documents"))


@_query()
def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    table = _table(spark, folder, "embeddings")
    return nearest(table, table.filter("vec_id % 100 = 0"))


@_query(oracle.REPEATS)
def op7_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(_table(spark, folder, "documents"))


@_query(oracle.SIMILAR)
def op8_similar_documents(spark: SparkSession, folder: str) -> DataFrame:
    return similar_documents(_table(spark, folder, "documents"))


@_query()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query()
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_tokens(_table(spark, folder, "documents"), path)
    return read_tokens(spark, path)


@_query(oracle.REPAIR)
def op11_repair_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return repair_conversations(_table(spark, folder, "conversations"))


@_query(oracle.TRIE)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(_table(spark, folder, "conversations"))


@_query(oracle.CONTAMINATION)
def op13_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
