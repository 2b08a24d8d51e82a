"""Nested documents made of the flat tables, used by several groups of queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from syncspark.config import SyncConfig
from syncspark.operators.comments import collect_children
from syncspark.sources.payloads import extract_open_documents
from workload.base import table, text


def order_docs(spark, d) -> DataFrame:
    """Orders as documents with nested fields."""
    return table(spark, d, "orders").select(
        text("o_orderkey").alias("key"),
        F.col("o_orderpriority").alias("spaceKey"),
        F.struct(
            F.struct(text("o_custkey").alias("name"), F.col("o_orderstatus").alias("displayName")).alias("reporter"),
            F.col("o_totalprice").alias("price"),
            F.col("o_orderdate").alias("updated"),
        ).alias("fields"),
    )


ORDER_CONFIG = SyncConfig(
    source="shop",
    document_id="key",
    updated="fields.updated",
    fields={
        "customer": "fields.reporter.name",
        "price": "fields.price",
        "author": {"remote_field": "fields.reporter", "value_filter": "user"},
        "missing": "fields.nothing.here",
    },
    value_filters={"user": {"name": "displayName", "displayName": "name"}},
)


def thread_docs(spark, d) -> DataFrame:
    """Conversations as documents with their turns as comments."""
    turns = table(spark, d, "conversations").select(
        text("conv_id").alias("id"),
        F.col("turn"),
        F.concat(text("conv_id"), F.lit("-"), text("turn")).alias("comment_id"),
        F.struct(F.col("role").alias("name"), F.lit(True).alias("active")).alias("author"),
        F.col("text").alias("body"),
    )
    nested = collect_children(turns, "id", "turn", ["comment_id", "author", "body"])
    return nested.withColumn("spaceKey", F.concat(F.lit("C"), (F.col("id").cast("bigint") % 7).cast("string")))


def thread_config(mode: str) -> SyncConfig:
    return SyncConfig(
        source="chat",
        document_id="id",
        read_mode="simple",
        fields={"thread": "id"},
        comment_mode=mode,
        comments="comments",
        comment_id="comment_id",
        comment_type="comment",
        field_comments="all_comments",
        comment_fields={
            "comment_body": "body",
            "comment_author": {"remote_field": "author", "value_filter": "user"},
        },
        value_filters={"user": {"name": "username"}},
    )


def line_docs(spark, d) -> DataFrame:
    """Texts as documents with their lines as comments; the arrays grow in place."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.concat(text("doc_id"), F.lit("/"), i.cast("string")).alias("id"),
            line.alias("body"),
            F.struct(F.col("lang").alias("name")).alias("author"),
        ),
    )
    return table(spark, d, "documents").select(
        text("doc_id").alias("id"), F.col("source").alias("spaceKey"), "lang", F.struct(lines.alias("items")).alias("comment")
    )


def line_config(mode: str) -> SyncConfig:
    return SyncConfig(
        source="texts",
        document_id="id",
        read_mode="simple",
        fields={"lang": "lang"},
        comment_mode=mode,
        comments="comment.items",
        comment_id="id",
        comment_type="line",
        field_comments="lines",
        comment_fields={"body": "body", "lang": "author.name"},
    )


def open_docs(docs: DataFrame, cfg: SyncConfig, page: Column) -> DataFrame:
    """Typed documents sent as JSON responses of one ``page`` each, and read without a schema."""
    item = F.to_json(F.struct(*[F.col(c) for c in docs.columns if c != "spaceKey"]))
    pages = docs.groupBy("spaceKey", page.alias("page_no")).agg(F.array_join(F.collect_list(item), ",").alias("items"))
    payloads = pages.select("spaceKey", "page_no", F.concat(F.lit('{"data":{"items":['), "items", F.lit("]}}")).alias("payload"))
    return extract_open_documents(payloads, cfg.first_names(), "data.items", ["spaceKey", "page_no"])
