"""P1-P12: projection and reshaping. C1-C8: documents with comments."""

from __future__ import annotations

from pyspark.sql import functions as F

from syncspark.config import FieldMapping, SyncConfig
from syncspark.functions.paths import document_deleted, document_id, put_path
from syncspark.operators import comments as cm, mapping as mp, preprocess as pp
from syncspark.operators.changes import document_updated
from workload.base import query, table, text
from workload.documents import (
    ORDER_CONFIG, line_config, line_docs, open_docs, order_docs, thread_config, thread_docs,
)


@query("""
SELECT 'shop' AS source, o_orderpriority AS space_key, CAST(o_orderkey AS VARCHAR) AS document_id,
       CAST(o_custkey AS VARCHAR) AS customer, o_totalprice AS price, CAST(o_custkey AS VARCHAR) AS author_display,
       o_orderstatus AS author_name, TRUE AS missing_null
FROM orders
""")
def p1_map_fields(spark, d):
    out = mp.map_fields(order_docs(spark, d), ORDER_CONFIG)
    return out.select(
        "source", "space_key", "document_id", "customer", "price",
        F.col("author.displayName").alias("author_display"), F.col("author.name").alias("author_name"),
        F.col("missing").isNull().alias("missing_null"),
    )


def _customers(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("red"), F.col("c_mktsegment").alias("blue"), text("c_nationkey").alias("pink")).alias("obj"),
        F.create_map(F.lit("red"), F.col("c_name"), F.lit("blue"), F.col("c_mktsegment"), F.lit("pink"), text("c_nationkey")).alias("map"),
        F.array(
            F.struct(F.col("c_name").alias("name"), F.lit("a").alias("kind")),
            F.struct(F.col("c_mktsegment").alias("name"), F.lit("b").alias("kind")),
        ).alias("list"),
    )


@query("""
SELECT c_custkey AS id, c_mktsegment AS s7, c_name AS s8, c_mktsegment AS m7, c_name AS m8, 2 AS kept FROM customer
""")
def p2_value_filter_object(spark, d):
    renames = {"red": "blue", "blue": "red"}
    df = _customers(spark, d)
    out = df.select(
        "id",
        mp.value_filter(F.col("obj"), df.schema["obj"].dataType, renames).alias("s"),
        mp.value_filter(F.col("map"), df.schema["map"].dataType, renames).alias("m"),
    )
    return out.select(
        "id", F.col("s.red").alias("s7"), F.col("s.blue").alias("s8"), F.col("m.red").alias("m7"),
        F.col("m.blue").alias("m8"), F.size("m").alias("kept"),
    )


@query("SELECT c_custkey AS id, c_name || '|' || c_mktsegment AS names FROM customer")
def p3_value_filter_array(spark, d):
    df = _customers(spark, d)
    out = df.select("id", mp.value_filter(F.col("list"), df.schema["list"].dataType, {"name": "title"}).alias("list"))
    return out.select("id", F.array_join("list.title", "|").alias("names"))


@query("SELECT c_custkey AS id, c_name AS name FROM customer")
def p4_value_filter_scalar(spark, d):
    import warnings

    df = table(spark, d, "customer")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        same = mp.value_filter(F.col("c_name"), df.schema["c_name"].dataType, {"x": "y"}, "c_name")
    return df.select(F.col("c_custkey").alias("id"), same.alias("name"))


@query("""
SELECT c_custkey AS id, '{"key":' || c_custkey || CASE WHEN c_acctbal > 0 THEN ',"segment":"' || c_mktsegment || '"' ELSE '' END
       || ',"tags":[]}' AS body
FROM customer
""")
def p5_null_omission(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        mp.document_json(
            F.col("c_custkey").alias("key"),
            F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment"),
            F.lit(None).cast("string").alias("nothing"),
            F.array().cast("array<string>").alias("tags"),
        ).alias("body"),
    )


@query("SELECT c_custkey AS id, 'pink,red' AS kept, 3 AS unchanged FROM customer")
def p6_filter_keys(spark, d):
    df = _customers(spark, d)
    return df.select(
        "id",
        F.array_join(F.array_sort(F.map_keys(mp.filter_keys(F.col("map"), ["red", "pink", "other"]))), ",").alias("kept"),
        F.size(mp.filter_keys(F.col("map"), [])).alias("unchanged"),
    )


@query("""
SELECT c_custkey AS id, c_name AS kept, c_mktsegment AS replaced, c_acctbal AS created FROM customer
""")
def p7_put_path(spark, d):
    df = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.struct("c_name", F.lit("old").alias("seg")).alias("doc"), "c_mktsegment", "c_acctbal"
    )
    df = put_path(df, "doc.seg", F.col("c_mktsegment"))
    df = put_path(df, "doc.level1.level2", F.col("c_acctbal"))
    return df.select(
        "id", F.col("doc.c_name").alias("kept"), F.col("doc.seg").alias("replaced"), F.col("doc.level1.level2").alias("created")
    )


@query("SELECT c_custkey AS id, 'N' || c_nationkey AS space, 'N' || c_nationkey || ':' || c_custkey AS combined FROM customer")
def p8_add_space_key(spark, d):
    docs = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey")
    docs = mp.add_space_key(docs, F.concat(F.lit("N"), text("c_nationkey")))
    docs = pp.preprocess(docs, [lambda df: df.withColumn("combined", F.concat("spaceKey", F.lit(":"), text("id")))])
    return docs.select("id", F.col("spaceKey").alias("space"), "combined")


@query("""
SELECT c_custkey AS id, 'const' AS tag, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' ELSE 'other' END AS seg,
       'const|' || CASE c_mktsegment WHEN 'BUILDING' THEN 'B' ELSE 'other' END AS both_fields
FROM customer
""")
def p9_preprocess(spark, d):
    docs = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    out = pp.preprocess(docs, [
        pp.constant("meta.tag", "const"),
        None,
        pp.value_map("c_mktsegment", "meta.seg", {"BUILDING": "B"}, "other"),
        pp.combine("both", "meta.tag", "meta.seg"),
    ])
    return out.select("id", "meta.tag", "meta.seg", F.array_join("both", "|").alias("both_fields"))


@query("""
SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'unknown' END AS status,
       CASE o_orderstatus WHEN 'F' THEN 'finished' END AS partial
FROM orders
""")
def p10_value_map(spark, d):
    docs = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    out = pp.preprocess(docs, [
        pp.value_map("o_orderstatus", "status", {"F": "finished", "O": "open"}, "unknown"),
        pp.value_map("o_orderstatus", "partial", {"F": "finished"}),
    ])
    return out.select("id", "status", "partial")


@query("""
SELECT c_custkey AS id, n_name AS nation, r_name AS region
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
""")
def p11_lookup(spark, d):
    docs = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.struct("c_nationkey").alias("address"))
    nations, regions = table(spark, d, "nation"), table(spark, d, "region")
    out = pp.preprocess(docs, [
        pp.lookup("address.c_nationkey", nations, "n_nationkey", {"address.nation": "n_name", "address.region_key": "n_regionkey"}),
        pp.lookup("address.region_key", regions, "r_regionkey", {"address.region": "r_name"}),
    ])
    return out.select("id", F.col("address.nation").alias("nation"), F.col("address.region").alias("region"))


@query("""
SELECT p_partkey AS id, 7 AS fixed, CASE WHEN p_brand = p_type THEN p_brand ELSE p_brand || '|' || p_type END
       || '|' || p_size AS tags
FROM part
""")
def p12_constant_combine(spark, d):
    docs = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_brand", "p_type", "p_size")
    out = pp.preprocess(docs, [pp.constant("fixed", 7), pp.combine("tags", "p_brand", "p_type", "p_size", "p_brand", "absent")])
    return out.select("id", "fixed", F.array_join("tags", "|").alias("tags"))


OPEN_CONFIG = SyncConfig(
    source="shop", document_id="key", updated="fields.updated", deleted="fields.reporter.displayName", deleted_value="F",
    fields=ORDER_CONFIG.fields, value_filters=ORDER_CONFIG.value_filters,
)


@query("""
SELECT o_orderpriority AS space_key, CAST(o_orderkey AS VARCHAR) AS document_id, CAST(o_custkey AS VARCHAR) AS customer,
       o_totalprice AS price, CAST(o_custkey AS VARCHAR) AS author_display, o_orderstatus AS author_name, TRUE AS missing_null,
       CAST(o_orderdate AS DATE) AS updated, o_orderstatus = 'F' AS deleted
FROM orders
""")
def p1_open_documents(spark, d):
    """Orders whose schema is not known, in responses of about 500, mapped by paths into VARIANT."""
    docs = open_docs(order_docs(spark, d), OPEN_CONFIG, F.floor(F.col("key").cast("bigint") / 2500))
    out = docs.select(
        F.col("spaceKey").alias("space_key"),
        document_id(docs.schema, "key").alias("document_id"),
        document_updated(docs.schema, OPEN_CONFIG.updated).cast("date").alias("updated"),
        document_deleted(docs.schema, OPEN_CONFIG.deleted, OPEN_CONFIG.deleted_value).alias("deleted"),
        *mp.mapped_columns(docs.schema, OPEN_CONFIG.fields, OPEN_CONFIG.value_filters),
    )
    return out.select(
        "space_key", "document_id", "updated", "deleted", F.col("customer").cast("string").alias("customer"),
        F.col("price").cast("double").alias("price"), F.try_variant_get("author", "$.displayName", "string").alias("author_display"),
        F.try_variant_get("author", "$.name", "string").alias("author_name"), F.col("missing").isNull().alias("missing_null"),
    )


# --- comments -------------------------------------------------------------------


@query("SELECT 'texts' AS source, source AS space_key, CAST(doc_id AS VARCHAR) AS document_id, lang FROM documents")
def c1_mode_none(spark, d):
    return cm.map_documents(line_docs(spark, d), line_config("none"))


@query("""
SELECT CAST(conv_id AS VARCHAR) AS document_id, 'C' || (conv_id % 7) AS space_key, count(*) AS n,
       count(*) FILTER (role = 'user') AS by_user, CAST(sum(length(text)) AS BIGINT) AS chars,
       CAST(sum(turn * length(text)) AS BIGINT) AS weighted, TRUE AS in_order
FROM conversations GROUP BY conv_id
""")
def c2_mode_embedded(spark, d):
    cfg = thread_config("embedded")
    cfg.comment_fields["turn"] = FieldMapping("turn")
    out = cm.map_documents(thread_docs(spark, d), cfg)
    length = F.transform("all_comments", lambda c: F.struct(c["turn"].alias("t"), F.length(c["comment_body"]).alias("l")))
    turns = F.col("all_comments.turn")

    def total(value):
        return F.aggregate(length, F.lit(0).cast("bigint"), lambda acc, x: acc + value(x))

    return out.select(
        "document_id", "space_key", F.size("all_comments").cast("bigint").alias("n"),
        F.size(F.filter("all_comments", lambda c: c["comment_author"]["username"] == "user")).cast("bigint").alias("by_user"),
        total(lambda x: x["l"]).alias("chars"), total(lambda x: x["t"] * x["l"]).alias("weighted"),
        (turns == F.array_sort(turns)).alias("in_order"),
    )


@query("""
SELECT 'C' || (conv_id % 7) AS space_key, role AS author, count(*) AS n, count(DISTINCT conv_id) AS documents
FROM conversations GROUP BY ALL
""")
def c3_child_rows(spark, d):
    rows = cm.comment_rows(thread_docs(spark, d), thread_config("child"))
    return rows.groupBy("space_key", F.col("comment_author.username").alias("author")).agg(
        F.count("*").alias("n"), F.count_distinct("parent_id").alias("documents")
    )


@query("""
SELECT 'line' AS doc_type, doc_id || '/' || (i - 1) AS doc_id, CAST(NULL AS VARCHAR) AS parent_id, 'texts' AS source,
       source AS space_key, CAST(d.doc_id AS VARCHAR) AS document_id, line AS body, lang
FROM documents d, (SELECT doc_id AS k, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) l
WHERE d.doc_id = l.k
""")
def c4_standalone_rows(spark, d):
    return cm.comment_rows(line_docs(spark, d), line_config("standalone"))


@query("""
SELECT doc_type, doc_id, parent_id, body FROM (
  SELECT 'document' AS doc_type, CAST(conv_id AS VARCHAR) AS doc_id, CAST(NULL AS VARCHAR) AS parent_id,
         '{"source":"chat","space_key":"C' || (conv_id % 7) || '","document_id":"' || conv_id || '","thread":"' || conv_id || '"}' AS body
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT 'comment', conv_id || '-' || turn, CAST(conv_id AS VARCHAR),
         '{"source":"chat","space_key":"C' || (conv_id % 7) || '","document_id":"' || conv_id || '","comment_author":{"username":"' || role || '"}}'
  FROM conversations)
""")
def c5_comment_body(spark, d):
    cfg = thread_config("child")
    cfg.comment_fields = {"comment_author": cfg.comment_fields["comment_author"]}
    return cm.index_rows(thread_docs(spark, d), cfg).select("doc_type", "doc_id", "parent_id", "body")


@query("""
SELECT doc_id AS document, doc_id || '/' || (i - 1) AS id FROM
  (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
""")
def c6_required_comment_id(spark, d):
    docs = line_docs(spark, d)
    kind = docs.schema["comment"].dataType["items"].dataType.elementType
    exploded = docs.select(F.col("id").cast("bigint").alias("document"), F.explode("comment.items").alias("c"))
    return exploded.select("document", cm.comment_id(kind, "id", F.col("c")).alias("id"))


@query("""
SELECT l_orderkey AS id, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS positions, CAST(sum(l_partkey) AS BIGINT) AS parts,
       min(l_linenumber) AS first_line, max(l_linenumber) AS last_line, TRUE AS in_order
FROM lineitem GROUP BY l_orderkey
""")
def c7_collect_children(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_partkey")
    nested = cm.collect_children(lines, "id", "l_linenumber", ["l_partkey"], "lines")
    zero = F.lit(0).cast("bigint")
    return nested.select(
        "id", F.size("lines").cast("bigint").alias("n"),
        F.aggregate("lines.l_linenumber", zero, lambda acc, x: acc + x).alias("positions"),
        F.aggregate("lines.l_partkey", zero, lambda acc, x: acc + x).alias("parts"),
        F.array_min("lines.l_linenumber").alias("first_line"), F.array_max("lines.l_linenumber").alias("last_line"),
        (F.col("lines.l_linenumber") == F.array_sort("lines.l_linenumber")).alias("in_order"),
    )


@query("""
SELECT CAST(doc_id AS VARCHAR) AS parent_id, len(string_split(text, chr(10))) AS children,
       CASE WHEN doc_id = 7 THEN len(string_split(text, chr(10))) ELSE 0 END AS of_seven
FROM documents
""")
def c8_children_of(spark, d):
    rows = cm.index_rows(line_docs(spark, d), line_config("child")).select("doc_type", "parent_id")
    seven = F.col("parent_id") == "7"
    return cm.children_of(rows, "line").groupBy("parent_id").agg(
        F.count("*").alias("children"), F.count_if(seven).alias("of_seven")
    )


@query("""
SELECT CAST(conv_id AS VARCHAR) AS document_id, 'C' || (conv_id % 7) AS space_key, count(*) AS n,
       count(*) FILTER (role = 'user') AS by_user, count(*) FILTER (role = 'user') AS named_user, sum(length(text))::BIGINT AS chars
FROM conversations GROUP BY conv_id
""")
def c2_open_comments(spark, d):
    """Conversations without a schema, their turns embedded; a path through the list of turns gives all roles."""
    cfg = thread_config("embedded")
    cfg.fields["roles"] = FieldMapping("comments.author.name")
    docs = open_docs(thread_docs(spark, d), cfg, F.floor(F.col("id").cast("bigint") / 500))
    out = cm.map_documents(docs, cfg)
    username = lambda c: F.try_variant_get(c["comment_author"], "$.username", "string")
    return out.select(
        "document_id", "space_key", F.size("all_comments").cast("bigint").alias("n"),
        F.size(F.filter("all_comments", lambda c: username(c) == "user")).cast("bigint").alias("by_user"),
        F.size(F.filter(F.col("roles").cast("array<string>"), lambda role: role == "user")).cast("bigint").alias("named_user"),
        F.aggregate("all_comments", F.lit(0).cast("bigint"), lambda n, c: n + F.length(c["comment_body"].cast("string"))).alias("chars"),
    )


@query("""
SELECT 'document' AS doc_type, CAST(conv_id AS VARCHAR) AS doc_id, CAST(NULL AS VARCHAR) AS parent_id, CAST(NULL AS VARCHAR) AS author
FROM (SELECT DISTINCT conv_id FROM conversations)
UNION ALL
SELECT 'comment', conv_id || '-' || turn, CAST(conv_id AS VARCHAR), role FROM conversations
""")
def c3_open_child_rows(spark, d):
    """The same as child rows, their ids taken out of VARIANT."""
    cfg = thread_config("child")
    docs = open_docs(thread_docs(spark, d), cfg, F.floor(F.col("id").cast("bigint") / 500))
    author = F.get_json_object("body", "$.comment_author.username")
    return cm.index_rows(docs, cfg).select("doc_type", "doc_id", "parent_id", author.alias("author"))
