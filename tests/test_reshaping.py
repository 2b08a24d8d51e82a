import json

import pytest
from pyspark.sql import functions as F

from syncspark.config import SyncConfig
from syncspark.functions.paths import path_type, put_path, simple_string, struct_path
from syncspark.operators import comments as cm, mapping as mp, preprocess as pp
from syncspark.sources.payloads import extract_open_documents

DOCS = [
    {
        "key": "T-1", "spaceKey": "AB", "fields": {
            "created": "2012-09-05T13:00:10.000-0400",
            "owner": {"name": "ann", "mail": "ann@x.org", "title": "Ann A"},
            "helper": None,
            "parts": [{"id": "7", "name": "core"}, {"id": "8", "name": "web"}],
            "versions": [],
            "talk": {"entries": [
                {"id": "c1", "body": "first", "by": {"name": "bob", "mail": "b@x.org", "title": "Bob"}},
                {"id": "c2", "body": "second", "by": {"name": "cy", "mail": "c@x.org", "title": "Cy"}},
            ]},
        },
    },
    {"key": "T-2", "spaceKey": "AB", "fields": {"created": None, "talk": {"entries": []}}},
    {"key": "T-3", "spaceKey": "AB", "fields": {"talk": None}},
]
PERSON = "struct<name:string,mail:string,title:string>"
SCHEMA = (
    f"key string, spaceKey string, fields struct<created:string, owner:{PERSON}, helper:{PERSON}, "
    f"parts:array<struct<id:string,name:string>>, versions:array<string>, "
    f"talk:struct<entries:array<struct<id:string,body:string,by:{PERSON}>>>>"
)


def config(mode="none", **changes):
    settings = dict(
        source="src", document_id="key", read_mode="simple",
        fields={
            "created": "fields.created",
            "owner": {"remote_field": "fields.owner", "value_filter": "user"},
            "helper": {"remote_field": "fields.helper", "value_filter": "user"},
            "parts": {"remote_field": "fields.parts", "value_filter": "named"},
            "versions": "fields.versions",
            "nothing": "fields.no.such",
        },
        value_filters={"user": {"name": "username", "title": "display"}, "named": {"name": "name"}},
        comment_mode=mode, comments="fields.talk.entries", comment_id="id", comment_type="comment",
        field_comments="all_comments",
        comment_fields={"body": "body", "author": {"remote_field": "by", "value_filter": "user"}},
    )
    return SyncConfig(**{**settings, **changes})


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([json.dumps(d) for d in DOCS], "string").select(
        F.from_json("value", SCHEMA).alias("d")
    ).select("d.*")


def bodies(rows):
    return {(r.doc_type, r.doc_id): json.loads(r.body) for r in rows.collect()}


OWN = {
    "source": "src", "space_key": "AB", "document_id": "T-1", "created": "2012-09-05T13:00:10.000-0400",
    "owner": {"username": "ann", "display": "Ann A"}, "parts": [{"name": "core"}, {"name": "web"}], "versions": [],
}


def test_no_comments(docs):
    rows = bodies(cm.index_rows(docs, config()))
    assert set(rows) == {("document", "T-1"), ("document", "T-2"), ("document", "T-3")}
    assert rows["document", "T-1"] == OWN
    assert rows["document", "T-3"] == {"source": "src", "space_key": "AB", "document_id": "T-3"}


def test_embedded(docs):
    rows = bodies(cm.index_rows(docs, config("embedded")))
    assert len(rows) == 3
    assert rows["document", "T-1"] == {**OWN, "all_comments": [
        {"body": "first", "author": {"username": "bob", "display": "Bob"}},
        {"body": "second", "author": {"username": "cy", "display": "Cy"}},
    ]}
    assert "all_comments" not in rows["document", "T-2"] and "all_comments" not in rows["document", "T-3"]
    assert cm.map_documents(docs, config("embedded")).filter("all_comments IS NULL").count() == 2


@pytest.mark.parametrize("mode, parent", [("child", "T-1"), ("standalone", None)])
def test_separate_rows(docs, mode, parent):
    cfg = config(mode)
    rows = cm.index_rows(docs, cfg)
    found = bodies(rows)
    assert set(found) == {("document", "T-1"), ("document", "T-2"), ("document", "T-3"), ("comment", "c1"), ("comment", "c2")}
    assert found["comment", "c1"] == {
        "source": "src", "space_key": "AB", "document_id": "T-1", "body": "first", "author": {"username": "bob", "display": "Bob"},
    }
    assert {r.parent_id for r in rows.filter("doc_type = 'comment'").collect()} == {parent}
    assert cm.children_of(rows, "comment", "T-1").count() == (2 if parent else 0)
    flat = cm.comment_rows(docs, cfg)
    assert {(r.doc_id, r.document_id, r.author.username) for r in flat.collect()} == {("c1", "T-1", "bob"), ("c2", "T-1", "cy")}


def test_missing_comment_id_fails(docs):
    with pytest.raises(Exception, match="comment id not found"):
        cm.index_rows(docs, config("child", comment_id="nope")).collect()


def test_renamed_standard_columns(docs):
    cfg = config(field_source="origin", field_space_key="room", field_document_id="nr")
    assert mp.map_fields(docs, cfg).columns[:3] == ["origin", "room", "nr"]


def test_remap_swaps_and_chains(spark):
    names = list("abcdefgh")
    # a and b swap, c takes the place of d, d becomes new, e stays, the rest is dropped.
    renames = {"a": "b", "b": "a", "c": "d", "d": "new", "e": "e"}
    expected = {"b": "was a", "a": "was b", "d": "was c", "new": "was d", "e": "was e"}
    df = spark.range(1).select(
        F.struct(*[F.lit(f"was {n}").alias(n) for n in names]).alias("s"),
        F.create_map(*[F.lit(x) for n in names for x in (n, f"was {n}")]).alias("m"),
    )
    row = df.select(
        mp.value_filter(F.col("s"), df.schema["s"].dataType, renames).alias("s"),
        mp.value_filter(F.col("m"), df.schema["m"].dataType, renames).alias("m"),
        mp.value_filter(F.col("m"), df.schema["m"].dataType, {}).alias("same"),
        mp.filter_keys(F.col("m"), ["b", "c"]).alias("kept"),
        mp.filter_keys(F.col("m"), []).alias("all"),
    ).first()
    assert row.s.asDict() == expected and row.m == expected
    assert len(row.same) == len(row["all"]) == 8 and set(row.kept) == {"b", "c"}


def test_filter_on_scalar_warns(spark):
    df = spark.sql("SELECT 'x' AS v, array('a', 'b') AS l")
    with pytest.warns(UserWarning):
        kept = mp.value_filter(F.col("v"), df.schema["v"].dataType, {"a": "b"}, "v")
    with pytest.warns(UserWarning):
        listed = mp.value_filter(F.col("l"), df.schema["l"].dataType, {"a": "b"}, "l")
    assert df.select(kept.alias("v"), listed.alias("l")).first() == ("x", ["a", "b"])


def test_preprocess_chain(spark):
    docs = mp.add_space_key(spark.sql("SELECT named_struct('status', 'Open', 'code', 'x') AS f"), F.lit("AB"))
    table = spark.sql("SELECT 'x' AS code, 'Label X' AS label")
    out = pp.preprocess(docs, [
        pp.value_map("f.status", "f.phase", {"Open": "new", "Closed": "done"}, "other"),
        None,
        pp.constant("f.kind", "doc"),
        pp.lookup("f.code", table, "code", {"f.label": "label"}),
        pp.combine("tags", "f.phase", "f.kind", "spaceKey", "f.phase", "f.gone"),
    ]).first()
    assert (out.f.phase, out.f.kind, out.f.label, out.tags) == ("new", "doc", "Label X", ["new", "doc", "AB"])
    missing = pp.preprocess(docs, [pp.value_map("f.none", "v", {"a": "b"}, "dflt"), pp.lookup("f.status", table, "code", {"label": "label"})])
    assert missing.select("v", "label").first() == ("dflt", None)


def test_huge_parent_keeps_all_children(spark):
    """A parent with 10 050 children, half of them exact copies of one position, in every mode."""
    rows = spark.range(10_100, numPartitions=6).select(
        F.when(F.col("id") < 10_050, "hot").otherwise(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("id"),
        F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("n"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("cid"),
    )
    out = cm.collect_children(rows, "id", "n", ["cid"])
    assert out.count() == 51
    back = out.select("id", F.explode("comments").alias("c")).select("id", "c.n", "c.cid")
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    docs = out.withColumn("spaceKey", F.lit("S"))
    for mode, n in (("embedded", 51), ("child", 51 + 10_100), ("standalone", 51 + 10_100)):
        cfg = SyncConfig(
            source="s", document_id="id", read_mode="simple", fields={"k": "id"}, comment_mode=mode, comments="comments",
            comment_id="cid", comment_type="comment", field_comments="all", comment_fields={"n": "n"},
        )
        stored = cm.index_rows(docs, cfg)
        assert stored.select("doc_type", "doc_id").distinct().count() == stored.count() == n
        if mode == "embedded":
            body = stored.filter("doc_id = 'hot'").select(F.get_json_object("body", "$.all").alias("a"))
            assert body.select(F.json_array_length("a")).first()[0] == 10_050


def test_map_keys_that_get_one_name(spark):
    """The last listed key that is there gives the value, as for objects."""
    df = spark.createDataFrame([({"a": 1, "b": 2, "c": 3},), ({"a": 1},), ({},), (None,)], "m map<string,int>")
    from syncspark.operators.mapping import remap_map

    found = [r[0] for r in df.select(remap_map(F.col("m"), {"a": "x", "b": "x", "c": "a"})).collect()]
    assert found == [{"x": 2, "a": 3}, {"x": 1}, {}, None]


@pytest.fixture
def open_docs(spark):
    """The same documents without a schema, as one response."""
    payload = json.dumps({"data": {"items": DOCS}})
    pages = spark.createDataFrame([("AB", 0, payload)], "spaceKey string, page_no int, payload string")
    return extract_open_documents(pages, config("child").first_names(), "data.items", ["spaceKey", "page_no"])


@pytest.mark.parametrize("mode", ["none", "embedded", "child", "standalone"])
def test_documents_without_schema_are_mapped_alike(docs, open_docs, mode):
    assert {f.dataType.simpleString() for f in open_docs.schema if f.name in ("key", "fields")} == {"variant"}
    cfg = config(mode)
    assert bodies(cm.index_rows(open_docs, cfg)) == bodies(cm.index_rows(docs, cfg))
    found, typed = (cm.index_rows(d, cfg).select("doc_id", "parent_id", "document_id").collect() for d in (open_docs, docs))
    assert sorted(found, key=str) == sorted(typed, key=str)


def test_paths_into_variant(spark):
    doc = {
        "list": [{"a": {"b": 1}}, {"a": [{"b": 2}, {"c": 3}]}, {"x": 1}, 5], "n": None, "we[i]rd": {"it's?": "y"},
        "s": "text", "o": {"d": 1.5, "k": 7}, "deep": [[{"a": 1}]],
    }
    df = spark.createDataFrame([(json.dumps(doc),), (None,)], "t string").select(F.parse_json("t").alias("v"))
    df = df.select("v", F.struct(F.array("v", "v").alias("vs")).alias("s"))

    def at(path):
        return df.select(F.to_json(struct_path(df.schema, path))).first()[0]

    assert at("v.list.a.b") == "[1,[2,null],null,null]"
    assert at("v.we[i]rd.it's?") == '"y"' and at("v.s.none") is None and at("v.o.k") == "7"
    assert at("v.deep.a") == "[null]"
    assert at("s.vs.o.k") == "[7,7]" and path_type(df.schema, "s.vs.o.k").simpleString() == "array<variant>"
    ids = df.select(simple_string(df.schema, "v.o.k").alias("k"), simple_string(df.schema, "v.n").alias("n")).collect()
    assert [tuple(r) for r in ids] == [("7", None), (None, None)]
    for path in ("v.o", "v.o.d", "v.list"):
        with pytest.raises(Exception, match="must provide a simple value"):
            df.select(simple_string(df.schema, path)).collect()


def test_put_into_variant(spark):
    df = spark.sql("SELECT parse_json(t) AS v FROM VALUES ('{\"a\":{\"b\":1},\"c\":2}'), ('{\"a\":null}'), (NULL) AS x(t)")
    out = put_path(put_path(df, "v.a.new", F.array(F.lit("x"))), "v.c", F.lit(3))
    assert [json.loads(r[0]) for r in out.select(F.to_json("v")).collect()] == [
        {"a": {"b": 1, "new": ["x"]}, "c": 3}, {"a": {"new": ["x"]}, "c": 3}, {"a": {"new": ["x"]}, "c": 3},
    ]
    with pytest.raises(Exception, match="not an object"):
        put_path(df, "v.c.d", F.lit(1)).collect()
    labels = spark.sql("SELECT 2 AS code, 'two' AS label")
    named = pp.preprocess(df, [pp.lookup("v.c", labels, "code", {"v.label": "label"})])
    assert {r[0] for r in named.select(F.expr("try_variant_get(v, '$.label', 'string')")).collect()} == {"two", None}


def test_comments_of_another_kind_fail(spark):
    pages = spark.createDataFrame([("AB", '[{"key": "1", "fields": {"talk": {"entries": "none"}}}]')], "spaceKey string, payload string")
    found = extract_open_documents(pages, config("child").first_names(), None, ["spaceKey"])
    with pytest.raises(Exception, match="must be an array of objects"):
        cm.index_rows(found, config("child")).collect()
    for wrong in ("{}", "no json", None):
        page = spark.createDataFrame([("AB", wrong)], "spaceKey string, payload string")
        with pytest.raises(Exception, match="no array of documents"):
            extract_open_documents(page, ["key"], None, ["spaceKey"]).collect()
