import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from syncspark.errors import ConfigError, DataShapeError
from syncspark.functions import dates, paths, text, urls

V = F.col("v")


def moments(n, seed=1):
    """Random times with an offset from UTC, to the millisecond."""
    rng = random.Random(seed)
    for _ in range(n):
        offset = timezone(timedelta(minutes=rng.choice([-570, -300, 0, 60, 345, 840])))
        at = datetime(2000, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=rng.randrange(10**9), milliseconds=rng.choice([0, 7, 70, 999]))
        yield at.astimezone(offset)


def plain_iso(at):
    """The stored form: UTC, milliseconds without padding."""
    at = at.astimezone(timezone.utc)
    return at.strftime("%Y-%m-%dT%H:%M:%S") + f".{at.microsecond // 1000}+0000"


def test_iso_times_of_any_offset(values):
    times = list(moments(40))
    texts = [t.strftime("%Y-%m-%dT%H:%M:%S") + f".{t.microsecond // 1000:03d}" + (t.strftime("%z") if i % 2 else f"{t:%z}"[:3] + ":" + f"{t:%z}"[3:]) for i, t in enumerate(times)]
    assert values([*texts, "", None, "\t"], dates.format_iso(dates.parse_iso(V))) == [*map(plain_iso, times), None, None, None]
    minutes = [plain_iso(t.replace(second=0, microsecond=0)) for t in times]
    assert values(texts, dates.format_iso(dates.parse_iso_minute(V))) == minutes


@pytest.mark.parametrize("fmt, write, exact", [
    (dates.UNIX_EPOCH, lambda t: str(int(t.timestamp())), "second"),
    (dates.MILLISECOND_EPOCH, lambda t: str(round(t.timestamp() * 1000)), "millisecond"),
    (None, lambda t: str(round(t.timestamp() * 1000)), "millisecond"),
    ("YYYY-MM-dd", lambda t: t.astimezone(timezone.utc).strftime("%Y-%m-%d"), "day"),
])
def test_times_in_a_format_and_back(values, fmt, write, exact):
    times = [t.astimezone(timezone.utc) for t in moments(20, seed=2)]
    cut = {"second": {"microsecond": 0}, "millisecond": {}, "day": {"hour": 0, "minute": 0, "second": 0, "microsecond": 0}}[exact]
    given = [write(t) for t in times]
    assert values(given, dates.format_iso(dates.parse_datetime(V, fmt))) == [plain_iso(t.replace(**cut)) for t in times]
    if fmt is not None:
        padded = [t.strftime("%Y-%m-%dT%H:%M:%S") + f".{t.microsecond // 1000:03d}+0000" for t in times]
        assert values(padded, dates.format_datetime(dates.parse_iso(V), fmt)) == given


def test_unreadable_date_fails_when_strict(values):
    assert values(["nonsense"], dates.parse_datetime(V)) == [None]
    with pytest.raises(Exception, match="date not recognized"):
        values(["nonsense"], dates.parse_datetime(V, strict=True))


def test_sitemap_lastmod(values):
    """Dates, times to the minute or second (as written, without their offset), and dates of
    mail; the rest has no date."""
    cases = {}
    for t in moments(30, seed=3):
        t = t.replace(microsecond=0)
        if t.utcoffset() not in (timedelta(0), timedelta(hours=-5)):
            continue
        zone = f"{t:%z}"[:3] + ":" + f"{t:%z}"[3:]
        cases[t.strftime("%Y-%m-%d")] = plain_iso(t.replace(hour=0, minute=0, second=0, tzinfo=timezone.utc))
        cases[t.strftime("%Y-%m-%dT%H:%M:%S") + zone] = plain_iso(t.replace(tzinfo=timezone.utc))
        cases[t.strftime("%Y-%m-%dT%H:%M") + zone] = plain_iso(t.replace(second=0, tzinfo=timezone.utc))
        cases[t.strftime("%a, %d %b %Y %H:%M:%S %z")] = plain_iso(t)
    cases |= {"soon": None, "": None, None: None, "99": None}
    assert values(list(cases), dates.format_iso(dates.sitemap_lastmod(V))) == list(cases.values())


def test_csv(values):
    """Items are trimmed, empty ones left out; nothing left is null. Writing is the inverse."""
    rng = random.Random(4)
    lists = [[rng.choice(["", " ", "k", "long item", "7", "\u00fc"]) for _ in range(rng.randrange(6))] for _ in range(40)]
    texts = [",".join(" " * rng.randrange(3) + x + " " * rng.randrange(3) for x in items) for items in lists]
    kept = [[x.strip() for x in items if x.strip()] or None for items in lists]
    assert values([*texts, None], text.parse_csv(V)) == [*kept, None]
    back = [items for items in kept if items]
    assert values(values([",".join(i) for i in back], text.parse_csv(V)), text.create_csv(V), "array<string>") == [",".join(i) for i in back]
    assert values([None, [], ["q", None]], text.create_csv(V), "array<string>") == [None, "", "q,null"]


def test_trim_to_null(values):
    assert values([None, "", " \t\n\x01", " a b\n"], text.trim_to_null(V)) == [None, None, None, "a b"]
    assert values([None, " ", "a"], text.is_blank(V)) == [True, True, False]


def test_node_int(values):
    assert values([None, "10", "-3"], text.node_int(V)) == [None, 10, -3]
    assert values([10.9, None, -2.5], text.node_int(V, numeric=True), "double") == [10, None, -2]
    assert values(["x", "1.5", " 1"], text.node_int(V, strict=False)) == [None, None, None]
    with pytest.raises(Exception, match="not a whole number"):
        values(["x"], text.node_int(V))


def test_file_extension(values):
    """What follows the last dot of the last part, in lower case; nothing if that is empty."""
    folders, names = ["", "/", "d/", "http://h.test/", "/.hid/", "a.b/c.d/"], ["report", "Report", "x_1"]
    for ending in ("pdf", "TAR", "Gz"):
        given = [f"{f}{n}.{ending}" for f in folders for n in names] + [f"{f}{n}.old.{ending}" for f in folders for n in names]
        assert values(given, urls.file_extension(V)) == [ending.lower()] * len(given)
    given = [f"{f}{n}{dot}" for f in folders for n in names for dot in ("", ".")] + [" ", "", None]
    assert values(given, urls.file_extension(V)) == [None] * len(given)


def test_url_to_id(values):
    found = values(["ftp://h.test/p/q?r=1", "plain", "w&x*y<z>"], urls.url_to_id(V))
    assert found == ["ftp_h_test_p_q_r_1", "plain", "w_x_y_z_"]


def test_url_allowed(values):
    """A URL is allowed below its base, whatever the case of letters."""
    bases = ["https://shop.test", "https://shop.test/en/", "https://shop.test/en/a", "https://other.test/"]
    given = ["https://shop.test", "HTTPS://Shop.test/EN/", "https://shop.test/en/all?x=1", "https://SHOP.test/de/", "https://other.test/en/"]
    for base in bases:
        assert values(given, urls.url_allowed(F.lit(base), V)) == [u.lower().startswith(base.lower()) for u in given]


def test_urls(values):
    assert values(["http://Foo.org/abc/sitemap.xml"], urls.sitemap_base(V)) == ["http://foo.org/abc/"]
    given = ["http://a", "HTTPS://a b", "ftp://x", "file:/x", "what://a", "nothing", "", None, "http://a:x/", "http://a:80/"]
    assert values(given, urls.valid_url(V)) == [True, True, True, True, False, False, False, False, False, True]


def test_priority_and_change_freq(values):
    assert values(["0.8", "0", "1", "1.1", "-1", "x", "", None], urls.priority(V)) == [0.8, 0.0, 1.0, 0.5, 0.5, 0.5, 0.5, 0.5]
    assert values(["monthly", "Always or never", "hour", None], urls.change_freq(V)) == ["MONTHLY", "ALWAYS", None, None]


def test_struct_path(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1), 'l', array(named_struct('n', 'x'), named_struct('n', 'y'))) AS a")
    out = df.select(
        paths.struct_path(df.schema, "a.b.c").alias("found"),
        paths.struct_path(df.schema, "a.l.n").alias("many"),
        paths.struct_path(df.schema, "a.x.y").alias("missing"),
    ).first()
    assert (out.found, out.many, out.missing) == (1, ["x", "y"], None)


def test_document_id_needs_a_simple_value(spark):
    df = spark.sql("SELECT 5 AS n, 1.5D AS d, named_struct('x', 1) AS o, parse_json('{\"x\": 1}') AS v, parse_json('7') AS w")
    row = df.select(paths.document_id(df.schema, "n").alias("n"), paths.document_id(df.schema, "gone").alias("g"),
                    paths.document_id(df.schema, "w").alias("w")).first()
    assert (row.n, row.g, row.w) == ("5", None, "7")
    for path in ("d", "o"):
        with pytest.raises(ConfigError):
            paths.document_id(df.schema, path)
    with pytest.raises(Exception, match="simple value"):
        df.select(paths.document_id(df.schema, "v")).collect()


def test_required_document_id(values):
    checked = paths.require_document_id(V, F.lit("S"))
    assert values(["a"], checked) == ["a"]
    for bad in (None, "  "):
        with pytest.raises(Exception, match="document id not found"):
            values([bad], checked)


def test_document_deleted_compares_case(spark):
    df = spark.sql("SELECT * FROM VALUES ('true', 1, true), ('True', 2, false), (null, null, null) AS t(s, n, b)")
    flags = df.select(
        paths.document_deleted(df.schema, "s", "true").alias("s"),
        paths.document_deleted(df.schema, "n", "1").alias("n"),
        paths.document_deleted(df.schema, "b", "true").alias("b"),
        paths.document_deleted(df.schema, None, None).alias("none"),
    ).collect()
    assert [tuple(r) for r in flags] == [(True, True, True, False), (False, False, False, False), (False, False, False, False)]


def test_put_path(spark):
    df = spark.sql("SELECT named_struct('x', 1) AS a, 'text' AS s, cast(null AS struct<x int>) AS n")
    df2 = paths.put_path(paths.put_path(paths.put_path(df, "a.l1.l2", F.lit("v")), "new.deep", F.lit(2)), "n.y", F.lit(3))
    row = df2.first()
    assert (row.a.x, row.a.l1.l2, row.new.deep, row.n.y) == (1, "v", 2, 3)
    assert paths.put_path(df, "s", F.lit(None)).first().s is None
    for bad in ("s.x", " "):
        with pytest.raises(DataShapeError):
            paths.put_path(df, bad, F.lit(1))


def test_long_to_iso(spark):
    df = spark.sql("SELECT named_struct('t', 1344945600000L) AS m")
    assert dates.long_to_iso(df, "m.t").first().m.t == "2012-08-14T12:00:00.0+0000"
    assert dates.long_to_iso(df, "m.gone").first().m.t == 1344945600000
