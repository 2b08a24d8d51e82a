"""Selectors and rules on pages generated with known content."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from syncspark.errors import ConfigError
from syncspark.sources.html import HtmlField, compile_selector, html_extract, read_page, read_pieces, select, text_of


@pytest.fixture(scope="module")
def fields(spark):
    """Values of rules, by name, over pages."""

    def run(pages, **rules):
        df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
        return [r.detail.asDict() for r in html_extract(df, rules).orderBy("i").collect()]

    return run


def catalogue(rng, shelves):
    """A page of shelves with books, and what is on it."""
    books = [[(f"t{rng.randrange(10**6)}", rng.randrange(100)) for _ in range(rng.randrange(1, 5))] for _ in range(shelves)]
    rows = "".join(
        f'<section class="Shelf s{i}">' + "".join(f'<div data-price="{p}"><h2>{t}</h2><i>{p} EUR</i></div>\n' for t, p in shelf) + "</section>"
        for i, shelf in enumerate(books)
    )
    return f"<html><head><title>stock</title></head><body><main id='all'>{rows}</main><div>end</div></body></html>", books


def test_generated_catalogues(fields):
    rng = random.Random(5)
    made = [catalogue(rng, n) for n in (1, 2, 3, 6)]
    found = fields(
        [page for page, _ in made],
        titles=HtmlField("#all h2", True), prices=HtmlField("section.shelf > div[data-price]", value_attribute="data-price"),
        first=HtmlField("section:eq(0) div:eq(0) h2"), last_part=HtmlField("body > div", True), second_shelf=HtmlField(".s1 h2", True),
        labels=HtmlField("main i, title", True), none=HtmlField("main > h2", True),
    )
    for (_, books), row in zip(made, found, strict=True):
        every = [b for shelf in books for b in shelf]
        assert row["titles"] == " ".join(t for t, _ in every)
        assert row["prices"] == " ".join(str(p) for _, p in every)
        assert row["first"] == books[0][0][0] and row["last_part"] == "end" and row["none"] is None
        assert row["second_shelf"] == (" ".join(t for t, _ in books[1]) if len(books) > 1 else None)
        assert row["labels"] == " ".join(["stock", *(f"{p} EUR" for _, p in every)])


def test_one_element_gives_its_inside_and_several_give_themselves(fields):
    page = "<ol><li lang=x>a &lt; <em>b</em></li></ol><dl><dt>k</dt><dd>1</dd><dd>2</dd></dl>"
    assert fields([page], one=HtmlField("li"), two=HtmlField("dd"), page=HtmlField(), text=HtmlField(strip_html=True)) == [
        {"one": "a &lt; <em>b</em>", "two": "<dd>1</dd>\n<dd>2</dd>", "page": page, "text": "a < b k 1 2"}
    ]


@pytest.mark.parametrize("gap", [" ", "\n", "\t \r\n", "&nbsp;", "<!-- note -->", "<br>", "<script>if (a<b) {}</script>", "<style>q{}</style>"])
def test_gaps_in_text_are_one_space(fields, gap):
    assert fields([f"{gap}left{gap}<u>mid</u>{gap}right{gap}"], t=HtmlField(strip_html=True)) == [{"t": "left mid right"}]


def test_attributes(fields):
    page = '<img ALT=" a&amp;b " alt="second"><img alt><p alt="z">x</p><img src=q alt=c>'
    assert fields([page], img=HtmlField("img", value_attribute="Alt"), every=HtmlField("[alt]", value_attribute="alt"), no=HtmlField("p", value_attribute="src"), none=HtmlField("b", value_attribute="alt")) == [
        {"img": "a&b c", "every": "a&b z c", "no": None, "none": None}
    ]


def test_elements_without_end_tags(spark):
    page = "<table><tr><th>n<th>sq" + "".join(f"<tr><td>{n}<td>{n * n}" for n in range(4)) + "</table><p>one<p>two<div>three</div>four<ul><li>x<ul><li>y</ul><li>z</ul>"
    df = spark.createDataFrame([(page,)], "html string").withColumn("p", read_page(F.col("html")))

    def texts(selector):
        found = select(F.col("p"), compile_selector(selector))
        return df.select(F.transform(found, lambda n: text_of(F.col("p"), F.array(n)))).first()[0]

    assert texts("tr") == ["n sq", *(f"{n} {n * n}" for n in range(4))]
    assert texts("td:eq(1)") == [str(n * n) for n in range(4)] and texts("p") == ["one", "two"]
    assert texts("li") == ["x y", "y", "z"] and texts("ul li li") == ["y"] and texts("div") == ["three"]


def test_broken_pages_do_not_fail(fields):
    pages = ["", "<", "</p>", "<b><i>x</b>y</i>", "<a href=", "plain", "<p", "&bogus; &#0; &#x41;"]
    found = fields(pages, t=HtmlField(strip_html=True), b=HtmlField("b", True))
    assert [r["b"] for r in found] == [None, None, None, "x", None, None, None, None] and found[3]["t"] == "x y" and found[5]["t"] == "plain"


@pytest.mark.parametrize("selector", ["a:hover", "a ~ b", "a + b", "a::after", "[x^=y]", "!"])
def test_selectors_that_are_not_supported(selector):
    with pytest.raises(ConfigError):
        compile_selector(selector)


def test_only_html_has_a_detail(spark):
    kinds = ["text/html", "text/html;charset=latin1", "application/xhtml+xml", "image/png", None]
    df = spark.createDataFrame([(i, "<p>q</p>" if i else None, k) for i, k in enumerate(kinds)], "i int, html string, kind string")
    rows = html_extract(df, {"p": {"cssSelector": " p ", "stripHtml": "TRUE"}, "all": {"cssSelector": ""}}, content_type=F.col("kind")).orderBy("i").collect()
    assert [(r.status, r.detail and r.detail.p) for r in rows] == [(200, None), (200, "q"), (404, None), (404, None), (404, None)]
    assert [r.detail for r in html_extract(df).orderBy("i").collect()] == [None, *["<p>q</p>"] * 4]


def test_pages_are_read_in_pieces():
    """Elements of a batch are never held together, and every page is there in order."""
    page = catalogue(random.Random(7), 60)[0]

    def peak(n):
        batch = pa.array([page] * n + [None, ""])
        tracemalloc.start()
        try:
            assert sum(len(piece) for piece in read_pieces(iter([batch, batch.slice(0, 0), batch]))) == 2 * (n + 2)
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    assert peak(600) < 1.3 * peak(100)
    mixed = [f"<p>{i}</p>" + " " * 50_000 for i in range(20)] + [None, "", "<b>x"]
    pieces = list(read_pieces(iter([pa.array(mixed)])))
    assert len(pieces) > 2 and [p["texts"][:1] for piece in pieces for p in piece.to_pylist()] == [*([str(i)] for i in range(20)), [], [], ["x"]]


def test_large_pages_through_spark(spark):
    made = [f"<title>{i}</title>" + "<i>y</i>" * (5000 * (i % 3)) for i in range(60)]
    df = spark.createDataFrame([(i, h if i % 7 else None) for i, h in enumerate(made)], "i int, html string").coalesce(1)
    rows = html_extract(df, {"title": HtmlField("title", True), "n": HtmlField("i", True)}).select("i", "detail.title", F.length("detail.n").alias("n")).collect()
    assert sorted(map(tuple, rows)) == [(i, str(i), 10_000 * (i % 3) - 1 if i % 3 else None) if i % 7 else (i, None, None) for i in range(60)]
