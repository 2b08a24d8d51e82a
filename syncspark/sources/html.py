"""Fields out of HTML pages by selectors.

Python reads a page once, with the standard parser, into an array of elements and one of
text runs, as no built-in function reads HTML. Selectors and rules are expressions over
these arrays, so Spark plans and runs them like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from syncspark.errors import ConfigError
from syncspark.session import ship_package

NOT_FOUND = 404

# Fixed values of the HTML standard.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset(["script", "style"])
# Start tags that end an open element of the same group: tag -> (ended tags, barrier tags).
CLOSED_BY = {
    "li": (["li"], ["ul", "ol"]),
    "dt": (["dt", "dd"], ["dl"]),
    "dd": (["dt", "dd"], ["dl"]),
    "tr": (["tr", "td", "th"], ["table"]),
    "td": (["td", "th"], ["tr", "table"]),
    "th": (["td", "th"], ["tr", "table"]),
    "option": (["option"], ["select"]),
}
P_ENDING_TAGS = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)
P_BARRIERS = ["td", "th", "button", "object", "table", "html"]


# An element: names and values of its attributes, its place among its siblings, the
# elements around it (outermost first), offsets in the page, and its text runs.
NODE = (
    "struct<tag:string,names:array<string>,values:array<string>,position:int,around:array<int>,"
    "start:int,inner_start:int,inner_end:int,end:int,first_text:int,last_text:int>"
)
PAGE = f"struct<nodes:array<{NODE}>,texts:array<string>>"
_STRINGS, _INTS = pa.list_(pa.string()), pa.list_(pa.int32())
NODE_ARROW = pa.struct([
    ("tag", pa.string()), ("names", _STRINGS), ("values", _STRINGS), ("position", pa.int32()), ("around", _INTS),
    *((name, pa.int32()) for name in ("start", "inner_start", "inner_end", "end", "first_text", "last_text")),
])
PAGE_ARROW = pa.struct([("nodes", pa.list_(NODE_ARROW)), ("texts", _STRINGS)])
PIECE_CHARS = 1 << 18  # HTML that is held as elements at once, beside the last page


class PageParser(HTMLParser):
    """One pass over a page: elements in document order, text runs, offsets in the page."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.html = html
        self.nodes: list[dict] = []
        self.texts: list[str] = []
        self._glue = False
        self._lines = [0]
        self._lines += [m.end() for m in re.finditer("\n", html)]
        self._stack: list[int] = []  # open elements
        self._children = [0]  # how many each open element has, the page itself first
        self.feed(html)
        self.close()
        while self._stack:
            self._pop(len(html), len(html))

    def _offset(self) -> int:
        line, column = self.getpos()
        return self._lines[line - 1] + column

    def _tag(self, depth: int) -> str:
        return self.nodes[self._stack[depth]]["tag"]

    def _pop(self, inner_end: int, end: int) -> None:
        self._children.pop()
        self.nodes[self._stack.pop()].update(inner_end=inner_end, end=end, last_text=len(self.texts))

    def _close_implied(self, tag: str, at: int) -> None:
        groups = []
        if tag in CLOSED_BY:
            groups.append(CLOSED_BY[tag])
        if tag in P_ENDING_TAGS:
            groups.append((["p"], P_BARRIERS))
        for ended, barriers in groups:
            for depth in range(len(self._stack) - 1, -1, -1):
                open_tag = self._tag(depth)
                if open_tag in barriers:
                    break
                if open_tag in ended:
                    while len(self._stack) > depth:
                        self._pop(at, at)
                    if tag != "tr":
                        break

    def _open(self, tag: str, attrs: list, closed: bool) -> None:
        self._glue = False
        at = self._offset()
        self._close_implied(tag, at)
        inner = at + len(self.get_starttag_text() or "")
        pairs = {}
        for name, value in attrs:
            pairs.setdefault(name, value or "")
        self.nodes.append({
            "tag": tag, "names": list(pairs), "values": list(pairs.values()), "position": self._children[-1], "around": list(self._stack),
            "start": at, "inner_start": inner, "first_text": len(self.texts),
        })
        self._children[-1] += 1
        self._children.append(0)
        self._stack.append(len(self.nodes) - 1)
        if closed or tag in VOID_TAGS:
            self._pop(inner, inner)

    def handle_starttag(self, tag, attrs):
        self._open(tag, attrs, closed=False)

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs, closed=True)

    def handle_endtag(self, tag):
        self._glue = False
        for depth in range(len(self._stack) - 1, -1, -1):
            if self._tag(depth) == tag:
                at = self._offset()
                close = self.html.find(">", at)
                while len(self._stack) > depth + 1:
                    self._pop(at, at)
                self._pop(at, len(self.html) if close < 0 else close + 1)
                return

    def handle_data(self, data):
        if self._stack and self._tag(-1) in RAW_TAGS:
            return
        if self._glue:
            self.texts[-1] += data
        else:
            self.texts.append(data)
            self._glue = True

    def handle_comment(self, data):
        self._glue = False


_EDGES = "".join(chr(code) for code in range(0x21))


@dataclass
class Step:
    """A compound selector and how it relates to the one before it."""

    direct: bool = False
    tag: str | None = None
    ids: list[str] = field(default_factory=list)
    classes: list[str] = field(default_factory=list)
    attrs: list[tuple[str, str | None]] = field(default_factory=list)
    index: int | None = None

    def matches(self, node: Column) -> Column:
        parts = []
        if self.tag is not None:
            parts.append(node["tag"] == self.tag)
        if self.index is not None:
            parts.append(node["position"] == self.index)
        parts += [_attribute(node, "id").eqNullSafe(F.lit(i)) for i in self.ids]
        if self.classes:
            held = F.split(F.lower(F.coalesce(_attribute(node, "class"), F.lit(""))), r"\s+")
            parts += [F.array_contains(held, c.lower()) for c in self.classes]
        for name, value in self.attrs:
            found = _attribute(node, name)
            parts.append(found.isNotNull() if value is None else F.lower(F.btrim(found, F.lit(_EDGES))).eqNullSafe(F.lit(value.strip().lower())))
        return reduce(lambda x, y: x & y, parts, F.lit(True))


def _attribute(node: Column, name: str) -> Column:
    """Value of an attribute, null if the element doesn't have it."""
    return F.get(node["values"], (F.array_position(node["names"], name) - 1).cast("int"))


_PART = re.compile(
    r"""(?P<space>\s*>\s*|\s+)|(?P<tag>\*|[\w-]+)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)"""
    r"""|\[\s*(?P<attr>[\w:-]+)\s*(?:=\s*(?P<quote>["']?)(?P<value>.*?)(?P=quote)\s*)?\]|:eq\((?P<eq>\d+)\)"""
)


def compile_selector(text: str) -> list[list[Step]]:
    """Alternatives of descendant chains: ``tag``, ``.class``, ``#id``, ``[attr]``,
    ``[attr=value]``, ``:eq(n)`` (position among siblings), ``>`` and ``,``."""
    alternatives = []
    for chain in re.split(r",(?![^\[]*\])", text):
        steps, at, chain = [Step()], 0, chain.strip()
        while at < len(chain):
            match = _PART.match(chain, at)
            if match is None:
                raise ConfigError(f"unsupported selector: {text}")
            step, at = steps[-1], match.end()
            if match["space"] is not None:
                steps.append(Step(direct=">" in match["space"]))
            elif match["tag"]:
                step.tag = None if match["tag"] == "*" else match["tag"].lower()
            elif match["id"]:
                step.ids.append(match["id"])
            elif match["cls"]:
                step.classes.append(match["cls"])
            elif match["attr"]:
                step.attrs.append((match["attr"].lower(), match["value"]))
            else:
                step.index = int(match["eq"])
        alternatives.append(steps)
    return alternatives


def _matches(nodes: Column, node: Column, steps: list[Step]) -> Column:
    own = steps[-1].matches(node)
    if len(steps) == 1:
        return own
    outer = steps[:-1]
    if steps[-1].direct:
        around = F.element_at(F.concat(F.array(F.lit(-1)), node["around"]), -1)
        return own & (around >= 0) & F.coalesce(_matches(nodes, F.get(nodes, around), outer), F.lit(False))
    return own & F.exists(node["around"], lambda i: _matches(nodes, F.get(nodes, i), outer))


def select(page: Column, selector: list[list[Step]]) -> Column:
    """Elements of a page that a selector picks, in document order."""
    nodes = page["nodes"]
    return F.filter(nodes, lambda n: reduce(lambda x, y: x | y, [_matches(nodes, n, chain) for chain in selector]))


def clean_text(text: Column) -> Column:
    """Collapsed white space, non-breaking spaces as plain ones, trimmed."""
    return F.btrim(F.replace(F.regexp_replace(text, r"[ \t\n\f\r]+", " "), F.lit("\u00a0"), F.lit(" ")), F.lit(_EDGES))


def joined_text(texts: Column) -> Column:
    return F.array_join(F.filter(F.transform(texts, clean_text), lambda t: t != ""), " ")


def text_of(page: Column, nodes: Column) -> Column:
    """Text of elements."""
    runs = F.transform(nodes, lambda n: F.slice(page["texts"], n["first_text"] + 1, n["last_text"] - n["first_text"]))
    return joined_text(F.flatten(runs))


@dataclass(frozen=True)
class HtmlField:
    """One field of a mapping; without a selector the whole page is taken."""

    selector: str | None = None
    strip_html: bool = False
    value_attribute: str | None = None

    @classmethod
    def of(cls, entry) -> "HtmlField":
        if isinstance(entry, HtmlField):
            return entry
        blank_to_none = lambda v: v.strip() or None if isinstance(v, str) else None
        return cls(
            blank_to_none(entry.get("cssSelector")),
            str(entry.get("stripHtml", False)).lower() == "true",
            blank_to_none(entry.get("valueAttribute")),
        )


def field_value(page: Column, html: Column, rule: HtmlField) -> Column:
    """A field's value by its rule; null where nothing is found."""
    if rule.selector is None:
        return joined_text(page["texts"]) if rule.strip_html else html
    found = select(page, compile_selector(rule.selector))
    if rule.value_attribute:
        values = F.transform(found, lambda n: F.btrim(F.coalesce(_attribute(n, rule.value_attribute.lower()), F.lit("")), F.lit(_EDGES)))
        return F.nullif(F.array_join(F.filter(values, lambda v: v != ""), " "), F.lit(""))
    if rule.strip_html:
        value = text_of(page, found)
    else:
        def part(low: Column, high: Column) -> Column:
            return F.substring(html, low + 1, high - low)

        first = F.get(found, F.lit(0))
        outer = F.array_join(F.transform(found, lambda n: part(n["start"], n["end"])), "\n")
        value = F.when(F.size(found) == 1, part(first["inner_start"], first["inner_end"])).otherwise(outer)
    return F.when(F.size(found) > 0, value)


def read_pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Pages read, in pieces of bounded HTML: elements take many times the room of their HTML,
    and a batch has ten thousand pages of any size."""
    for batch in batches:
        held, chars = [], 0
        for html in batch:
            page = PageParser(html.as_py() or "")
            held.append({"nodes": page.nodes, "texts": page.texts})
            chars += len(page.html)
            if chars >= PIECE_CHARS:
                yield pa.array(held, PAGE_ARROW)
                held, chars = [], 0
        if held:
            yield pa.array(held, PAGE_ARROW)


def read_page(html: Column) -> Column:
    """Elements and text runs of a page."""
    ship_package(SparkSession.active())
    return F.arrow_udf(read_pieces, PAGE)(html)


def html_extract(
    pages: DataFrame, mapping: dict | None = None, html: str = "html", content_type: Column | None = None
) -> DataFrame:
    """Pages with ``detail`` and ``status``.

    A page that is not HTML is not found (404) and has no detail. Without a mapping
    the detail is the page's HTML, else a struct of the mapped fields, null in a page
    without HTML.
    """
    is_html = F.lit(True) if content_type is None else F.coalesce(F.contains(content_type, F.lit("text/html")), F.lit(False))
    body = F.when(is_html, F.col(html))
    status = F.when(is_html, F.lit(200)).otherwise(F.lit(NOT_FOUND))
    if mapping is None:
        return pages.withColumn("detail", body).withColumn("status", status)
    rules = {name: HtmlField.of(entry) for name, entry in mapping.items()}
    marked = pages.withColumn("_body", body)
    if any(rule.selector or rule.strip_html for rule in rules.values()):
        marked = marked.withColumn("_page", read_page(F.col("_body")))
    has = F.col("_body").isNotNull()
    fields = [F.when(has, field_value(F.col("_page"), F.col("_body"), rule)).alias(name) for name, rule in rules.items()]
    out = marked.withColumn("detail", F.when(is_html, F.struct(*fields))).withColumn("status", status)
    return out.drop("_body", "_page")
