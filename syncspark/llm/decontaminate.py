"""Benchmark decontamination: windows of test items looked up in all windows of documents.

Built-in functions only. The windows of the benchmark are a set of hashes that is sent to
every task once its size is known to be small; documents are scanned window by window, and
what a hash hits is verified by the words themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import body, numbered, written

WORDS = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
APART = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # the same before A-Z are put in lower case
LEAD, PIECE = rf"\A[{APART}]+", rf"[^{APART}]+[{APART}]*"
BROADCAST_BYTES = 32 << 20  # of windows; beyond it they are joined by a shuffle


def item_words(text: Column) -> Column:
    """Words of a text, A-Z in lower case: runs of digits, letters and whatever is not ASCII."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), lambda w: w != "")


def _starts(words: Column, length: int) -> Column:
    """Where windows of ``length`` words start, from 0."""
    return F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)).otherwise(F.array().cast("array<int>"))


def _hash(words: Column, start: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(words, start + k) for k in range(length)])


def _text(words: Column, start: Column, length: int) -> Column:
    return F.concat_ws(" ", *[F.get(words, start + k) for k in range(length)])


def _each(starts: Column, length: int, **made: Callable[[Column, Column, int], Column]) -> Column:
    """For each window of ``words``: where it starts and what is made of it."""
    return F.transform(starts, lambda i: F.struct(i.alias("start"), *[f(F.col("words"), i, length).alias(k) for k, f in made.items()]))


def windows(benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """Distinct windows of each item: item_id, length, hash, window. An item of fewer words, but
    not none, is one window; an item that is there twice counts once."""
    items = benchmark.select(F.col("item_id"), item_words(body()).alias("words")).filter("size(words) > 0")
    parts = [items.filter(F.size("words") >= words).select("item_id", "words", F.lit(words).alias("length"))]
    parts += [items.filter(F.size("words") == n).select("item_id", "words", F.lit(n).alias("length")) for n in range(1, words)]
    found = []
    for n, part in zip([words, *range(1, words)], parts, strict=True):
        each = _each(_starts(F.col("words"), n), n, hash=_hash, window=_text)
        found.append(part.select("item_id", "length", F.explode(each).alias("w")).select("item_id", "length", "w.hash", "w.window"))
    return reduce(DataFrame.unionByName, found).distinct()


def _scanned(docs: DataFrame, grams: DataFrame, few: bool) -> tuple[DataFrame, DataFrame]:
    """Of numbered documents (_row, words): the hits (_row, start, length, window), each verified
    by its words, and the stretches of words they cover (_row, start, stop), none touching another."""
    lengths = sorted(r[0] for r in grams.select("length").distinct().collect())
    keys, possible = grams.select("length", "hash").distinct(), []
    for n in lengths:
        each = _each(_starts(F.col("words"), n), n, hash=_hash)
        scanned = docs.select("_row", F.explode(each).alias("w")).select("_row", "w.start", "w.hash")
        known = keys.filter(F.col("length") == n).select("hash")
        possible.append(scanned.join(F.broadcast(known) if few else known, "hash", "left_semi").select("_row", F.lit(n).alias("length"), "start"))
    if not possible:
        nothing = docs.select("_row", F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("window")).limit(0)
        return nothing, nothing.select("_row", "start", F.col("length").alias("stop"))
    found = written(reduce(DataFrame.unionByName, possible).groupBy("_row", "length").agg(F.collect_list("start").alias("starts")), "possible")
    # The words of these windows only, from the documents that have any.
    text = F.lit(None)
    for n in lengths:
        text = F.when(F.col("length") == n, _each(F.col("starts"), n, window=_text)).otherwise(text)
    named = docs.join(found, "_row").select("_row", "length", F.explode(text).alias("w")).select("_row", "length", "w.start", "w.window")
    real = grams.select("length", "window").distinct()
    hits = written(named.join(F.broadcast(real) if few else real, ["length", "window"], "left_semi").select("_row", "start", "length", "window"), "hits")
    order = Window.partitionBy("_row").orderBy("start")
    spans = hits.groupBy("_row", "start").agg((F.col("start") + F.max("length")).alias("stop"))
    spans = spans.withColumn("before", F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("island", F.sum(F.when(F.col("start") <= F.col("before"), 0).otherwise(1)).over(order))
    return hits, spans.groupBy("_row", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")


def _prepared(docs: DataFrame, benchmark: DataFrame, words: int) -> tuple[DataFrame, DataFrame, bool]:
    """Numbered documents (_row, row, words), the windows, and whether these may be sent to all tasks."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = numbered(rows).select("_row", "doc_id", "row", item_words(F.col("text")).alias("words"))
    grams = written(windows(benchmark, words), "windows")
    size = grams.select("length", "window").distinct().agg(F.sum(F.octet_length("window") + 64)).first()[0] or 0
    return rows, grams, size <= BROADCAST_BYTES


def contamination(docs: DataFrame, benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """What each document holds of the items of a benchmark.

    ``docs``: doc_id, text; ``benchmark``: item_id, text. A window is ``words`` consecutive words
    of an item, or all of one that has fewer; a word inside any occurrence of a window is hit.
    Returns a row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated. A null or empty text has no words. Rows that repeat an id, or have none, are
    documents each; an item without an id counts as one whose id is empty, and rows of one
    item_id are one item. Texts may have any length, either table may be empty, and other
    columns don't matter.
    """
    rows, grams, few = _prepared(docs, benchmark, words)
    hits, spans = _scanned(rows.select("_row", "words"), grams, few)
    covered = spans.groupBy("_row").agg(F.sum(F.col("stop") - F.col("start")).cast("long").alias("n_hit"))
    named = grams.select("length", "window", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
    held = hits.select("_row", "length", "window").distinct().join(F.broadcast(named) if few else named, ["length", "window"])
    items = held.groupBy("_row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    counted = covered.join(items, "_row")
    out = rows.select("_row", "doc_id", F.size("words").cast("long").alias("n_words")).join(counted, "_row", "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", words: int = WORDS) -> DataFrame:
    """Documents without what they hold of a benchmark, in their own columns.

    ``remove``: ``spans`` cuts each hit word with the separators after it out of the text;
    ``documents`` drops documents with a hit. The rest is as in ``contamination``.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be 'spans' or 'documents', not {remove}")
    rows, grams, few = _prepared(docs, benchmark, words)
    _, spans = _scanned(rows.select("_row", "words"), grams, few)
    rows = rows.select("_row", "row")
    if remove == "documents":
        return rows.join(spans.select("_row").distinct(), "_row", "left_anti").select("row.*")
    cut = spans.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    # Every word with what separates it from the next; what stands before the first word stays.
    lead = F.regexp_extract(F.col("row.text"), LEAD, 0)
    pieces = F.regexp_extract_all(F.substr(F.col("row.text"), F.length(lead) + 1), F.lit(PIECE), F.lit(0))
    left = F.filter(pieces, lambda w, i: ~F.exists("spans", lambda s: (s["start"] <= i) & (i < s["stop"])))
    both = rows.join(cut, "_row", "left")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(F.concat(lead, F.array_join(left, "")))
    return both.select(F.col("row").withField("text", text).alias("row")).select("row.*")
