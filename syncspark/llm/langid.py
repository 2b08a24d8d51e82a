"""Language ID by Bayesian evidence fusion.

Four kinds of evidence multiply: the likelihood of the text under a character n-gram model
of each language; what the markup declares; a language code in the address; and the prior
of the host, smoothed towards its domain and that towards all hosts. How far a declaration
or an address can be trusted, and the priors, are sums over all rows of what the text
alone says, by grouped aggregation. Texts that fit no language go to ``other``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import body, ready, written
from .toxicity import BATCH, BUCKETS, subwords
from .words import split_words, text_bytes, word_codes

SAMPLE = 1000  # labelled rows of a language
OTHER = "other"
OTHER_PRIOR = 0.01
UNSEEN = 0.05  # count of an n-gram that a language's sample doesn't have
STRENGTH = 20.0  # rows that the wider group counts for in a host's or domain's prior
MARKUP = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&[a-z]+;"


@dataclass
class Likelihoods:
    """Log-likelihood of each n-gram bucket by language, the last of them ``other``."""

    languages: list[str]
    table: np.ndarray

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood by text and language, and words of each text. A word counts as much
        as the mean of its n-grams, as these aren't independent."""
        data, starts = text_bytes(pc.utf8_lower(texts))
        begins, ends, before = split_words(data, starts)
        out = np.zeros((len(texts), len(self.languages)))
        counts = np.diff(before)
        if len(begins):
            words, code = word_codes(data, begins, ends)
            buckets, n = subwords(words)
            stop, full = np.cumsum(n), np.flatnonzero(counts)
            for k in range(len(self.languages)):
                total = np.concatenate([[0.0], np.cumsum(self.table[k][buckets], dtype=np.float64)])
                z = ((total[stop] - total[stop - n]) / np.maximum(n, 1))[code]
                out[full, k] = np.add.reduceat(z, before[:-1][full])
        return out, counts


def train(texts: list[str], langs: list[str]) -> Likelihoods:
    """N-gram models of the languages of labelled whole texts."""
    languages = sorted(set(langs))
    counts = np.zeros((len(languages) + 1, BUCKETS))
    for k, name in enumerate(languages):
        data, starts = text_bytes(pc.utf8_lower(pa.array([t for t, x in zip(texts, langs, strict=True) if x == name], pa.large_string())))
        begins, ends, _ = split_words(data, starts)
        if len(begins):
            words, code = word_codes(data, begins, ends)
            buckets, n = subwords(words)
            counts[k] = np.bincount(buckets, weights=np.repeat(np.bincount(code, minlength=len(n)), n), minlength=BUCKETS)
    table = np.log(counts + UNSEEN) - np.log(counts.sum(1, keepdims=True) + UNSEEN * BUCKETS)
    table[-1] = -np.log(max(2, int((counts.sum(0) > 0).sum())))  # other: any n-gram that any language has
    return Likelihoods([*languages, OTHER], table.astype(np.float32))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Likelihoods:
    """Models from rows (doc_id, text, lang): of each language at most ``sample``, by a hash of id
    and text, so that a language is learnt however rare it is among all rows."""
    usable = docs.filter("lang is not null and lang <> ''").select("doc_id", "lang", body().alias("text"))
    order = [F.xxhash64("doc_id", "text"), F.col("doc_id")]
    marked = usable.select("doc_id", "lang", order[0].alias("mark"))
    chosen = marked.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("mark", "doc_id"))).filter(F.col("n") <= sample)
    chosen = chosen.select("doc_id", "lang", "mark").distinct()
    both = usable.withColumn("mark", order[0]).join(F.broadcast(chosen), ["doc_id", "lang", "mark"], "left_semi")
    rows = both.select("doc_id", "lang", "text").toPandas().sort_values(["doc_id", "lang", "text"])
    return train(rows["text"].tolist(), rows["lang"].tolist())


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))


def address_code(url: Column) -> Column:
    """The language code that an address carries as first folder or as top-level domain, or null."""
    code = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([a-zA-Z]{2})(?:[-_][a-zA-Z]{2})?(?:[/?#]|$)", 1))
    top = F.regexp_extract(host_of(url), r"\.([a-z]{2})$", 1)
    return F.nullif(F.when(code != "", code).otherwise(top), F.lit(""))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Rows (page_id, text, declared, address, host) of web pages (page_id, url, html)."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    declared = F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-zA-Z]{2,3})""", 1))
    return pages.select(
        "page_id", F.regexp_replace(html, MARKUP, " ").alias("text"), F.nullif(declared, F.lit("")).alias("declared"),
        address_code(url).alias("address"), F.nullif(host_of(url), F.lit("")).alias("host"),
    )


def _reliability(rows: DataFrame, column: str, n: int) -> DataFrame:
    """(column, <column>_says): log-probability of each value under each language."""
    per = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(*[F.sum(F.col("p")[k]).alias(f"s{k}") for k in range(n)])
    values = per.agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"s{k}").alias(f"t{k}") for k in range(n)])
    says = F.array(*[F.log((F.col(f"s{k}") + 0.5) / (F.col(f"t{k}") + 0.5 * F.col("v"))) for k in range(n)])
    return per.crossJoin(F.broadcast(values)).select(column, says.alias(f"{column}_says"))  # one row of sums


def identify(rows: DataFrame, model: Likelihoods, keys: list[str], accept: float = 0.7) -> DataFrame:
    """Language of each row of (keys, text, declared, address, host), the last three nullable.

    Returns keys, language, confidence, accepted, n_words. A row is accepted if its most
    likely language isn't ``other`` and has a probability of ``accept`` or more. Without any
    word a row isn't accepted, whatever else says. Null evidence says nothing. Repeated rows
    get each its own result. No rows give no rows.
    """
    spark = rows.sparkSession
    ready(spark)
    sent, n = spark.sparkContext.broadcast(model), len(model.languages)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column("text"), 0
            others = [c for c in batch.schema.names if c != "text"]
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH)))
                likely, counts = sent.value.score(texts.slice(at, to - at))
                likely -= likely.max(axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, to - at) for c in others] + [pa.array(counts, pa.int64()), pa.array(likely.tolist(), pa.list_(pa.float64()))],
                    names=[*others, "n_words", "likely"],
                )
                at = to

    evidence = rows.select(*keys, "declared", "address", "host", body().alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in evidence.schema if f.name != "text")
    scored = evidence.mapInArrow(score, f"{kinds}, n_words long, likely array<double>")
    flat = np.log([(1 - OTHER_PRIOR) / max(1, n - 1)] * (n - 1) + [OTHER_PRIOR])
    flat = F.array(*[F.lit(float(x)) for x in flat])
    scored = written(scored.withColumn("p", _normal(_add("likely", flat))), "scored")

    told = scored.filter("n_words > 0")
    sums = [F.sum(F.col("p")[k]).alias(f"s{k}") for k in range(n)]
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    domain = F.when(domain != "", domain).otherwise(F.col("host"))
    hosts = told.filter("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("n"), *sums).withColumn("domain", domain)
    domains = hosts.groupBy("domain").agg(F.sum("n").alias("dn"), *[F.sum(f"s{k}").alias(f"d{k}") for k in range(n)])
    whole = told.agg(F.count(F.lit(1)).alias("an"), *[F.sum(F.col("p")[k]).alias(f"a{k}") for k in range(n)])
    general = [(F.coalesce(f"a{k}", F.lit(0.0)) + 1) / (F.col("an") + n) for k in range(n)]
    of_domain = [(F.col(f"d{k}") + STRENGTH * general[k]) / (F.col("dn") + STRENGTH) for k in range(n)]
    of_host = [(F.col(f"s{k}") + STRENGTH * of_domain[k]) / (F.col("n") + STRENGTH) for k in range(n)]
    priors = hosts.join(domains, "domain").crossJoin(F.broadcast(whole)).select("host", F.array(*[F.log(x) for x in of_host]).alias("host_says"))
    priors = written(priors, "priors")  # its size known, it is sent to all tasks where it is small
    out = scored.crossJoin(F.broadcast(whole.select(F.array(*[F.log(x) for x in general]).alias("general"))))  # one row
    out = out.join(priors, "host", "left")
    for column in ("declared", "address"):  # codes of two or three letters
        out = out.join(F.broadcast(_reliability(told, column, n)), column, "left")
    nothing = F.array(*[F.lit(0.0)] * n)
    total = _add("likely", F.coalesce("host_says", "general"))
    for column in ("declared_says", "address_says"):
        total = _add(total, F.coalesce(column, nothing))
    out = out.withColumn("p", _normal(total)).withColumn("confidence", F.array_max("p"))
    names = F.array(*map(F.lit, model.languages))
    out = out.withColumn("language", F.element_at(names, F.array_position("p", F.col("confidence")).cast("int")))
    return out.select(*keys, "language", "confidence", ((F.col("language") != OTHER) & (F.col("confidence") >= accept) & (F.col("n_words") > 0)).alias("accepted"), "n_words")


def _add(a: Column | str, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _normal(logs: Column) -> Column:
    """Probabilities from logarithms."""
    top = F.array_max(logs)
    parts = F.transform(F.transform(logs, lambda x: x - top), lambda x: F.exp(x))
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return F.transform(parts, lambda x: x / total)


def document_evidence(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, declared, address, host) of documents: their source is their host."""
    nothing = F.lit(None).cast("string")
    return docs.select("doc_id", "text", nothing.alias("declared"), nothing.alias("address"), F.col("source").alias("host"))
