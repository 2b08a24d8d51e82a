"""Toxicity by averaged subword embeddings and a linear softmax.

A word's vector is the mean of the vectors of its character n-grams, so a misspelt word
shares most of its vector with the right one. A stretch of a few words is the mean of its
words, and a linear softmax says how likely it is toxic. A document is toxic if any
stretch is: its probability is that not all of its stretches are clean. Vectors and
softmax are trained together, in numpy, on the document labels alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import body, ready
from .words import mix, split_words, text_bytes, word_codes

GRAMS = (3, 4, 5)
BUCKETS = 1 << 18
DIM = 4
STRETCH = 8
SAMPLE = 5000  # labelled documents that the model is trained on, at most
LEAST = 4  # documents of the sample that a bucket must occur in
EPOCHS = 60
RATE, DECAY = 0.4, 1e-7
SURPRISE = 3.0  # standard deviations above chance
BATCH = 1 << 22


def subwords(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, all in one array, and how many each has."""
    sizes = np.diff(np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1])
    raw = np.frombuffer(words.buffers()[2], np.uint8)
    lo = int(np.frombuffer(words.buffers()[1], np.int64)[words.offset])
    # With a mark before and after each word.
    ends = np.cumsum(sizes + 2)
    marked = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    inner = np.ones(len(marked), bool)
    inner[ends - 1] = inner[ends - sizes - 2] = False
    marked[inner] = raw[lo : lo + int(sizes.sum())]
    marked[ends - sizes - 2], marked[ends - 1] = 1, 2
    word = np.repeat(np.arange(len(sizes)), sizes + 2)
    found, of = [], []
    for n in GRAMS:
        m = max(0, len(marked) - n + 1)
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + marked[k : k + m]
        same = word[:m] == word[n - 1 :] if m else np.zeros(0, bool)
        found.append((mix(h[same]) % np.uint64(BUCKETS)).astype(np.int32))
        of.append(word[:m][same].astype(np.int32))
    of_all = np.concatenate(of)
    order = np.argsort(of_all, kind="stable")
    return np.concatenate(found)[order], np.bincount(of_all, minlength=len(sizes))


def _plain(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in lower case, the marks that end words and sentences as spaces."""
    data, starts = text_bytes(pc.utf8_lower(texts))
    return np.where(np.isin(data, list(b".,;:|")), np.uint8(32), data), starts


def _stretches(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of so many words: first word and length of each stretch, and its document."""
    n = -(-counts // STRETCH)
    doc = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(np.cumsum(counts) - counts, n) + k * STRETCH
    return first, np.minimum(STRETCH, counts[doc] - k * STRETCH), doc


@dataclass
class Model:
    """What scoring needs: the softmax's say on each bucket, and its bias."""

    weight: np.ndarray
    bias: float
    always: float | None = None  # the score of all texts, where there was nothing to learn

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.always is not None:
            return np.full(len(texts), self.always)
        data, starts = _plain(texts)
        begins, ends, before = split_words(data, starts)
        out = np.full(len(texts), -np.logaddexp(0, self.bias))
        if len(begins):
            words, code = word_codes(data, begins, ends)
            buckets, n = subwords(words)
            total = np.concatenate([[0.0], np.cumsum(self.weight[buckets], dtype=np.float64)])
            stop = np.cumsum(n)
            z = ((total[stop] - total[stop - n]) / np.maximum(n, 1))[code]
            first, length, doc = _stretches(np.diff(before))
            logit = np.add.reduceat(z, first) / length + self.bias
            clean = np.bincount(doc, weights=-np.logaddexp(0, logit), minlength=len(texts))
            out = np.where(np.diff(before) > 0, clean, out)
        return np.clip(-np.expm1(out), 0.0, 1.0)


def train(texts: list[str], toxic: np.ndarray, seed: int = 5) -> Model:
    """Fit vectors and softmax to whole documents and their labels (0 or 1)."""
    if not len(texts) or toxic.min() == toxic.max():  # nothing to tell apart
        return Model(np.zeros(BUCKETS), 0.0, float(toxic.mean()) if len(texts) else 0.0)
    data, starts = _plain(pa.array(texts, pa.large_string()))
    begins, ends, before = split_words(data, starts)
    words, code = word_codes(data, begins, ends)
    buckets, n = subwords(words)
    count = np.diff(before)
    first, length, doc = _stretches(count)
    # Buckets that toxic documents don't have more often than chance are left at zero: most
    # of them would only say which document they come from.
    stop, rate = np.cumsum(n), toxic.mean()
    docs_of, toxic_of = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for i in range(len(texts)):
        mine = np.unique(code[before[i] : before[i + 1]])
        size = n[mine]
        at = np.repeat(stop[mine] - np.cumsum(size), size) + np.arange(size.sum())
        has = np.unique(buckets[at])
        docs_of[has] += 1
        toxic_of[has] += toxic[i]
    live = (docs_of >= LEAST) & (toxic_of - rate * docs_of >= SURPRISE * np.sqrt(rate * (1 - rate) * np.maximum(docs_of, 1)))
    number = np.cumsum(live) - 1
    held = np.flatnonzero(live[buckets])
    owner = np.searchsorted(stop, held, side="right")
    buckets = number[buckets[held]]
    share = 1.0 / np.maximum(n, 1)[owner]
    rng = np.random.default_rng(seed)
    vectors, softmax, bias = rng.normal(0, 0.1, (int(live.sum()), DIM)), rng.normal(0, 0.5, (DIM, 2)), np.array([3.0, -3.0])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, softmax, bias)]
    positive = toxic.astype(bool)
    per_word = 1.0 / length
    stretch_of = np.repeat(np.arange(len(first)), length)
    for epoch in range(1, EPOCHS + 1):
        of_word = np.stack([np.bincount(owner, weights=vectors[buckets, d] * share, minlength=len(n)) for d in range(DIM)], axis=1)
        side = softmax[:, 1] - softmax[:, 0]
        logit = np.add.reduceat((of_word @ side)[code], first) / length + bias[1] - bias[0]
        p = 1 / (1 + np.exp(-logit))
        clean = np.bincount(doc, weights=-np.logaddexp(0, logit), minlength=len(texts))
        all_clean = np.exp(np.minimum(clean, -1e-9))
        pull = np.where(positive, -all_clean / (1 - all_clean), 1.0)  # of a document's loss on its stretches
        g = pull[doc] * p / len(texts)
        on_word = np.bincount(code, weights=(g * per_word)[stretch_of], minlength=len(n))
        g_side = on_word @ of_word
        pushed = on_word[owner] * share
        g_vectors = np.bincount(buckets, weights=pushed, minlength=len(vectors))[:, None] * side[None, :] + DECAY * vectors
        grads = (g_vectors, np.stack([-g_side, g_side], axis=1), np.array([-g.sum(), g.sum()]))
        for p_, g_, (m, v) in zip((vectors, softmax, bias), grads, state, strict=True):  # Adam
            m += 0.1 * (g_ - m)
            v += 0.01 * (g_ * g_ - v)
            p_ -= RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-9)
    weight = np.zeros(BUCKETS)
    weight[live] = vectors @ (softmax[:, 1] - softmax[:, 0])
    return Model(weight, float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on labelled documents that aren't held out: at most ``sample``, by a hash of the id."""
    usable = labels.filter("doc_id is not null and toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    usable = usable.filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1).dropDuplicates(["doc_id"])
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded, so it may be sent to all
    rows = docs.select("doc_id", body().alias("text")).join(F.broadcast(chosen), "doc_id")

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "toxic": []}), *frames], ignore_index=True).sort_values(["doc_id", "text"])
        model = train(found["text"].tolist(), found["toxic"].to_numpy(np.int64))
        yield pd.DataFrame({"weight": [model.weight.astype("<f8").tobytes()], "bias": [model.bias], "always": [model.always]}, dtype="object")

    # A bounded sample, so one task may hold it.
    got = rows.repartition(1).mapInPandas(learn, "weight binary, bias double, always double").first()
    if got is None:
        return train([], np.zeros(0))
    return Model(np.frombuffer(got["weight"], "<f8"), got["bias"], got["always"])


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """A row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted.

    The whole text decides, nothing else. A null or empty text gets the score of a clean
    stretch. Rows with crc32 of the id modulo 3 equal to 1 are held out of training; a null
    id isn't held out. Without labels of both kinds all scores are the share
    of toxic labels, 0 without any.
    """
    ready(docs.sparkSession)
    model = fit(docs, labels, sample)
    sent = docs.sparkSession.sparkContext.broadcast(Model(model.weight.astype(np.float32), model.bias, model.always))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            sizes, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH)))
                p = sent.value.score(texts.slice(at, to - at))
                names = ids.slice(at, to - at)
                held = [i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in names.to_pylist()]
                yield pa.RecordBatch.from_arrays([names, pa.array(held), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
                at = to

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", body().alias("text")).mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
