"""Substring dedup by recompression.

Runs of one word and then, in rounds, pairs of neighbouring symbols are given names. A
name is a hash of its parts, so every task gives equal parts the same name without asking,
and whether two symbols pair depends on these two alone. Two equal windows of words hence
have the same symbols inside, whatever stands around them; only symbols at the rim differ.

Windows whose inner symbols occur in one document only cannot repeat. The others are
verified by all their words: each gets 96 bits of hashes of its words in order, and the
smallest document of each is found.

Documents are dealt into chunks and symbols into buckets. A chunk sends each bucket its
distinct symbols once, sorted and in a few bytes, and gets a bit for each back, so neither
a passage that all documents share nor a chunk of copies makes a bucket large.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import body, partitions, ready
from .words import gram_hashes, mix, powers, span_hashes, split_words, text_bytes

ROUNDS = 2
CHUNK_BYTES = 1 << 24
SPARE = 16  # names per possible window: how seldom two windows share inner symbols by chance
BATCH = 1 << 22
LAST = np.iinfo(np.int64).max  # stands for a null id: after all others
_BASE = 0xC2B2AE3D27D4EB4F


def inner_symbols(words: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` words, by its first word, a hash of the symbols that
    stand inside it whatever stands around it. ``doc`` is the document of each word."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # Runs of one word. Those that touch the rim of a window could go on outside.
    new = np.concatenate([[True], (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])])
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(words))).astype(np.uint64)
    names, of = mix(words[start] + length * np.uint64(0x9E3779B97F4A7C15)), doc[start]
    run = np.cumsum(new) - 1
    lo, hi = run[:n] + 1, run[width - 1 :].copy()
    out = gram_hashes(words, width, 3)  # where nothing is inside: the window itself
    inside = np.flatnonzero(lo < hi)
    lo, hi = lo[inside], hi[inside]
    for level in range(ROUNDS + 1):
        power, back = powers(_BASE, len(names) + 1), powers(pow(_BASE, -1, 1 << 64), len(names) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(names * power[:-1])])
        out[inside] = mix((total[hi] - total[lo]) * back[lo] + (hi - lo).astype(np.uint64) * np.uint64(64) + np.uint64(level))
        if level == ROUNDS:
            break
        # A symbol whose coin is a head pairs with a tail that follows it.
        head = (mix(names + np.uint64(level + 1)) & np.uint64(1)).astype(bool)
        second = np.concatenate([[False], head[:-1] & ~head[1:] & (of[1:] == of[:-1])])
        # At the rim, a tail could belong to a head outside and a head to a tail outside.
        lo, hi = lo + ~head[lo], hi - head[hi - 1]
        still = lo < hi
        inside, lo, hi = inside[still], lo[still], hi[still]
        symbol = np.cumsum(~second) - 1
        lo, hi = symbol[lo], symbol[hi - 1] + 1
        first = np.flatnonzero(~second)
        paired = np.append(second[1:], False)[first]
        after = names[np.minimum(first + 1, len(names) - 1)]
        names, of = np.where(paired, mix(names[first] * np.uint64(3) + mix(after) + np.uint64(level)), names[first]), of[first]
    return out


class Chunk:
    """The windows of some documents."""

    def __init__(self, texts: pa.Array, ids: pa.Array, width: int, bits: int):
        self.ids = np.where(ids.is_null().to_numpy(False), LAST, ids.fill_null(0).to_numpy(False)).astype(np.int64)
        self.texts, self.width = texts, width
        sizes = np.cumsum(np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1])) if len(texts) else np.zeros(0)
        self.parts, names, docs, one, two, at = [], [], [], [], [], 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH)))
            data, starts = text_bytes(texts.slice(at, to - at))
            begins, ends, before = split_words(data, starts)
            doc = np.repeat(np.arange(at, to), np.diff(before))
            words = span_hashes(data, begins, ends)
            whole = np.flatnonzero(doc[: max(0, len(doc) - width + 1)] == doc[width - 1 :])
            names.append(inner_symbols(words, doc, width)[whole] >> np.uint64(64 - bits))
            one.append(gram_hashes(words, width, 1)[whole])
            two.append((gram_hashes(words, width, 2)[whole] >> np.uint64(32)).astype(np.uint32))
            docs.append(doc[whole])
            self.parts.append((at, to, whole))
            at = to
        join = lambda x, kind: np.concatenate([np.zeros(0, kind), *x])
        self.names, self.doc, self.one, self.two = join(names, np.uint64), join(docs, np.int64), join(one, np.uint64), join(two, np.uint32)
        self.owner = self.ids[self.doc] if len(self.doc) else np.zeros(0, np.int64)

    def distinct_names(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct names, which one each window has, and whether several documents here have it."""
        order = np.argsort(self.names)
        sorted_ = self.names[order]
        new = np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) if len(order) else np.zeros(0, bool)
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        at, owners = np.flatnonzero(new), self.owner[order]
        several = np.minimum.reduceat(owners, at) != np.maximum.reduceat(owners, at) if len(at) else np.zeros(0, bool)
        return sorted_[new], which, several

    def choose(self, elsewhere: np.ndarray) -> None:
        """Keep the windows whose name several documents have; sort them by their words."""
        _, which, several = self.distinct_names()
        self.chosen = np.flatnonzero((elsewhere | several)[which])
        one, two, owner = self.one[self.chosen], self.two[self.chosen], self.owner[self.chosen]
        order = np.lexsort((owner, two, one))
        one, two, owner = one[order], two[order], owner[order]
        new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]) if len(order) else np.zeros(0, bool)
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.distinct = one[new], two[new], owner[new]  # with the smallest owner

    def remove(self, earlier: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
        """(document, words, words removed, what is left) given which groups have an owner
        before all of this chunk."""
        gone = np.zeros(len(self.names), bool)
        gone[self.chosen] = earlier[self.group] | (self.owner[self.chosen] > self.distinct[2][self.group])
        done = 0
        for at, to, whole in self.parts:
            data, starts = text_bytes(self.texts.slice(at, to - at))
            begins, ends, before = split_words(data, starts)
            first = whole[gone[done : done + len(whole)]]
            done += len(whole)
            step = np.bincount(first, minlength=len(begins) + 1) - np.bincount(first + self.width, minlength=len(begins) + 1)[: len(begins) + 1]
            kept = np.cumsum(step)[:-1] == 0
            count = np.concatenate([[0], np.cumsum(kept)])[before]
            # What is left: the kept words, each with the byte of space after it.
            stop = np.repeat(starts[1:], np.diff(before))  # of the word's document
            b, e = begins[kept], np.minimum(ends + 1, stop)[kept]
            edge = np.bincount(b, minlength=len(data) + 1) - np.bincount(e, minlength=len(data) + 1)
            keep = np.cumsum(edge)[:-1] > 0
            size = np.concatenate([[0], np.cumsum(keep)])[starts]
            plain = np.where((data == 32) | ((data >= 9) & (data <= 13)), np.uint8(32), data)[keep].tobytes()
            for i in range(to - at):
                n = int(before[i + 1] - before[i])
                yield at + i, n, n - int(count[i + 1] - count[i]), plain[size[i] : size[i + 1]].rstrip(b" ")


def _packed(values: np.ndarray) -> bytes:
    """Sorted numbers, one at least: the first, then the smallest differences that hold them."""
    gaps = np.diff(values)
    most = int(gaps.max()) if len(gaps) else 0
    width = 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return bytes([width]) + values[:1].astype("<u8").tobytes() + gaps.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, f"<u{data[0]}", offset=9).astype(np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", count=1, offset=1), gaps]))


def _table(**columns: list) -> pa.Table:
    kinds = {"chunk": pa.int64(), "bucket": pa.int64(), "n": pa.int64()}
    return pa.table({k: pa.array(v, kinds.get(k, pa.binary())) for k, v in columns.items()})


def _bits(answers: pa.Table, n: int) -> np.ndarray:
    """The bits of all buckets, in their order."""
    rows = sorted(answers.select(["bucket", "n", "bits"]).to_pylist(), key=lambda r: r["bucket"])
    found = np.concatenate([np.zeros(0, np.uint8), *[np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]) for r in rows]]).astype(bool)
    if len(found) != n:
        raise RuntimeError("a chunk has changed between two passes over it")
    return found


def remove_repeats(docs: DataFrame, width: int = 13, with_text: bool = False) -> DataFrame:
    """Remove the words covered by windows that start in a document with a smaller doc_id too.

    A window is ``width`` consecutive words (runs of anything but ASCII white space) of one
    document; windows are judged on the input. Returns a row per row of ``docs``: doc_id,
    n_words, n_removed, kept_sha256 (of the words left, joined by a space) and with
    ``with_text`` kept_text. A null text has no words. A null id is larger than any. Rows
    that repeat an id are one document's: neither loses a word to the other. Texts may have
    any length; no rows give no rows. Other columns aren't read.
    """
    spark = docs.sparkSession
    ready(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(partitions(spark), math.ceil(size / CHUNK_BYTES))
    bits = min(62, max(20, math.ceil(math.log2(SPARE * size / 4 + 1))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks))).repartition(chunks, "chunk")

    def opened(table: pa.Table) -> Chunk:
        return Chunk(pa.concat_arrays([c.cast(pa.large_string()) for c in table["text"].chunks] or [pa.array([], pa.large_string())]), table["doc_id"].combine_chunks(), width, bits)

    def edges(scale: int) -> np.ndarray:
        """Where buckets begin among numbers below 2**scale."""
        return np.array([(k << scale) // chunks for k in range(chunks)], np.uint64)

    def send_names(key: tuple, docs_: pa.Table) -> pa.Table:
        names, _, _ = opened(docs_).distinct_names()
        cut = [*np.searchsorted(names, edges(bits)).tolist(), len(names)]
        some = [k for k in range(chunks) if cut[k] < cut[k + 1]]
        return _table(chunk=[key[0].as_py()] * len(some), bucket=some, names=[_packed(names[cut[k] : cut[k + 1]]) for k in some])

    def seen_elsewhere(key: tuple, sent: pa.Table) -> pa.Table:
        lists = [_unpacked(x) for x in sent["names"].to_pylist()]
        every = np.sort(np.concatenate(lists))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        answers = []
        for x in lists:
            at = np.searchsorted(twice, x)
            at[at == len(twice)] = 0
            answers.append(np.packbits(twice[at] == x if len(twice) else np.zeros(len(x), bool)).tobytes())
        return _table(chunk=sent["chunk"].to_pylist(), bucket=sent["bucket"].to_pylist(), n=[len(x) for x in lists], bits=answers)

    def chosen(docs_: pa.Table, answers: pa.Table) -> Chunk:
        chunk = opened(docs_)
        chunk.choose(_bits(answers, len(chunk.distinct_names()[0])))
        return chunk

    def send_windows(key: tuple, docs_: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs_.num_rows:
            return _table(chunk=[], bucket=[], one=[], two=[], owner=[])
        one, two, owner = chosen(docs_, answers).distinct
        cut = [*np.searchsorted(one, edges(64)).tolist(), len(one)]
        some = [k for k in range(chunks) if cut[k] < cut[k + 1]]
        part = lambda x: [x[cut[k] : cut[k + 1]] for k in some]
        low = [int(o.min()) for o in part(owner)]
        narrow = [(o - m).astype("<u4") if o.max() - m < 1 << 32 and m >= 0 else o for o, m in zip(part(owner), low, strict=True)]
        return _table(
            chunk=[key[0].as_py()] * len(some), bucket=some, one=[x.astype("<u8").tobytes() for x in part(one)], two=[x.astype("<u4").tobytes() for x in part(two)],
            owner=[(np.array([m], "<i8").tobytes() + x.tobytes()) if x.dtype.itemsize == 4 else np.array([-1], "<i8").tobytes() + x.astype("<i8").tobytes() for x, m in zip(narrow, low, strict=True)],
        )

    def owned_before(key: tuple, sent: pa.Table) -> pa.Table:
        ones = [np.frombuffer(x, "<u8") for x in sent["one"].to_pylist()]
        owners = []
        for x, n in zip(sent["owner"].to_pylist(), map(len, ones), strict=True):
            base = int(np.frombuffer(x, "<i8", count=1)[0])
            owners.append(np.frombuffer(x, "<i8", offset=8) if len(x) == 8 + 8 * n else np.frombuffer(x, "<u4", offset=8).astype(np.int64) + base)
        one, two, owner = np.concatenate(ones), np.concatenate([np.frombuffer(x, "<u4") for x in sent["two"].to_pylist()]), np.concatenate(owners)
        order = np.lexsort((owner, two, one))
        new = np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])])
        first = owner[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        earlier = np.empty(len(order), bool)
        earlier[order] = first < owner[order]
        stops = np.cumsum([len(x) for x in ones])
        return _table(chunk=sent["chunk"].to_pylist(), bucket=sent["bucket"].to_pylist(), n=[len(x) for x in ones], bits=[np.packbits(x).tobytes() for x in np.split(earlier, stops[:-1])])

    def remove(key: tuple, docs_: pa.Table, both: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.string()] * with_text
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][: len(kinds)]
        if not docs_.num_rows:
            return pa.Table.from_arrays([pa.array([], k) for k in kinds], names=names)
        chunk = chosen(docs_, both.filter(pc.equal(both["step"], 1)))
        ids, found = docs_["doc_id"].to_pylist(), []
        for i, n, gone, left in chunk.remove(_bits(both.filter(pc.equal(both["step"], 2)), len(chunk.distinct[0]))):
            found.append((ids[i], n, gone, hashlib.sha256(left).hexdigest()) + ((left.decode(),) if with_text else ()))
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    answer = "chunk long, bucket long, n long, bits binary"
    whole = rows.groupBy("chunk")
    names = whole.applyInArrow(send_names, "chunk long, bucket long, names binary")
    repeated = names.groupBy("bucket").applyInArrow(seen_elsewhere, answer)
    windows = whole.cogroup(repeated.groupBy("chunk")).applyInArrow(send_windows, "chunk long, bucket long, one binary, two binary, owner binary")
    earlier = windows.groupBy("bucket").applyInArrow(owned_before, answer)
    both = repeated.withColumn("step", F.lit(1)).union(earlier.withColumn("step", F.lit(2)))
    kind = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return whole.cogroup(both.groupBy("chunk")).applyInArrow(remove, kind)
