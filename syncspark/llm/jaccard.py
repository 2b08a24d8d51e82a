"""Jaccard join on word shingles with count-vector R-trees.

The shingles of a document are hashed into groups, and the counts of the groups are a
point. Two documents share at most as many shingles as the sum of the smaller count of
each group; in an R-tree over the points, the sum of the smaller upper bounds of two boxes
limits the overlap of all pairs between them, and pairs of boxes below what the similarity
asks for are left out. What survives is verified with the whole sets.

One tree over all documents would prune little, as in so many dimensions every box meets
every other. So the tree branches first by exact cells: size class, then group, then what
the group holds. Two similar sets of n shingles differ in n/4 at most, each in one group:
of the first n/4 + 1 groups that hold something, one holds the same in both. Every similar
pair is therefore in a cell together, and boxes are built inside cells.

A pair of points that boxes let through is bound once more by a finer point of several
coordinates a shingle, each 0 or 1: what both have, and the shingles that share a coordinate
with another of their set.

Most pairs of a cell never need to be formed: each document is first verified with the
smallest of its cell, and only documents that are not yet in one component are joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import body, partitions, ready, written
from .components import components
from .substrings import _bits, _packed, _table, _unpacked
from .words import gram_hashes, mix, span_hashes, split_words, text_bytes

STEP = 1.25  # similar sets differ in size by this factor at most
SMALL = 48  # below it a group holds one shingle
CHUNK_BYTES = 1 << 23
SPARE = 4096  # names per key: how seldom different keys share one
BITS = 24  # of a key's name, at least
LEAF = 32
FEW = 8  # documents of a cell that are paired without boxes
BLOCK = 4096  # documents of a cell that one task takes at once
BATCH = 1 << 22
FINE = 6  # coordinates of a fine point for each shingle
FINE_MOST = 1 << 14
WORDS_AT_ONCE = 1 << 21  # of fine points that are compared
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, all in one array, and where each text's start."""
    data, starts = text_bytes(texts)
    data = _LOWER[data]
    begins, ends, before = split_words(data, starts)
    names, count = span_hashes(data, begins, ends), np.diff(before)
    doc = np.repeat(np.arange(len(count)), count)
    grams = gram_hashes(names, words)
    whole = np.flatnonzero(doc[: len(grams)] == doc[words - 1 :]) if len(grams) else np.zeros(0, np.int64)
    hashes, owner = grams[whole], doc[whole]
    for i in np.flatnonzero((count > 0) & (count < words)):  # the whole sequence is one shingle
        few = names[before[i] : before[i + 1]]
        hashes, owner = np.append(hashes, gram_hashes(few, len(few), 2 + len(few))), np.append(owner, i)
    order = np.argsort(hashes)
    order = order[np.argsort(owner[order].astype(np.uint16 if len(count) < 1 << 16 else np.int64), kind="stable")]
    hashes, owner = hashes[order], owner[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]) if len(order) else np.zeros(0, bool)
    return hashes[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(count)))])


def _size_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / math.log(STEP) + 1e-9).astype(np.int64)


def _groups(level: np.ndarray) -> np.ndarray:
    """Groups of a size class: enough that more than a quarter as many as shingles hold something."""
    most = STEP ** (level + 1.0)
    return np.ceil(most / np.where(most > 300, 3.0, 2.2)).astype(np.uint64)


def _segments(hashes: np.ndarray, starts: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the first groups that hold something, and their set, for sets at a size class
    each (-1: every shingle is a group). A group is a range of hashes, so sets come in order."""
    n = np.diff(starts)
    owner = np.repeat(np.arange(len(n)), n)
    groups = np.where(level < 0, np.uint64(0), _groups(level))[owner]
    group = np.where(groups == 0, hashes, ((hashes >> np.uint64(32)) * groups) >> np.uint64(32))
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (owner[1:] != owner[:-1])]) if len(group) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held = np.add.reduceat(mix(hashes), at)
    of = owner[at]
    first = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(n)))])
    rank = np.arange(len(at)) - first[of]
    keep = rank <= n[of] // 4
    tag = mix(group[at] + (level[of] + 2).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return mix(held + tag)[keep], of[keep]


def _variants(n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sets, their class): every set at its class and the next, small ones by single shingles."""
    level = _size_class(n)
    small, large = np.flatnonzero((n > 0) & (n < SMALL * STEP)), np.flatnonzero(n >= SMALL)
    return [(small, np.full(len(small), -1)), (large, level[large]), (large, level[large] + 1)]


def _counts(hashes: np.ndarray, level: int) -> np.ndarray:
    """The point of a set at a size class."""
    size = 8 if level < 0 else max(8, math.ceil(STEP ** (level + 1) / 6))
    return np.minimum(np.bincount(((hashes & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64), minlength=size), 255).astype(np.uint8)


def _fine(hashes: np.ndarray, level: int) -> bytes:
    """The fine point of a set at a size class, a bit a coordinate."""
    most = SMALL * STEP if level < 0 else STEP ** (level + 1)
    size = min(FINE_MOST, 64 * math.ceil(FINE * most / 64))
    held = np.zeros(size, bool)
    held[((hashes & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)] = True
    return np.packbits(held).tobytes()


def box_pairs(points: np.ndarray, fine: np.ndarray, sizes: np.ndarray, labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (left, right) of different labels that the bounds let through, from an R-tree of
    packed leaves: each left leaf with the right leaves whose boxes may overlap enough, then
    point by point with the fine points (rows of 64-bit words)."""

    def leaves(at: np.ndarray) -> list[np.ndarray]:
        order = at[np.lexsort((*points[at].T[:4], sizes[at]))]
        return [order[i : i + LEAF] for i in range(0, len(order), LEAF)]

    def boxes(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.stack([points[p].max(axis=0) for p in parts]).astype(np.int32), np.array([sizes[p].min() for p in parts]), np.array([sizes[p].max() for p in parts])

    if not len(left) or not len(right):
        return
    a, b = leaves(left), leaves(right)
    (top_a, low_a, high_a), (top_b, low_b, high_b) = boxes(a), boxes(b)
    spare = sizes - np.bitwise_count(fine).sum(axis=1, dtype=np.int64)
    step = max(1, WORDS_AT_ONCE // (LEAF * max(1, fine.shape[1])))
    for i, leaf in enumerate(a):
        bound = np.minimum(top_a[i], top_b).sum(axis=1)
        near = (9 * bound >= 4 * (low_a[i] + low_b)) & (5 * high_a[i] >= 4 * low_b) & (5 * high_b >= 4 * low_a[i])
        others = np.concatenate([b[j] for j in np.flatnonzero(near)] or [np.zeros(0, np.int64)])
        for k in range(0, len(others), step):
            other = others[k : k + step]
            bound = np.bitwise_count(fine[leaf][:, None, :] & fine[other][None, :, :]).sum(axis=2, dtype=np.int64)
            bound += np.minimum(spare[leaf][:, None], spare[other][None, :])
            m, n = sizes[leaf][:, None], sizes[other][None, :]
            fit = (9 * bound >= 4 * (m + n)) & (5 * m >= 4 * n) & (5 * n >= 4 * m) & (labels[leaf][:, None] != labels[other][None, :])
            x, y = np.nonzero(fit)
            if len(x):
                yield leaf[x], other[y]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(doc_id, text) of batches, a few MB at a time."""
    for batch in batches:
        ids, texts, at = batch.column("doc_id"), batch.column("text").cast(pa.large_string()), 0
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH)))
            yield ids.slice(at, to - at), texts.slice(at, to - at)
            at = to


def similar_documents(docs: DataFrame, words: int = 5) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of 0.8 or more.

    Returns a row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id
    that links lead to). A set has the distinct sequences of ``words`` words, A-Z in lower
    case; with fewer words, the whole sequence. A text that is null or without words has an
    empty set and links with nothing. A row without an id links with nothing and has no
    component. Rows that repeat an id are one document. No rows give no rows.
    """
    spark = docs.sparkSession
    ready(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches):
            hashes, starts = shingle_sets(texts, words)
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (mix(hashes), mix(hashes + np.uint64(0x5851F42D4C957F2D)))]
            one, two = [(x[starts[1:]] - x[starts[:-1]]).view(np.int64) for x in sums]
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(starts)), pa.array(one), pa.array(two)], names=["doc_id", "n", "one", "two"])

    signed = written(docs.mapInArrow(sign, "doc_id long, n long, one long, two long"), "signed")
    # Equal sets are one point: the smallest id stands for them.
    same = ["n", "one", "two"]
    points = written(signed.filter("n > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("point")), "points")
    verified = _links(docs, points, words)
    found = components(verified)
    whole = points.join(found.withColumnRenamed("node", "point"), "point", "left").select(*same, F.coalesce("component", "point").alias("component"))
    out = signed.join(whole, same, "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def _links(docs: DataFrame, points: DataFrame, words: int) -> DataFrame:
    """Verified links (a, b) that connect the components of the points."""
    spark = docs.sparkSession
    total = points.agg(F.sum("n").alias("n")).first()["n"] or 0
    size = total * 7
    chunks = max(partitions(spark), math.ceil(size / CHUNK_BYTES))
    bits = min(62, max(BITS, math.ceil(math.log2(SPARE * total / 2 + 1))))
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk")
    rows = docs.filter("doc_id is not null").select("doc_id", "text", chunk).repartition(chunks, "chunk")
    kept = points.select(F.col("point").alias("doc_id")).distinct().select(chunk, F.lit(-1).cast("long").alias("bucket"), F.col("doc_id").alias("n"), F.lit(None).cast("binary").alias("bits"))
    edges = np.array([(k << bits) // chunks for k in range(chunks)], np.uint64)

    def sets(docs_: pa.Table, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, hashes, starts) of the points among some documents, a few MB at a time."""
        wanted = right.filter(pc.equal(right["bucket"], -1))["n"]
        docs_ = docs_.filter(pc.is_in(docs_["doc_id"], wanted.combine_chunks()))
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in docs_["text"].chunks] or [pa.array([], pa.large_string())])
        ids, at = docs_["doc_id"].to_numpy(), 0
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        while at < len(ids):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH)))
            hashes, starts = shingle_sets(texts.slice(at, to - at), words)
            yield ids[at:to], hashes, starts
            at = to

    def keys_of(hashes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(keys, their set, class of each set) of each variant."""
        n = np.diff(starts)
        for some, level in _variants(n):
            if len(some):
                mine = np.isin(np.repeat(np.arange(len(n)), n), some)
                keys, of = _segments(hashes[mine], np.concatenate([[0], np.cumsum(n[some])]), level)
                yield keys >> np.uint64(64 - bits), some[of], np.repeat(level, np.bincount(of, minlength=len(some)))

    def send_keys(key: tuple, docs_: pa.Table, right: pa.Table) -> pa.Table:
        found = [k for _, hashes, starts in sets(docs_, right) for k, _, _ in keys_of(hashes, starts)]
        names = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]))
        cut = [*np.searchsorted(names, edges).tolist(), len(names)]
        some = [k for k in range(chunks) if cut[k] < cut[k + 1]]
        return _table(chunk=[key[0].as_py()] * len(some), bucket=some, names=[_packed(names[cut[k] : cut[k + 1]]) for k in some])

    def seen_elsewhere(key: tuple, sent: pa.Table) -> pa.Table:
        lists = [_unpacked(x) for x in sent["names"].to_pylist()]
        every = np.sort(np.concatenate(lists))
        twice = np.append(np.unique(every[1:][every[1:] == every[:-1]]), np.uint64((1 << 64) - 1))
        answers = [np.packbits(twice[np.searchsorted(twice, x)] == x).tobytes() for x in lists]
        return _table(chunk=sent["chunk"].to_pylist(), bucket=sent["bucket"].to_pylist(), n=[len(x) for x in lists], bits=answers)

    def in_cells(key: tuple, docs_: pa.Table, right: pa.Table) -> pa.Table:
        """The sets that share a key with another, with these keys and their points."""
        parts = [(ids, hashes, starts, list(keys_of(hashes, starts))) for ids, hashes, starts in sets(docs_, right)]
        every = np.sort(np.concatenate([np.zeros(0, np.uint64), *[k for *_, found in parts for k, _, _ in found]]))
        names = np.unique(every)
        shared = _bits(right.filter(pc.greater_equal(right["bucket"], 0)), len(names))
        shared |= np.isin(names, every[1:][every[1:] == every[:-1]])
        out: list[tuple] = []
        for ids, hashes, starts, found in parts:
            for keys, of, level in found:
                at = np.flatnonzero(shared[np.searchsorted(names, keys)])
                for piece in np.split(at, np.flatnonzero(np.diff(of[at])) + 1) if len(at) else []:
                    i = int(of[piece[0]])
                    mine = hashes[starts[i] : starts[i + 1]]
                    out.append((int(ids[i]), len(mine), int(level[piece[0]]), keys[piece].astype(np.int64), _counts(mine, int(level[piece[0]])).tobytes(), _fine(mine, int(level[piece[0]]))))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 6, kinds, strict=True)], names=["doc_id", "n", "level", "keys", "counts", "fine"])

    names = rows.groupBy("chunk").cogroup(kept.groupBy("chunk")).applyInArrow(send_keys, "chunk long, bucket long, names binary")
    answers = names.groupBy("bucket").applyInArrow(seen_elsewhere, "chunk long, bucket long, n long, bits binary")
    both = kept.union(answers)
    cells = rows.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(in_cells, "doc_id long, n long, level int, keys array<long>, counts binary, fine binary")
    cells = written(cells, "cells")
    at = cells.select("doc_id", "level", "n", "counts", "fine")
    keys = cells.select("doc_id", "level", F.explode("keys").alias("key"))
    # A cell is a key at a class: keys of two classes that got one name by chance stay apart.
    # Each with the smallest of its cell.
    cell = ["key", "level"]
    least = keys.groupBy(*cell).agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).filter("a < z").drop("z")
    stars = keys.join(least, cell).filter("doc_id > a").select("a", F.col("doc_id").alias("b"), "level").distinct()
    first = written(_verified(_bounded(stars, at).distinct(), docs, words), "links")
    # Then all that are in a cell and not yet in one component.
    found = components(first)
    labelled = keys.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("component", "doc_id")).drop("component")
    # The smallest of a cell has met all others of it.
    labelled = written(labelled.join(least, cell).filter("doc_id > a").drop("a"), "labelled")
    mixed = labelled.groupBy(*cell).agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("m")).filter("x < y").drop("x", "y")
    mixed = written(mixed, "mixed")
    # A few in a cell are paired as they are, and each pair is looked at once.
    some = labelled.join(mixed.filter(F.col("m") <= FEW).drop("m"), cell)
    other = some.select(*cell, F.col("doc_id").alias("b"), F.col("label").alias("label_b"))
    near = some.join(other, cell).filter("doc_id < b and label <> label_b").select(F.col("doc_id").alias("a"), "b", "level").distinct()
    mixed = mixed.filter(F.col("m") > FEW)
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks.cast("long")).cast("int")
    apart = labelled.join(mixed, cell).withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    apart = apart.select("key", "doc_id", "level", "label", "own", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))
    apart = apart.join(at, ["doc_id", "level"])
    apart = apart.withColumn("task", F.pmod(F.xxhash64("key", "level", "i", "j"), F.lit(chunks)))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})]
        for (_, _, i, j), cell in group.groupby(["key", "level", "i", "j"], sort=False):
            cell = cell.drop_duplicates("doc_id")
            labels = cell["label"].to_numpy()
            if len(cell) < 2 or (labels == labels[0]).all():
                continue
            points_ = np.stack([np.frombuffer(x, np.uint8) for x in cell["counts"]])
            points_ = np.where(points_ == 255, np.uint16(65535), points_) if (points_ == 255).any() else points_
            ids, side = cell["doc_id"].to_numpy(), cell["own"].to_numpy()
            left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
            fine = np.stack([np.frombuffer(x, np.uint64) for x in cell["fine"]])
            for x, y in box_pairs(points_, fine, cell["n"].to_numpy(), labels, left, right):
                out.append(pd.DataFrame({"a": np.minimum(ids[x], ids[y]), "b": np.maximum(ids[x], ids[y])}))
        return pd.concat(out, ignore_index=True).drop_duplicates()

    pairs = apart.groupBy("task").applyInPandas(join, "a long, b long").union(_bounded(near, at)).distinct()
    second = written(_verified(pairs, docs, words), "links")
    return first.union(second)


def _bounded(pairs: DataFrame, at: DataFrame) -> DataFrame:
    """Of pairs (a, b, level), those whose fine points have enough in common. ``at`` has the
    size and fine point of each document and level."""
    for side in ("a", "b"):
        pairs = pairs.join(at.select(F.col("doc_id").alias(side), "level", F.col("n").alias(f"n_{side}"), F.col("fine").alias(f"fine_{side}")), [side, "level"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for m, n, x, y in zip(batch["n_a"].to_pylist(), batch["n_b"].to_pylist(), batch["fine_a"].to_pylist(), batch["fine_b"].to_pylist(), strict=True):
                p, q = int.from_bytes(x), int.from_bytes(y)
                bound = (p & q).bit_count() + min(m - p.bit_count(), n - q.bit_count())
                keep.append(5 * m >= 4 * n and 5 * n >= 4 * m and 9 * bound >= 4 * (m + n))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(check, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """Of pairs (a, b), those with 100 * intersection >= 80 * union."""
    pairs = written(pairs, "pairs")
    # The sets of these documents only: written first, few ids go to the texts and not the texts to them.
    wanted = written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches):
            hashes, starts = shingle_sets(texts, words)
            found = [hashes[x:y].astype("<u8").tobytes() for x, y in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], names=["doc_id", "hashes"])

    held = docs.join(wanted, F.col("doc_id") == F.col("id"), "left_semi").mapInArrow(sets, "doc_id long, hashes binary")
    held = written(held, "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            keep = []
            for i in range(batch.num_rows):
                p, q = np.frombuffer(x[i].as_buffer(), "<u8"), np.frombuffer(y[i].as_buffer(), "<u8")
                both = np.concatenate([p, q])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= 80 * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(held.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y")), "b").join(held.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x")), "a")
    return joined.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")
