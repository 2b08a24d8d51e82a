"""Approximate nearest neighbours with a forest of hash prefixes.

In each tree every vector has a long string of bits, the sides of random hyperplanes it
lies on, and the strings are sorted. A query descends each tree to where its own string
would stand; the entries around it share the longest prefixes. From there it ascends in
all trees at once, a bit at a time, until the entries that share the prefix are enough,
and these are compared with it in full.

A tree's sorted array is kept in slices of a bounded number of entries. Each slice counts
and compares on its own; a query goes to the slices that its prefix covers. Entries with
one string can't be cut between strings: they are dealt over parts by a hash of vec_id,
and a query goes to all parts of a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import ready, written

TREES = 16
BITS = 32
SLICE = 32768
SAMPLE = 10_000  # vectors that the centre is taken from, at most
# Entries to compare, of a tree: the more vectors, the more lie about as near.
SHARE, GROWTH, LEAST = 0.25, 0.86, 200


def usable_vectors(table: DataFrame) -> DataFrame:
    """Rows (vec_id, vec) whose vectors can be compared: no nulls, finite, not zero, and of
    the length that most have (the larger if two are as frequent)."""
    vec = F.col("embedding").cast("array<double>")
    rows = table.filter("vec_id is not null").select("vec_id", vec.alias("vec"))
    rows = rows.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    size = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("vec") == (size["d"] if size else 0))


def _planes(centre: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """Directions (dimension, trees * BITS), orthogonal within a tree as far as they can be."""
    rng, d = np.random.default_rng(seed), len(centre)
    found = []
    for _ in range(trees):
        one = [np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(-(-BITS // d))]
        found.append(np.concatenate(one, axis=1)[:, :BITS])
    return np.concatenate(found, axis=1)


def nearest(table: DataFrame, queries: DataFrame, k: int = 10, trees: int = TREES, seed: int = 11) -> DataFrame:
    """The ``k`` nearest found of each query among all rows of ``table`` but its own.

    ``table`` and ``queries`` have vec_id and embedding; queries are rows of the table.
    Returns query_id, rank (from 1), vec_id, score: the Euclidean distance of the original
    vectors, ties to the smaller vec_id. Rows whose vectors can't be compared take no part.
    Of equal vectors the ``k + 1`` smallest ids stand for all, which is exact. A repeated
    vec_id counts once. With few rows all of them are compared.
    """
    spark = table.sparkSession
    ready(spark)
    among = Window.partitionBy("vec").orderBy("vec_id")
    all_rows = usable_vectors(table).dropDuplicates(["vec_id"])
    rows = written(all_rows.withColumn("i", F.row_number().over(among)).filter(F.col("i") <= k + 1).drop("i"), "vectors")
    asked = written(queries.select("vec_id").distinct().join(all_rows, "vec_id"), "queries")
    first = asked.groupBy("vec").agg(F.min("vec_id").alias("query_id"))
    members = asked.join(first, "vec").select(F.col("vec_id").alias("member"), "query_id")
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = np.stack(sample["vec"].to_numpy())
    centre = vectors.mean(axis=0)
    sent = spark.sparkContext.broadcast((centre, _planes(centre, trees, seed)))
    enough = trees * max(LEAST, int(np.ceil(SHARE * n**GROWTH)))

    def strings(matrix: np.ndarray) -> np.ndarray:
        """The bit string of each vector in each tree, as a number."""
        middle, planes = sent.value
        bits = ((matrix - middle) @ planes > 0).reshape(len(matrix), trees, BITS)
        return bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))

    def entries(name: str, with_vec: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                vec = batch.column("vec")
                matrix = vec.flatten().to_numpy().reshape(batch.num_rows, -1)
                codes = strings(matrix)
                for t in range(trees):
                    columns = [batch.column(name), pa.array(np.full(len(codes), t, np.int32)), pa.array(codes[:, t])] + [vec] * with_vec
                    yield pa.RecordBatch.from_arrays(columns, names=[name, "tree", "code", "vec"][: len(columns)])

        return run

    kinds = "long, tree int, code long"
    # Where slices begin: quantiles of each tree's strings.
    per_tree = -(-n // SLICE)
    cuts = {t: np.zeros(0, np.int64) for t in range(trees)}
    if per_tree > 1:
        narrow = rows.mapInArrow(entries("vec_id", False), f"vec_id {kinds}")
        at = [i / per_tree for i in range(1, per_tree)]
        for row in narrow.groupBy("tree").agg(F.percentile_approx("code", at, 10 * per_tree + 1000).alias("at")).collect():  # a number per slice
            cuts[row["tree"]] = np.unique(np.array(row["at"], np.int64))
    edges = spark.sparkContext.broadcast(cuts)
    parts = spark.sparkContext.broadcast({})

    def slice_of(tree: pd.Series, code: pd.Series) -> np.ndarray:
        out = np.empty(len(tree), np.int64)
        for t, group in code.groupby(tree):
            out[group.index] = (t << 32) + np.searchsorted(edges.value[t], group.to_numpy(), side="right")
        return out

    def sliced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.reset_index(drop=True)
            yield f.assign(slice=slice_of(f["tree"], f["code"]))

    def dealt(df: DataFrame) -> DataFrame:
        kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        return df.mapInPandas(sliced, f"{kind}, slice long")

    if per_tree > 1:
        # Large slices, of which there are fewer than slices were asked for.
        large = dealt(narrow.select("tree", "code")).groupBy("slice").count().filter(F.col("count") >= 1.5 * SLICE).collect()
        parts = spark.sparkContext.broadcast({r["slice"]: round(r["count"] / SLICE) for r in large})

    def parts_of(f: pd.DataFrame) -> np.ndarray:
        return f["slice"].map(parts.value).fillna(1).to_numpy(np.int64)

    def to_one(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            code = pd.util.hash_array(f["vec_id"].to_numpy(np.int64))
            yield f.assign(part=(code % parts_of(f).astype(np.uint64)).astype(np.int64))

    def to_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            times = parts_of(f)
            first_ = np.repeat(np.cumsum(times) - times, times)
            yield f.take(np.repeat(np.arange(len(f)), times)).assign(part=np.arange(len(first_)) - first_)

    def parted(df: DataFrame, how) -> DataFrame:
        kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        return df.mapInPandas(how, f"{kind}, part long")

    index = parted(dealt(rows.mapInArrow(entries("vec_id", True), f"vec_id {kinds}, vec array<double>")), to_one)
    asking = first.mapInArrow(entries("query_id", True), f"query_id {kinds}, vec array<double>")

    def shared(key: tuple, own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        """How many entries share at least so many bits with each query."""
        codes, q = np.sort(own["code"].to_numpy()), ask["code"].to_numpy()
        out = []
        for bits in range(BITS + 1):
            low = BITS - bits
            lo = (q >> low) << low
            count = np.searchsorted(codes, lo + (np.int64(1) << low)) - np.searchsorted(codes, lo)
            out.append(pd.DataFrame({"query_id": ask["query_id"], "bits": bits, "n": count}))
        return pd.concat(out, ignore_index=True)

    own_part = parted(dealt(asking.drop("vec")), to_all)
    counts = index.select("slice", "part", "code").groupBy("slice", "part").cogroup(own_part.groupBy("slice", "part")).applyInPandas(shared, "query_id long, bits int, n long")
    stop = counts.groupBy("query_id", "bits").agg(F.sum("n").alias("n")).filter(F.col("n") >= enough).groupBy("query_id").agg(F.max("bits").alias("bits"))
    asking = asking.join(stop, "query_id", "left").fillna(0, ["bits"])

    def covered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query once for each slice that its prefix covers."""
        for f in frames:
            low = BITS - f["bits"].to_numpy()
            lo = (f["code"].to_numpy() >> low) << low
            hi = lo + (np.int64(1) << low.astype(np.int64))
            tree = f["tree"].to_numpy()
            a = np.array([np.searchsorted(edges.value[t], x, side="right") for t, x in zip(tree, lo, strict=True)], np.int64)
            b = np.array([np.searchsorted(edges.value[t], x - 1, side="right") for t, x in zip(tree, hi, strict=True)], np.int64)
            times = b - a + 1 if len(f) else np.zeros(0, np.int64)
            at = np.repeat(np.arange(len(f)), times)
            k_ = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            yield pd.DataFrame({"query_id": f["query_id"].to_numpy()[at], "vec": f["vec"].to_numpy()[at], "lo": lo[at], "hi": hi[at], "slice": (tree[at].astype(np.int64) << 32) + a[at] + k_})

    asking = parted(asking.mapInPandas(covered, "query_id long, vec array<double>, lo long, hi long, slice long"), to_all)

    def compare(key: tuple, own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(own) or not len(ask):
            return empty
        own = own.sort_values("code", kind="stable")
        codes, ids, matrix, out = own["code"].to_numpy(), own["vec_id"].to_numpy(), np.stack(own["vec"].to_numpy()), [empty]
        for q, vec, lo, hi in ask[["query_id", "vec", "lo", "hi"]].itertuples(index=False):
            a, b = np.searchsorted(codes, [lo, hi])
            if a == b:
                continue
            distance = np.sqrt(((matrix[a:b] - np.asarray(vec)) ** 2).sum(axis=1))
            best = np.lexsort((ids[a:b], distance))[: k + 1]
            out.append(pd.DataFrame({"query_id": q, "vec_id": ids[a:b][best], "score": distance[best]}))
        return pd.concat(out, ignore_index=True)

    found = index.drop("tree").groupBy("slice", "part").cogroup(asking.groupBy("slice", "part")).applyInPandas(compare, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = best.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= k + 1).drop("i")
    # Every query with the vector gets the result, without itself.
    out = members.join(best, "query_id").filter(F.col("member") != F.col("vec_id"))
    order = Window.partitionBy("member").orderBy("score", "vec_id")
    out = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return out.select(F.col("member").alias("query_id"), "rank", "vec_id", "score")
