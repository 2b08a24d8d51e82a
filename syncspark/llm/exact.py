"""Exact dedup by content sort.

Sampled splitters range-partition the texts by their opening and digest, an external
sort places equal texts side by side, and each row is compared in full with its
neighbours. The range also goes by length and id, so a text that fills a third of the
table spreads over many partitions; runs that go on in the next partition are joined by
the texts at the edges, of which there are two a partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import SPACE, body, partitions, ready, written

OPENING = 64
_SPACE = SPACE.encode()


def _number_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal texts in one sorted partition; then its edge texts."""
    part, count, digest, heads, edges = TaskContext.get().partitionId(), 0, None, [], []
    for batch in batches:
        texts, runs, firsts = batch.column("body").cast(pa.binary()), [], []
        for i, d in enumerate(batch.column("text_sha256").to_pylist()):
            text = texts[i].as_py().translate(None, _SPACE)
            if d != digest:
                digest, heads = d, []
            run = next((n for n, other in heads if other == text), None)
            firsts.append(run is None)
            if run is None:
                run, count = count, count + 1
                heads.append((run, text))
                edges = [*edges[:1], (run, text)]
            runs.append(run)
        n = len(runs)
        columns = [c for c in batch.schema.names if c != "body"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in columns]
            + [pa.array([part] * n, pa.int32()), pa.array(runs, pa.int64()), pa.array(firsts), pa.nulls(n, pa.binary())],
            names=[*columns, "part", "run", "first", "edge"],
        )
        nulls = {c: batch.schema.field(c).type for c in columns}
    if edges:
        n = len(edges)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, kind) for kind in nulls.values()]
            + [pa.array([part] * n, pa.int32()), pa.array([e[0] for e in edges], pa.int64()), pa.nulls(n, pa.bool_()), pa.array([e[1] for e in edges], pa.binary())],
            names=[*nulls, "part", "run", "first", "edge"],
        )


def _sorted_runs(docs: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, chars, text_sha256, part, run, first) and the joined edge runs."""
    spark = docs.sparkSession
    ready(spark)
    bare = F.translate(body(), SPACE, "")
    kept = [F.col(f"`{c}`") for c in columns]
    rows = docs.select(
        (F.struct(*kept) if kept else F.lit(None).cast("struct<none:int>")).alias("row"),
        body().alias("body"), F.col("doc_id"), F.length(body()).alias("chars"),
        F.substring(bare, 1, OPENING).alias("opening"), F.sha2(bare, 256).alias("text_sha256"),
    )
    order = [F.col("opening"), F.col("text_sha256"), F.col("chars").desc(), F.col("doc_id").asc_nulls_last()]
    dealt = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).drop("opening")
    kind = T.StructType(
        [T.StructField(f.name, f.dataType) for f in dealt.schema if f.name != "body"]
        + [T.StructField("part", T.IntegerType()), T.StructField("run", T.LongType()), T.StructField("first", T.BooleanType()), T.StructField("edge", T.BinaryType())]
    )
    table = written(dealt.mapInArrow(_number_runs, kind), "runs")
    # The same text at the edges of several partitions is one run. Two rows a partition.
    edges = table.filter(F.col("edge").isNotNull()).groupBy("edge").agg(F.sort_array(F.collect_set(F.struct("part", "run"))).alias("at"))
    edges = edges.filter(F.size("at") > 1).select(F.col("at")[0].alias("whole"), F.explode("at").alias("at"))
    edges = edges.select(F.col("at.part").alias("part"), F.col("at.run").alias("run"), "whole")
    return table.filter(F.col("edge").isNull()).drop("edge"), edges


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Group documents whose texts are equal without white space.

    Returns a row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256
    (of the text without white space). The longest original text stays, then the smallest
    doc_id. A null text is empty; empty texts are a group. Null ids come last. A repeated
    row (same id and text) is a member like any other, and one of them stays. No rows give
    no rows; other columns, whatever their names, are not read.
    """
    rows, edges = _sorted_runs(docs, ())
    rows = rows.drop("row").join(F.broadcast(edges), ["part", "run"], "left")
    rows = rows.select(
        "doc_id", "chars", "text_sha256", F.coalesce("whole", F.struct("part", "run")).alias("g"),
        (F.col("first") & (F.col("whole").isNull() | (F.col("whole") == F.struct("part", "run")))).alias("kept"),
    )
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("group_size"), F.min_by("doc_id", F.when(F.col("kept"), 0)).alias("keep_id"))
    several = groups.filter("group_size > 1")
    return rows.join(several, "g", "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "kept", "text_sha256",
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, of which exact_dedup says that they stay."""
    rows, edges = _sorted_runs(docs, docs.columns)
    rows = rows.filter("first").join(F.broadcast(edges), ["part", "run"], "left")
    rows = rows.filter(F.col("whole").isNull() | (F.col("whole") == F.struct("part", "run")))
    return rows.select("row.*")
