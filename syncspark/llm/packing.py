"""Packing documents into sequences by vector best-fit.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared
lengths). Pieces come longest first; each goes to the open sequence, of those with room
in every respect, whose residual would have the smallest weighted norm. Pieces are dealt
at random into blocks of some thousand sequences, which tasks pack on their own: what a
block wastes at its end is a sequence in thousands, and no block grows with the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import body, ready, written
from .tokens import default_path, encoder

CAPACITY = 2048
BLOCK_TOKENS = 1 << 24
SCORED = 32  # sequences that are scored at once
BATCH = 1 << 21  # bytes of text that are encoded at once


def cut_documents(docs: DataFrame, capacity: int = CAPACITY, end: int = 0, tokenizer: str | None = None) -> DataFrame:
    """Token pieces of each document: doc_id, piece, start, length, ids_crc32.

    A document is its ids and the end id. Only one longer than ``capacity`` is cut, into
    pieces of that length of which the first may be shorter. A null or empty text is the
    end id alone. Repeated rows are cut each; no rows give no rows.
    """
    ready(docs.sparkSession)
    path = tokenizer or default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids_of, names in encoded(batches, path):
            out: list[tuple] = []
            for name, ids in zip(names, ids_of, strict=True):
                ids = np.append(ids, np.uint32(end))
                first = len(ids) % capacity or capacity
                for k, stop in enumerate(range(first, len(ids) + 1, capacity)):
                    start = max(0, stop - capacity) if k else 0
                    out.append((name, k, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), (names.type, pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", body().alias("text")).mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[list[np.ndarray], pa.Array]]:
    """Ids of the texts, and the doc_ids, of batches (doc_id, text) a few MB at a time."""
    for batch in batches:
        texts, names = batch.column("text"), batch.column("doc_id")
        sizes = np.cumsum(np.diff(np.frombuffer(texts.buffers()[1], np.int32 if texts.type == pa.string() else np.int64)[texts.offset : texts.offset + len(texts) + 1]))
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH)))
            ids, starts = encoder(path).encode(texts.slice(at, to - at))
            yield [ids[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)], names.slice(at, to - at)
            at = to


def best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_cost: int, weights: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece of one block.

    Open sequences lie by room. They are scored from the tightest one on, until room alone
    makes the norm too large, so that the best of all of them is found. Of equals the tightest
    and first is taken.
    """
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.zeros((4, len(lengths)))  # room, documents, cost and number of open sequences
    some = made = 0
    wt, wd, wc = weights[0] / capacity**2, weights[1] / max_docs**2, weights[2] / float(max_cost) ** 2
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        at, best, need = -1, np.inf, np.array([[n], [1], [n * n]])
        lo, step = int(np.searchsorted(left[0, :some], n)), SCORED
        while lo < some and wt * (left[0, lo] - n) ** 2 < best:
            rest = left[:3, lo : min(lo + step, some)] - need
            norm = wt * rest[0] ** 2 + wd * rest[1] ** 2 + wc * rest[2] ** 2
            norm[rest.min(axis=0) < 0] = np.inf
            k = int(norm.argmin())
            if norm[k] < best:
                at, best = lo + k, norm[k]
            lo, step = lo + step, step * 4
        if at < 0:
            at, some = some, some + 1
            left[:, at] = capacity, max_docs, max_cost, made
            made += 1
        rest = left[:, at].copy()
        where[i], offset[i] = rest[3], capacity - rest[0]
        rest[:3] -= need[:, 0]
        if rest[:3].min() > 0:
            to = int(np.searchsorted(left[0, :at], rest[0]))
            left[:, to + 1 : at + 1] = left[:, to:at]
            left[:, to] = rest
        else:
            left[:, at : some - 1] = left[:, at + 1 : some]
            some -= 1
    return where, offset


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, max_docs: int = CAPACITY, max_cost: int = CAPACITY**2, weights: tuple[float, float, float] = (1.0, 0.01, 0.01)) -> DataFrame:
    """Adds sequence_id (any number) and offset (gapless from 0) to rows (doc_id, piece, length, ...).

    ``max_docs`` counts pieces of a sequence, ``max_cost`` their squared lengths. The default
    limits follow from the tokens, so that only these bind. A piece must fit into an empty
    sequence. ``pieces`` must come from storage: it is read twice.
    """
    ready(pieces.sparkSession)
    total = pieces.agg(F.sum("length")).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_TOKENS))
    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(blocks)))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["doc_id", "piece"], kind="stable", ignore_index=True)
        lengths = block["length"].to_numpy()
        if ((lengths > capacity) | (lengths**2 > max_cost)).any():
            raise ValueError("a piece is longer than a sequence")
        where, offset = best_fit(lengths, capacity, max_docs, max_cost, weights)
        return block.assign(sequence_id=block["_block"] * (1 << 32) + where, offset=offset).drop(columns="_block")

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("_block").applyInPandas(pack, f"{kind}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end: int = 0, tokenizer: str | None = None, **limits) -> DataFrame:
    """Cut documents into pieces and pack these: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. See cut_documents and pack_pieces for nulls, empty and long texts."""
    return pack_pieces(written(cut_documents(docs, capacity, end, tokenizer), "pieces"), capacity, **limits)
