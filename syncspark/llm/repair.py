"""Token files with Re-Pair grammar compression.

A file holds shards, a shard the ids of consecutive documents as symbols of a grammar: pairs
of neighbouring symbols are replaced by new ones until none occurs often enough to pay for
its rule. No symbol reaches over the end of a document, and a shard stores how far the symbols
and the ids of each document go, so one document can be decoded alone. The container is
Parquet, one row a shard, so any store that Spark writes to will do.

Format of a row: shard; doc_ids; token_ends and symbol_ends (counts up to each document's
end); vocabulary (ids below it stand for themselves); rules (uint32 pairs: symbol
``vocabulary + k`` is pair k, of earlier symbols); rule_lengths (uint32: ids that a rule
stands for); width (bits of a symbol); symbols (the lowest bit of all, eight to a byte and the
first highest, then the next bit of all, and so on). Numbers are little-endian.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import body, partitions, ready
from .packing import encoded
from .tokens import default_path, encoder

SHARD_TOKENS = 1 << 22
LEAST = 8  # times a pair must occur to get a symbol: a rule takes the room of four

FILE = (
    "shard long, doc_ids array<long>, token_ends array<long>, symbol_ends array<long>, vocabulary int, "
    "rules binary, rule_lengths binary, width int, symbols binary"
)


def _apart(at: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Of ascending places of pairs those to replace, none of which overlap: the highest score
    goes first, and neighbours never have the same."""
    won = []
    while len(at):
        touch = np.diff(at) == 1
        wins, gone = np.ones(len(at), bool), np.zeros(len(at), bool)
        wins[:-1] &= ~touch | (score[:-1] > score[1:])
        wins[1:] &= ~touch | (score[1:] > score[:-1])
        gone[:-1] = touch & wins[1:]
        gone[1:] |= touch & wins[:-1]
        won.append(at[wins])
        at, score = at[~(wins | gone)], score[~(wins | gone)]
    return np.sort(np.concatenate(won))


def _by_code(code: np.ndarray, at: np.ndarray, made: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes, all below the square of ``made``, and places, below ``n``, in their order. They are
    sorted as one number where that has room for both, which is several times as fast."""
    bits = n.bit_length()
    if made * made << bits < 1 << 63:
        both = np.sort((code << bits) | at)
        return both >> bits, both & ((1 << bits) - 1)
    order = np.argsort(code, kind="stable")
    return code[order], at[order]


def compress(ids: np.ndarray, ends: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (k, 2) and symbol counts up to the end of each document.

    ``ends`` are the counts of ids up to the end of each document, none of them empty. A round
    gives a symbol to every pair that occurs LEAST times; where pairs overlap the more frequent
    one is replaced. Rounds go on until no pair occurs so often. After the first, only pairs
    with a new symbol and those that lost a place can be frequent, so only these are counted.
    """
    symbols, last = ids.astype(np.int32), np.zeros(len(ids), bool)
    last[ends - 1] = True
    rules: list[np.ndarray] = []
    made, look = vocabulary, np.flatnonzero(~last[:-1])
    while True:
        code = symbols[look].astype(np.int64) * made + symbols[look + 1]
        code, look = _by_code(code, look, made, len(symbols))
        starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(code)), bool), code[1:] != code[:-1]]))
        times = np.diff(starts, append=len(code))
        often = times >= LEAST
        pair = code[starts[often]]
        if not len(pair):
            break
        # Which pair begins at a place, -1 if no frequent one does.
        of = np.full(len(symbols), -1, np.int32)
        of[look] = np.repeat(np.where(often, np.cumsum(often) - 1, -1).astype(np.int32), times)
        at, times = np.flatnonzero(of >= 0), times[often]
        which = of[at]
        score = np.empty(len(pair), np.int32)
        score[np.argsort(times, kind="stable")] = 2 * np.arange(len(pair))
        score = score[which]
        # In a run of one pair, which is one symbol twice, every second place comes first.
        twice = np.flatnonzero((pair // made == pair % made)[which])
        place, heads = np.arange(len(twice)), np.ones(len(twice), bool)
        heads[1:] = (np.diff(at[twice]) != 1) | (np.diff(which[twice]) != 0)
        score[twice] += 1 - (place - np.maximum.accumulate(np.where(heads, place, 0))) % 2
        won = _apart(at, score)
        which = of[won]
        worth = np.bincount(which, minlength=len(pair)) >= 4
        won, which = won[worth[which]], which[worth[which]]
        if not len(won):
            break
        number = np.cumsum(worth) - 1 + made
        rules.append(np.stack([pair[worth] // made, pair[worth] % made], axis=1))
        symbols[won] = number[which]
        last[won] = last[won + 1]
        keep, again = np.ones(len(symbols), bool), np.zeros(len(symbols), bool)
        keep[won + 1] = False
        again[at] = again[won] = True
        symbols, last, again = symbols[keep], last[keep], again[keep]
        again[:-1] |= symbols[1:] >= made
        again &= ~last
        look, made = np.flatnonzero(again), made + int(worth.sum())
    return symbols, np.concatenate(rules).astype(np.uint32) if rules else np.zeros((0, 2), np.uint32), np.flatnonzero(last) + 1


class Grammar:
    """Expands symbols of a shard.

    Rules are opened once, level by level: lengths tell where the ids of each begin. The rules
    of a round stand for different places, so theirs are never more ids than the shard has.
    """

    def __init__(self, vocabulary: int, rules: np.ndarray, lengths: np.ndarray):
        self.lengths = np.concatenate([np.ones(vocabulary, np.int64), lengths.astype(np.int64)])
        stops = np.cumsum(self.lengths)
        self.starts = stops - self.lengths
        self.flat = np.empty(stops[-1], np.uint32)
        symbols, at, rules = np.arange(len(self.lengths)), self.starts, rules.astype(np.int64)
        while len(symbols):
            opened = symbols >= vocabulary
            self.flat[at[~opened]] = symbols[~opened]
            at, pairs = at[opened], rules[symbols[opened] - vocabulary]
            symbols, at = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([at, at + self.lengths[pairs[:, 0]]])

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.lengths[symbols]
        out = np.cumsum(n)
        return self.flat[np.repeat(self.starts[symbols] - out + n, n) + np.arange(out[-1] if len(out) else 0)]


def _packed(symbols: np.ndarray, width: int) -> bytes:
    planes = np.ascontiguousarray(symbols.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return b"".join(np.packbits(planes[k // 8] & np.uint8(1 << k % 8)).tobytes() for k in range(width))


def _unpacked(data: bytes, width: int, n: int) -> np.ndarray:
    planes, out = np.frombuffer(data, np.uint8).reshape(width, -1), np.zeros((4, n), np.uint8)
    for k in range(width):
        out[k // 8] |= np.unpackbits(planes[k], count=n) << (k % 8)
    return np.ascontiguousarray(out.T).view("<u4")[:, 0].astype(np.int32)


def _shard(number: int, names: list, ids: list[np.ndarray], vocabulary: int) -> pa.RecordBatch:
    ends = np.cumsum([len(x) for x in ids])
    symbols, rules, symbol_ends = compress(np.concatenate(ids), ends, vocabulary)
    lengths = np.ones(vocabulary + len(rules), np.uint32)
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[vocabulary + k] = lengths[a] + lengths[b]
    width = (vocabulary + len(rules)).bit_length()
    row = [number, names, ends, symbol_ends, vocabulary, rules.astype("<u4").tobytes(), lengths[vocabulary:].astype("<u4").tobytes(), width, _packed(symbols, width)]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[f.split()[0] for f in FILE.split(", ")])


def write_tokens(docs: DataFrame, path: str, end: int = 2, tokenizer: str | None = None) -> None:
    """Encode all texts and write them in ascending order of doc_id.

    Each document is its ids and the end id. A null or empty text is the end id alone. Null
    ids come last, repeated rows are written each, no rows write a file without shards.
    """
    spark = docs.sparkSession
    ready(spark)
    source = tokenizer or default_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = max(encoder(source).tokenizer.get_vocab_size(with_added_tokens=True), end + 1)
        number, names, ids, held = TaskContext.get().partitionId() << 32, [], [], 0
        for found, of in encoded(batches, source):
            for name, x in zip(of.to_pylist(), found, strict=True):
                names.append(name)
                ids.append(np.append(x, np.uint32(end)))
                held += len(x) + 1
                if held >= SHARD_TOKENS:
                    yield _shard(number, names, ids, vocabulary)
                    number, names, ids, held = number + 1, [], [], 0
        if names:
            yield _shard(number, names, ids, vocabulary)

    order = F.col("doc_id").asc_nulls_last()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    rows = rows.repartitionByRange(partitions(spark), order).sortWithinPartitions(order, "text")
    rows.mapInArrow(write, FILE).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, only: Sequence[int] | None = None, with_ids: bool = False) -> DataFrame:
    """Documents of a token file: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of the ids as little-endian unsigned 32-bit numbers) and, if asked for, ids.

    ``only`` some doc_ids decodes no others.
    """
    ready(spark)
    file = spark.read.schema(FILE).parquet(path)
    # Where each shard starts: within the task that wrote it, and among tasks, a row each.
    part = F.shiftright("shard", 32)
    counts = file.select("shard", part.alias("part"), F.element_at("token_ends", -1).alias("n"))
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    bases = counts.withColumn("within", F.coalesce(F.sum("n").over(before), F.lit(0))).join(parts, "part").select("shard", (F.col("base") + F.col("within")).alias("base"))
    chosen = None if only is None else set(only)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names, ends, stops = row["doc_ids"], row["token_ends"], row["symbol_ends"]
                symbols = _unpacked(row["symbols"], row["width"], stops[-1])
                grammar = Grammar(row["vocabulary"], np.frombuffer(row["rules"], "<u4").reshape(-1, 2), np.frombuffer(row["rule_lengths"], "<u4"))
                take = [i for i, name in enumerate(names) if chosen is None or name in chosen]
                if chosen is None:
                    whole = grammar.expand(symbols)
                    found = [whole[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                else:
                    found = [grammar.expand(symbols[stops[i - 1] if i else 0 : stops[i]]) for i in take]
                out = [
                    pa.array([names[i] for i in take], pa.int64()), pa.array([row["shard"]] * len(take), pa.int64()),
                    pa.array([ends[i - 1] if i else 0 for i in take], pa.int64()), pa.array([len(x) for x in found], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64()),
                ]
                out += [pa.array([x.tolist() for x in found], pa.list_(pa.int64()))] if with_ids else []
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "shard", "within", "n_tokens", "ids_crc32", "ids"][: len(out)])

    if chosen is not None:
        file = file.filter(F.arrays_overlap("doc_ids", F.array(*[F.lit(i).cast("long") for i in chosen])))
    rows = file.mapInArrow(decode, "doc_id long, shard long, within long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
    return rows.join(bases, "shard").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
