"""Conversation repair by an auction for shortest paths.

The rows of a conversation are the layers of a lattice; a node is a layer and the state of
the repaired roles so far (nothing, after system, after user, after assistant). Arcs are
edits with integer costs. The auction keeps a path from the origin and a price a node: it
extends the path along an arc whose cost is the difference of the prices, or raises the
price of its last node and contracts. No arc is ever cheaper than the difference of its
prices, so once the path reaches the end every cheapest path consists of tight arcs, and
the least of these by its letters is traced.

A conversation may hold any share of the rows. Rows are sorted over ranges, cut into
segments of a few rows and each segment is a lattice of its own, whose ways out cost what
the next segment's nodes are priced at. A conversation that ends in its segment is done
there; of the others, only a letter a row meets in one task, and texts are hashed in a
stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import partitions, ready, written

SEGMENT = 32  # rows of a lattice
SEGMENT_BYTES = 1 << 20
KEEP, REROLE, DELETE, INSERT, OPEN_END = 0, 3, 4, 3, 3  # costs of edits, and of leaving a text cut off
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the role that may be put in after each state
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LAST = (0, None, None, 0)  # ways out of a conversation: empty, or after an assistant

FOUND = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PARTS = (
    "kind int, conv_id long, part int, seq long, codes string, times array<long>, roles array<string>, texts array<string>, "
    "first_initial string, last_initial string, illegal long, low long, high long, turns long, blank long, duplicate long, truncated long, "
    "gaps long, cost long, audit string, repaired_sha256 string"
)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage: conv_id, turn, role, text and how often they are there. A conversation
    whose rows are all dropped keeps a row that is there 0 times."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    hit = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(F.col("role").cast("string"), blank), F.coalesce(F.col("text").cast("string"), blank)
    gone = F.col("_hit") == 0
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), hit.alias("_hit"))
    return rows.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("_hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (F.col("_hit") == 1), "").when(F.col("_hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(F.col("_hit") == 3, 2).otherwise(1).cast("long").alias("times"),
    )


@lru_cache(maxsize=1 << 6)
def _arcs(codes: str, out: tuple) -> tuple[list[list[tuple[str, int, int]]], int]:
    """Arcs (letter, cost, node) of each node in the order of letters, and the end node. A way
    out has no letter. Only a conversation's last layer can be added to."""
    last, m = out == LAST, len(codes)
    end = 4 * m + 4
    arcs: list[list[tuple[str, int, int]]] = []
    for i in range(m + 1):
        for s in range(4):
            here = []
            if i == m and out[s] is not None:
                here.append(("", out[s], end))
            if i < m:
                here.append(("D", DELETE, 4 * i + 4 + s))
            if i < m or last:
                here.append(("I", INSERT, 4 * i + NEXT[s]))
            if i < m:
                more = OPEN_END if codes[i].isupper() else 0
                if (kept := KEPT.get((s, codes[i].lower()))) is not None:
                    here.append(("K", KEEP + more, 4 * i + 4 + kept))
                here.append(("R", REROLE + more, 4 * i + 4 + NEXT[s]))
            arcs.append(here)
    return arcs, end


def _auction(arcs: list[list[tuple[str, int, int]]], origin: int, end: int, price: list[int]) -> None:
    """Raise ``price`` until the path from ``origin`` reaches ``end``; ``price[origin]`` is its cost."""
    path = [origin]
    while (node := path[-1]) != end:
        best, to = min((cost + price[j], j) for _, cost, j in arcs[node])
        if price[node] < best:
            price[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


@lru_cache(maxsize=1 << 12)
def prices(codes: str, out: tuple, origins: tuple = (NOTHING,)) -> tuple[int, ...]:
    """Prices of all nodes after auctions from ``origins``, one set of prices for all."""
    arcs, end = _arcs(codes, out)
    price = [0] * (end + 1)
    for origin in origins:
        _auction(arcs, origin, end, price)
    return tuple(price)


@lru_cache(maxsize=1 << 14)
def trace(codes: str, out: tuple, origins: tuple, start: int) -> tuple[str, int]:
    """Letters of the cheapest way from ``start``, the least in ASCII, and the state it leaves in."""
    arcs, end = _arcs(codes, out)
    price = prices(codes, out, origins)
    dead: set[int] = set()
    walk: list[tuple[int, str]] = [(start, "")]
    while walk[-1][0] != end:
        node = walk[-1][0]
        for letter, cost, to in arcs[node]:
            if to not in dead and price[node] == cost + price[to]:
                walk.append((to, letter))
                break
        else:  # tight, but not a part of any cheapest way
            dead.add(node)
            walk.pop()
    return "".join(letter for _, letter in walk), walk[-2][0] % 4


def edits(letters: str, state: int, codes: str, times: list[int]) -> tuple[str, int, list[tuple[int, str | None]]]:
    """The whole audit with rows that had to go, the state at its end, and the repaired rows as
    (row or -1 for one put in, its new role or None). ``codes`` and ``times`` are of all rows."""
    audit, rows, at = [], [], 0
    for letter in letters + " ":
        while at < len(codes) and codes[at] == "-":
            audit.append("D" * times[at])
            at += 1
        if letter == " ":
            break
        audit.append(letter)
        if letter == "I":
            state = NEXT[state]
            rows.append((-1, ROLE[state]))
        elif letter == "K":
            state = KEPT[state, codes[at].lower()]
            rows.append((at, None))
        elif letter == "R":
            state = NEXT[state]
            rows.append((at, ROLE[state]))
        at += letter != "I"
    return "".join(audit), state, rows


def _lines(rows: list[tuple[int, str | None]], roles: list[str], texts: list[str]) -> Iterator[bytes]:
    for i, role in rows:
        yield (f"{role}:" if i < 0 else f"{role or roles[i]}:{texts[i]}").encode()


class _Segment:
    """Rows of one conversation as they come: what a lattice and the counts need of them."""

    def __init__(self, conv: tuple[bool, int], seq: int):
        self.conv, self.seq, self.bytes, self.rows = conv, seq, 0, 0
        self.codes, self.times, self.roles, self.texts = [], [], [], []
        self.first = self.last = None  # initials
        self.illegal = self.turns = self.blank = self.duplicate = self.truncated = 0
        self.low = self.high = None

    def full(self) -> bool:
        return self.rows >= SEGMENT or self.bytes >= SEGMENT_BYTES

    def add(self, turn: int | None, role: str, text: str, times: int, first: bool, blank: bool, cut: bool) -> None:
        if not times:
            return
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += times - 1
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        gone = times if blank or not first else times - 1
        self.blank += times if blank else 0
        self.duplicate += 0 if blank else gone
        if gone < times:
            self.truncated += cut
            code = initial if initial in ("s", "u", "a") else "x"
            self._row(code.upper() if cut else code, 1, role, text)
            self.rows += 1
        if gone:
            self._row("-", gone, None, None)

    def _row(self, code: str, times: int, role: str | None, text: str | None) -> None:
        if code == "-" and self.codes and self.codes[-1] == "-":
            self.times[-1] += times
            return
        self.codes.append(code)
        self.times.append(times)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text or "")

    def result(self, kind: int, part: int) -> dict:
        codes = "".join(self.codes)
        row = {
            "kind": kind, "conv_id": self.conv[1] if self.conv[0] else None, "part": part, "seq": self.seq, "first_initial": self.first, "last_initial": self.last,
            "illegal": self.illegal, "low": self.low, "high": self.high, "turns": self.turns, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
        }
        if kind:
            return row | {"codes": codes, "times": self.times, "roles": self.roles, "texts": self.texts}
        kept = codes.replace("-", "")
        letters, _ = trace(kept, LAST, (NOTHING,), NOTHING)
        audit, _, rows = edits(letters, NOTHING, codes, self.times)
        gone = sum(t for c, t in zip(self.codes, self.times, strict=True) if c == "-")
        return row | {
            "gaps": 0 if self.low is None else self.high - self.low + 1 - self.turns,
            "cost": prices(kept, LAST)[NOTHING] + DELETE * gone,
            "audit": audit,
            "repaired_sha256": hashlib.sha256(b"\n".join(_lines(rows, self.roles, self.texts))).hexdigest(),
        }


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(n, kinds[k]) for n, k in (x.split(" ") for x in ddl.split(", "))])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range as finished conversations (kind 0) and as segments of those that
    are longer or that may go on in another range (kind 1)."""
    part, schema = TaskContext.get().partitionId(), _schema(PARTS)
    now, begins, out, size = None, True, [], 0  # begins: at the start of the range
    for batch in batches:
        for has_id, conv, has_turn, turn, role, text, times, first, blank, cut in _columns(batch):
            if now is None or now.conv != (has_id, conv):
                if now is not None:
                    out.append(now.result(int(begins or now.seq > 0), part))
                    begins = False
                now = _Segment((has_id, conv), 0)
            elif now.full():
                out.append(now.result(1, part))
                now = _Segment(now.conv, now.seq + 1)
            size += len(text)
            now.add(turn if has_turn else None, role, text, times, first, blank, cut)
            if len(out) >= 512 or size >= 1 << 23:
                if out:
                    yield _arrow(out, schema)
                out, size = [], 0
    if now is not None:
        out.append(now.result(1, part))
    if out:
        yield _arrow(out, schema)


def _solve(segments: pd.DataFrame) -> pd.DataFrame:
    """Letters of each segment of one conversation: prices from its end to its start, letters back."""
    segments = segments.sort_values(["part", "seq"])
    codes, outs, out = segments["codes"].tolist(), [], LAST
    every = (NOTHING, SYSTEM, USER, ASSISTANT)
    costs = 0
    for code in reversed(codes):  # counted from the cheapest, so that like segments are priced once
        least = min(x for x in out if x is not None)
        outs.append(LAST if out is LAST else tuple(x - least for x in out))
        costs += 0 if out is LAST else least
        out = prices(code, outs[-1], every)[:4]
    letters, state = [], NOTHING
    for code, leave in zip(codes, reversed(outs), strict=True):
        found, to = trace(code, leave, every, state)
        letters.append((found, state))
        state = to
    return segments[["conv_id", "part", "seq"]].assign(letters=[x for x, _ in letters], state=[s for _, s in letters], cost=costs + out[NOTHING])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order, with their letters, as one row a conversation; texts are hashed as they come."""
    schema, out, now, conv = _schema(FOUND), [], None, ()

    def done() -> None:
        gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
        out.append(now | {"gaps": gaps, "audit": "".join(now["audit"]), "repaired_sha256": now["hash"].hexdigest()})

    for batch in batches:
        for r in batch.to_pylist():
            if now is None or conv != (r["conv_id"],):
                if now is not None:
                    done()
                conv = (r["conv_id"],)
                now = {"conv_id": r["conv_id"], "cost": r["cost"], "audit": [], "hash": hashlib.sha256(), "lines": 0, "last": None, "low": None, "high": None}
                now |= dict.fromkeys(["turns", "blank", "duplicate", "truncated", "illegal"], 0)
            for k in ("blank", "duplicate", "truncated", "illegal"):
                now[k] += r[k]
            if r["first_initial"] is not None:
                now["illegal"] += now["last"] is not None and now["last"] + r["first_initial"] not in ("su", "ua", "au")
                now["last"] = r["last_initial"]
            if r["low"] is not None:
                now["turns"] += r["turns"] - (now["high"] == r["low"])
                now["low"], now["high"] = r["low"] if now["low"] is None else now["low"], r["high"]
            audit, _, rows = edits(r["letters"], r["state"], r["codes"], r["times"])
            now["audit"].append(audit)
            now["cost"] += DELETE * sum(t for c, t in zip(r["codes"], r["times"], strict=True) if c == "-")
            for line in _lines(rows, r["roles"], r["texts"]):
                now["hash"].update(b"\n" + line if now["lines"] else line)
                now["lines"] += 1
            if len(out) >= 512:
                yield _arrow(out, schema)
                out = []
    if now is not None:
        done()
    if out:
        yield _arrow(out, schema)


def _ordered(has: str, value: str) -> list[Column]:
    return [F.col(value).isNotNull().alias(has), F.coalesce(F.col(value), F.lit(0)).alias(value)]


def repair_conversations(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Faults of each conversation and its cheapest repair, the edits least in ASCII among equals.

    ``conversations``: conv_id, turn, role, text. These are damaged first, see ``damaged``;
    ``rows`` (the same and ``times``) are taken as they are instead, if given. Returns one row a
    conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. A null conv_id is a conversation as well; a null turn comes first; a null
    role or text is one space. Rows of one turn come by role, then by the SHA-256 of the text.
    Repeated rows are duplicates. Texts may have any length; no rows give no rows.
    """
    spark = conversations.sparkSession
    ready(spark)
    rows = damaged(conversations) if rows is None else rows
    keys = ["has_id", "conv_id", "has_turn", "turn", "role", "digest"]
    rows = rows.select(*_ordered("has_id", "conv_id"), *_ordered("has_turn", "turn"), "role", F.unhex(F.sha2("text", 256)).alias("digest"), "text", "times")
    rows = rows.groupBy(*keys).agg(F.sum("times").alias("times"), F.first("text").alias("text"))
    # The first of equal rows of a conversation: a join on all keys, so that nothing is uneven.
    same = ["has_id", "conv_id", "role", "digest"]
    first = rows.filter("times > 0").groupBy(*same).agg(F.min(F.struct("has_turn", "turn")).alias("at"))
    first = first.select(*same, "at.has_turn", "at.turn", F.lit(True).alias("first"))
    word = r"[^\x20\x09-\x0D]"
    marked = rows.join(first, keys, "left").select(
        "has_id", "conv_id", "has_turn", "turn", "role", "text", "times", F.coalesce("first", F.lit(False)).alias("first"),
        (~F.col("text").rlike(word)).alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"), "digest",
    )
    ranged = marked.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).drop("digest")
    parts = written(ranged.mapInArrow(_segments, PARTS), "segments")
    whole = parts.filter("kind = 0").select(*[x.split(" ")[0] for x in FOUND.split(", ")])
    cut = parts.filter("kind = 1")
    at = ["conv_id", "part", "seq"]
    letters = cut.select(*at, F.translate("codes", "-", "").alias("codes")).groupBy("conv_id").applyInPandas(_solve, "conv_id long, part int, seq long, letters string, state int, cost long")
    letters = letters.select(F.col("conv_id").alias("c"), "part", "seq", "letters", "state", F.col("cost").alias("total"))
    both = cut.drop("kind", "gaps", "cost", "audit", "repaired_sha256").join(letters, [F.col("conv_id").eqNullSafe(F.col("c")), cut["part"] == letters["part"], cut["seq"] == letters["seq"]])
    both = both.select(cut["part"], cut["seq"], *[F.col(c) for c in ("conv_id", "codes", "times", "roles", "texts", "first_initial", "last_initial", "illegal", "low", "high", "turns", "blank", "duplicate", "truncated", "letters", "state")], F.col("total").alias("cost"))
    return whole.unionByName(both.repartition("conv_id").sortWithinPartitions(*at).mapInArrow(_joined, FOUND))

