"""Words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array and where each text starts (one more entry)."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[int(ends[0]) : int(ends[-1])] if raw is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def split_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and how many words come before each text (one more entry)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    ink = ~_SPACE[data]
    first = np.concatenate([[False], ink[:-1]])
    first[starts[:-1][starts[:-1] < len(data)]] = False
    begins = np.flatnonzero(ink & ~first)
    after = np.concatenate([ink[1:], [False]])
    after[starts[1:][starts[1:] > 0] - 1] = False
    return begins, np.flatnonzero(ink & ~after) + 1, np.searchsorted(begins, starts)


def word_codes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct words and, for each word, which of them it is."""
    bounds = np.empty(2 * len(begins) + 1, np.int64)
    bounds[:-1:2], bounds[1::2], bounds[-1] = begins, ends, ends[-1] if len(ends) else 0
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    coded = pieces.take(pa.array(np.arange(0, 2 * len(begins), 2))).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _letters(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a polynomial of random letters, scrambled."""
    base = (0xD1342543DE82EF95 + 2 * seed * 0x2545F4914F6CDD1D) % (1 << 64) | 1
    out = np.empty(len(begins), np.uint64)
    letters, step = _letters(seed), 1 << 22
    inverse = pow(base, -1, 1 << 64)
    down, up = powers(inverse, 1), powers(base, 1)
    at = 0
    while at < len(begins):  # a stretch of bytes at a time
        lo = int(begins[at])
        to = max(at + 1, int(np.searchsorted(ends, lo + step)))
        n = int(ends[to - 1]) - lo
        if len(up) <= n:
            up, down = powers(base, n + 1), powers(inverse, n + 1)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum(letters[data[lo : lo + n]] * up[:n], out=total[1:])
        b, e = begins[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((total[e] - total[b]) * down[b] + (e - b).astype(np.uint64))
        at = to
    return out


def gram_hashes(names: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each run of n numbers (n - 1 fewer than numbers)."""
    base = (0xDA942042E4DD58B5 + 2 * seed * 0x9E3779B97F4A7C15) % (1 << 64) | 1
    out = np.zeros(max(0, len(names) - n + 1), np.uint64)
    for k in range(n):
        out = out * np.uint64(base) + names[k : k + len(out)]
    return mix(out)
