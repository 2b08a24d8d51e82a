"""Token ids of many texts at once.

The tokenizer takes the added tokens of its file out of a text, splits the rest into
pieces before it looks at the vocabulary, and no piece has white space after something
else or letters next to punctuation: a text may be cut there. The stretches repeat, so each distinct one is encoded once per worker and batch results
are put together from them in numpy.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from .words import span_hashes

# Stretches that a worker remembers; beyond it the memory starts anew.
REMEMBERED = 500_000

_SPACE, _LETTER, _MARK = np.zeros((3, 256), bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(b"!\"#$%&()*+,-./:;<=>?@[]^_`{|}~")] = True  # without the apostrophe of contractions


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where pieces surely end: before white space that follows something else, and
    between a Latin letter and a mark of punctuation."""
    space, letter, mark = _SPACE[data], _LETTER[data], _MARK[data]
    if (data >= 0x80).any():
        # The letters of U+00C0-U+00FF are the byte C3 and one more, but for the signs x and :.
        second = np.flatnonzero(data[:-1] == 0xC3) + 1
        second = second[(data[second] != 0x97) & (data[second] != 0xB7)]
        letter[second] = True
        opens = letter.copy()
        opens[second] = False
        opens[second - 1] = True
    else:
        opens = letter
    at = np.flatnonzero((space[1:] & ~space[:-1]) | (mark[1:] & letter[:-1]) | (opens[1:] & mark[:-1])) + 1
    last = data[at - 1]
    odd = ((last >= 0x80) | ((last >= 0x1C) & (last <= 0x1F))) & ~letter[at - 1]
    if not odd.any():
        return at
    # Not after white space beyond ASCII: U+0085, U+00A0, U+1680, U+2000-205F, U+3000.
    i = at[odd]
    one, two, three = data[i - 1], data[i - 2], data[np.maximum(i - 3, 0)]
    wide = (one < 0x20) | ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((three == 0xE1) & (two == 0x9A)) | ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE3) & (two == 0x80) & (one == 0x80))
    keep = np.ones(len(at), bool)
    keep[np.flatnonzero(odd)[wide]] = False
    return at[keep]


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones for
    themselves, the others in order from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


class Encoder:
    """Encodes with a tokenizer file of the ``tokenizers`` library, no special tokens added."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        added = self.tokenizer.get_added_tokens_decoder().values()
        # Tokens that look at what is around them: texts are encoded as they are.
        self.uncut = any(t.lstrip or t.rstrip or t.single_word for t in added)
        self.added = {t.content for t in added}
        longest = sorted((t.encode() for t in self.added), key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        self._forget()

    def _forget(self) -> None:
        # Stretches are known by 128 bits of hashes: as strings they would take ten times as much.
        self.one, self.two, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _learn(self, stretches: list[str], one: np.ndarray, two: np.ndarray) -> None:
        model, letters, found, rest = self.tokenizer.model, self.letters, [], []
        for i, s in enumerate(stretches):
            if not self.uncut and s not in self.added and (s.isalpha() or (s[0] == " " and s[1:].isalpha())):  # one piece
                found.append([t.id for t in model.tokenize(s.encode().decode("latin-1").translate(letters))])
            else:
                found.append(None)
                rest.append(i)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([stretches[i] for i in rest], add_special_tokens=False), strict=True):
            found[i] = e.ids
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        slots = np.arange(len(self.starts) - 1, len(self.starts) - 1 + len(found))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, ids])
        own = np.argsort(one, kind="stable")
        one = np.concatenate([self.one, one[own]])
        order = np.argsort(one, kind="stable")
        self.one, self.two, self.slot = one[order], np.concatenate([self.two, two[own]])[order], np.concatenate([self.slot, slots[own]])[order]

    def _slots(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Where stretches are remembered, -1 if they aren't."""
        if not len(self.one):
            return np.full(len(one), -1)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        return np.where((self.one[at] == one) & (self.two[at] == two), self.slot[at], -1)

    def _bounds(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where stretches begin and end; an added token is one of its own."""
        if self.uncut:
            return ends
        cuts, spans, at = _cuts(data), [], 0
        while self.pattern and (m := self.pattern.search(data, at)):
            stop = int(ends[np.searchsorted(ends, m.start(), side="right")])
            if m.end() > stop:  # goes on in the next text
                m = self.pattern.search(data, m.start(), stop)
            if m:
                spans.append(m.span())
            at = m.end() if m else stop
        if not spans:
            return np.concatenate([cuts, ends])
        first, last = np.array(spans, np.int64).T
        k = np.searchsorted(first, cuts) - 1  # the token that begins before the cut
        return np.concatenate([cuts[(k < 0) | (cuts >= last[k])], first, last, ends])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text's ids start (one more entry than texts). No nulls."""
        texts = pa.concat_arrays([texts.cast(pa.large_string())])
        n = len(texts)
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        first = int(ends[0])
        ends = ends - first
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[first : first + int(ends[-1])] if raw is not None else np.zeros(0, np.uint8)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        bounds = np.sort(self._bounds(data, ends), kind="stable")
        bounds = bounds[np.concatenate([[True], bounds[1:] != bounds[:-1]])]
        stretches = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))
        coded = stretches.dictionary_encode()
        distinct = coded.dictionary
        edge = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
        letters = np.frombuffer(distinct.buffers()[2], np.uint8)
        one, two = (span_hashes(letters, edge[:-1], edge[1:], seed) for seed in (5, 6))
        if len(self.slot) + len(distinct) > REMEMBERED:
            self._forget()
        slots = self._slots(one, two)
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = np.arange(len(self.starts) - 1, len(self.starts) - 1 + len(new))
            self._learn(distinct.take(pa.array(new)).to_pylist(), one[new], two[new])
        slots = slots[coded.indices.to_numpy()]
        lengths = self.starts[slots + 1] - self.starts[slots]
        out = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.starts[slots] - out[:-1], lengths) + np.arange(out[-1])
        return self.ids[at], out[np.searchsorted(bounds, ends)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker and file."""
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
