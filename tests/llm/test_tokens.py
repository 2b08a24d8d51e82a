"""Token ids, packing and token files against the tokenizer itself."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from syncspark.llm.common import new_path
from syncspark.llm.packing import best_fit, pack_documents
from syncspark.llm.repair import LEAST, Grammar, _packed, _unpacked, compress, read_tokens, write_tokens
from syncspark.llm.tokens import Encoder, default_path


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_path())


def ids_of(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_agrees_with_the_tokenizer(encoder):
    rng = random.Random(1)
    letters = " \n\t\r  ab'sé12!?.,　 x\x1d\x85×÷ñÿ…-Ā"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["", "a  b", "\n\n b", "can't we'll", "<|endoftext|> x", "w" * 3000 + " " * 500 + "z"]
    ids, starts = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == ids_of(encoder, text), text


def test_added_tokens_are_those_of_the_library(encoder):
    from tokenizers import Tokenizer

    fresh, rng = Tokenizer.from_file(default_path()), random.Random(5)
    assert fresh.encode("<|endoftext|> x", add_special_tokens=False).ids == [50256, 2124]
    parts = ["<|endoftext|>", "<|endof", "text|>", "<|", "|>", " ", "\n ", "x", "é", "don't", "!"]
    texts = ["<|endof", "text|>", "", "<|endoftext|", "><|endoftext|>", "<|endoftext|><|endoftext|>", "<<|endoftext|>>"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(3000)]
    ids, starts = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == fresh.encode(text, add_special_tokens=False).ids, text


def test_added_tokens_of_other_kinds(tmp_path):
    """Words, tokens that begin alike, and tokens that take the white space around them."""
    from tokenizers import AddedToken, Tokenizer

    for options in ({}, {"lstrip": True}, {"rstrip": True}, {"single_word": True}):
        made = Tokenizer.from_file(default_path())
        made.add_tokens([AddedToken("stop", normalized=False, **options), AddedToken("stopped", normalized=False, **options)])
        made.save(path := str(tmp_path / "tokens.json"))
        fresh, texts = Tokenizer.from_file(path), ["stop", "a  stop  b", "stopped", "nonstop", "stoppe", "d stop stop<|endoftext|>stop", "sto", "p"]
        ids, starts = Encoder(path).encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[starts[i] : starts[i + 1]].tolist() == fresh.encode(text, add_special_tokens=False).ids, (options, text)


def checksum(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pack_documents(docs, rows, encoder):
    found = pack_documents(docs, capacity=256).collect()
    want = Counter()
    for r in rows:
        ids = [*ids_of(encoder, r[1]), 0]
        cuts = [0, *range(len(ids) % 256 or 256, len(ids) + 1, 256)]
        want.update((r[0], k, a, b - a, checksum(ids[a:b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)))
    assert Counter(tuple(r)[:5] for r in found) == want
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in places.values():
        p.sort()
        assert p[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(p[:-1], p[1:], strict=True)) and sum(p[-1]) <= 256
    assert len(places) <= sum(n for *_, n, _ in want.elements()) / 256 * 1.05 + 1


def test_best_fit_holds_every_limit():
    lengths = np.random.default_rng(2).integers(1, 200, 500)
    where, offset = best_fit(lengths, 256, 5, 30_000, (1.0, 0.5, 0.5))
    for s in range(where.max() + 1):
        mine = np.flatnonzero(where == s)
        assert len(mine) <= 5 and lengths[mine].sum() <= 256 and max((lengths[mine] ** 2).sum(), 1) <= max(30_000, lengths[mine].max() ** 2)
        order = mine[np.argsort(offset[mine])]
        assert (offset[order] == np.cumsum(lengths[order]) - lengths[order]).all()


@pytest.mark.parametrize("weights", [(1.0, 0.01, 0.01), (1.0, 0.5, 0.5), (0.01, 1.0, 1.0), (0.0, 0.0, 1.0)])
def test_best_fit_takes_the_best_of_all(weights):
    rng, capacity, most, dear = np.random.default_rng(6), 256, 6, 30_000
    lengths = np.concatenate([rng.integers(1, 173, 700), np.full(60, 40)])
    where, _ = best_fit(lengths, capacity, most, dear, weights)
    wt, wd, wc = weights[0] / capacity**2, weights[1] / most**2, weights[2] / float(dear) ** 2
    left = {}
    for i in np.argsort(-lengths, kind="stable").tolist():
        n, s = int(lengths[i]), int(where[i])
        norms = {k: wt * (r - n) ** 2 + wd * (d - 1) ** 2 + wc * (c - n * n) ** 2 for k, (r, d, c) in left.items() if r >= n and d >= 1 and c >= n * n and min(r, d, c) > 0}
        assert norms[s] == min(norms.values()) if norms else s not in left
        r, d, c = left.get(s, (capacity, most, dear))
        left[s] = (r - n, d - 1, c - n * n)


def test_token_files(spark, unique, encoder):
    path = new_path(spark, "tokens")
    docs = spark.createDataFrame([r[:2] for r in unique], "doc_id long, text string")
    write_tokens(docs.repartition(3), path)
    at, want = 0, {}
    for i, text in sorted(r[:2] for r in unique):
        ids = [*ids_of(encoder, text), 2]
        want[i] = (at, len(ids), checksum(ids), ids)
        at += len(ids)
    assert {r[0]: tuple(r)[1:] for r in read_tokens(spark, path, with_ids=True).collect()} == want
    some = read_tokens(spark, path, only=[60, 204, 12345], with_ids=True).collect()
    assert {r[0]: tuple(r)[1:] for r in some} == {i: want[i] for i in (60, 204)}


def test_token_files_with_missing_and_repeated_ids(spark, docs, rows, none):
    path, empty = new_path(spark, "tokens"), new_path(spark, "tokens")
    write_tokens(docs, path)
    found = sorted(read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert len(found) == len(rows) and [r["doc_id"] for r in found][-2:] == [None, None]
    assert [r["start"] for r in found] == np.cumsum([0, *[r["n_tokens"] for r in found]])[:-1].tolist()
    write_tokens(none, empty)
    assert read_tokens(spark, empty).count() == pack_documents(none).count() == 0


def test_grammar_round_trip():
    rng = np.random.default_rng(4)
    for n, stock in ((5000, 8), (3000, 3000), (400, 1), (1, 5)):
        ids = rng.integers(0, stock, n).astype(np.uint32)
        ends = np.unique(np.append(rng.integers(1, n + 1, 9), n))
        symbols, rules, stops = compress(ids, ends, 3000)
        lengths = [1] * 3000
        for a, b in rules.tolist():
            lengths.append(lengths[a] + lengths[b])
        grammar = Grammar(3000, rules, np.array(lengths[3000:]))
        assert (grammar.expand(symbols) == ids).all() and len(stops) == len(ends)
        for k in range(len(ends)):
            part = grammar.expand(symbols[stops[k - 1] if k else 0 : stops[k]])
            assert (part == ids[ends[k - 1] if k else 0 : ends[k]]).all()
        pairs = Counter(p for a, b in zip([0, *stops[:-1]], stops, strict=True) for p in zip(symbols[a : b - 1].tolist(), symbols[a + 1 : b].tolist(), strict=True))
        places = Counter()
        for p, times in pairs.items():
            places[p] = times if p[0] != p[1] else (times + 1) // 2
        assert max(places.values(), default=0) < LEAST


def test_grammar_shortens_long_repeats():
    """A passage in many documents, and a run of one id, become a few symbols each."""
    rng = np.random.default_rng(9)
    passage = rng.integers(0, 3000, 500)
    parts = [np.concatenate([rng.integers(0, 3000, 5), passage]) for _ in range(200)] + [np.full(40_000, 7)]
    ids, ends = np.concatenate(parts).astype(np.uint32), np.cumsum([len(p) for p in parts])
    symbols, rules, stops = compress(ids, ends, 3000)
    assert np.diff(stops)[:199].max() <= 10 and stops[-1] - stops[-2] <= 24
    assert _unpacked(_packed(symbols, 13), 13, len(symbols)).tolist() == symbols.tolist()
