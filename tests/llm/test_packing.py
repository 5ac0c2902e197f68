"""Packing: an exact round trip, gapless sequences, few of them."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from nightframe.llm import packing as P
from nightframe.llm.common import stored


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TEXTS = [
    "Short one.", "", None, "a <|endoftext|> b", "<|endoftext|>" * 700, "<|endoftext|", "Zwölf Boxkämpfer — 日本語 🎉 ñandú",
    "word " * 3000, "a" * 5000, " \n\t" * 900, "mixed 123 " * 211, "x", "x",
]


def test_pieces_are_the_models_ids(spark, docs_of, model):
    rows = defaultdict(list)
    for r in P.token_pieces(docs_of(*TEXTS), capacity=256).collect():
        rows[r["doc_id"]].append(r)
    for i, text in enumerate(TEXTS):
        want = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted(rows[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert [x for r in pieces for x in r["ids"]] == want
        assert all(r["length"] == 256 for r in pieces[1:])
        for r in pieces:
            ids = want[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_round_trip(spark, docs_of, model):
    docs = docs_of(*TEXTS, extra=True)
    packed = stored(P.pack(P.token_pieces(docs, capacity=256, with_ids=False), capacity=256), "packed")
    sequences = {r["sequence_id"]: r["ids"] for r in P.assemble(docs, packed, capacity=256).collect()}
    filled = defaultdict(int)
    for r in packed.orderBy("sequence_id", "offset").collect():
        assert r["offset"] == filled[r["sequence_id"]]
        filled[r["sequence_id"]] += r["length"]
        ids = sequences[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
    assert max(filled.values()) <= 256
    assert {s: len(ids) for s, ids in sequences.items()} == dict(filled)


def test_empty_table_and_null_ids(spark, docs_of):
    assert P.pack(P.token_pieces(docs_of(), with_ids=False)).count() == 0
    rows = P.pack(P.token_pieces(docs_of((None, "a b"), (None, "a b"), (None, None)), with_ids=False)).collect()
    assert len(rows) == 3 and len({r["sequence_id"] for r in rows}) == 1


def check_plan(histogram, capacity, **options):
    """Every item once, every sequence gapless and within the capacity; the number of sequences."""
    n, intervals = P.plan(histogram, capacity, **options)
    filled, seen = np.zeros(n, int), defaultdict(list)
    for length, lo, hi, first, offset in intervals:
        assert (filled[first : first + hi - lo] == offset).all()
        filled[first : first + hi - lo] += length
        seen[length].append((lo, hi))
    assert not n or (filled.max() <= capacity and filled.min() > 0)
    for length, count in histogram.items():
        parts = sorted(seen[length])
        assert [p[0] for p in parts] == [0, *(p[1] for p in parts[:-1])] and parts[-1][1] == count
    return n


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = (rng.lognormal(5.0, 1.2, 20_000)).astype(int) % 512 + 1
    histogram = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True), strict=True)}
    n = check_plan(histogram, 512, groups=48)
    assert n <= 1.01 * sum(k * v for k, v in histogram.items()) / 512 + 1


def test_plans_of_small_and_uneven_histograms():
    for histogram in ({}, {1: 1}, {64: 3}, {64: 2, 33: 5, 31: 5}, {40: 7}, {33: 100}, {20: 1000, 24: 1000}, {2: 1_000_000_000, 63: 10**9}):
        n = check_plan(histogram, 64) if sum(histogram.values()) < 10**7 else P.plan(histogram, 64)[0]
        assert n * 64 >= sum(k * v for k, v in histogram.items())
    assert P.plan({33: 100}, 64)[0] == 100
    assert 750 <= P.plan({20: 1000, 24: 1000}, 64)[0] <= 755


def test_best_configuration_is_brute_forces():
    rng = np.random.default_rng(3)
    for _ in range(30):
        sizes = np.sort(rng.choice(np.arange(5, 40), 4, replace=False))[::-1]
        values = rng.random(4)
        best = max(
            sum(c * v for c, v in zip(counts, values, strict=True))
            for counts in np.ndindex(*(60 // s + 1 for s in sizes))
            if sum(c * s for c, s in zip(counts, sizes, strict=True)) <= 60
        )
        value, counts = P.best_configuration(sizes, values, 60)
        assert abs(value - best) < 1e-9 and counts @ sizes <= 60
