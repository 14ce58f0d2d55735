import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import AWKWARD, documents, text
from tokenizers import Tokenizer

from tidemark.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)


def check(got, cap):
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append(r)
    for rows in by.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= cap.tokens and len(rows) <= cap.documents and sum(r["length"] ** 2 for r in rows) <= cap.attention
    return len(by)


def test_round_trip_and_capacities(spark):
    rows = AWKWARD + [(50 + k, text(k, k * 7)) for k in range(60)] + [(200, "<|endoftext|> x<|startoftext|>y\x01z \x1c it's"), (201, "a b　c\td\r\ne"), (202, "é É ß İ ퟿")]
    tok = Tokenizer.from_file(PATH)
    docs = documents(spark, rows)
    for cap, size in ((packing.Capacity(), 2048), (packing.Capacity(256, 3, 256 * 256), 256), (packing.Capacity(256, 99, 30_000), 173)):
        got = packing.pack(docs, PATH, cap).collect()
        n = check(got, cap)
        assert n >= sum(r["length"] for r in got) / cap.tokens
        want = []
        for i, t in [(r["doc_id"], r["text"]) for r in docs.collect()]:
            ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
            want += [(i, k, a, len(ids[a : a + size]), zlib.crc32(np.array(ids[a : a + size], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), size))]
        key = lambda x: tuple(-1 if v is None else v for v in x)
        assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert packing.pack(documents(spark, rows).limit(0), PATH).count() == 0


def naive(lengths, cap):
    bins = []
    for x in sorted(lengths, reverse=True):
        fit = [b for b in bins if sum(b) + x <= cap.tokens and len(b) < cap.documents and sum(y * y for y in b) + x * x <= cap.attention]
        if fit:
            min(fit, key=lambda b: cap.tokens - sum(b) - x).append(x)
        else:
            bins.append([x])
    return len(bins)


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_plan_is_as_good_as_piecewise_best_fit(score):
    rng = random.Random(2)
    for cap in (packing.Capacity(), packing.Capacity(2048, 6, 2048**2), packing.Capacity(2048, 50, 1_500_000)):
        top = int(min(cap.tokens, cap.attention**0.5))
        lengths = [min(top, int(rng.expovariate(1 / 400)) + 1) for _ in range(3000)]
        counts = {}
        for x in lengths:
            counts[x] = counts.get(x, 0) + 1
        bins = packing.plan(counts, cap, score=score)
        left = {}
        for many, pattern in bins:
            assert sum(s * q for s, q in pattern) <= cap.tokens and sum(q for _, q in pattern) <= cap.documents and sum(s * s * q for s, q in pattern) <= cap.attention
            for s, q in pattern:
                left[s] = left.get(s, 0) + many * q
        assert left == counts
        assert sum(m for m, _ in bins) <= naive(lengths, cap) * 1.02 + 1
    assert packing.plan({}) == []
    with pytest.raises(ValueError):
        packing.plan({3000: 1})


def test_a_hot_length_gets_every_slot_once(spark):
    docs = documents(spark, [(k, "one and the same text of some words") for k in range(700)], clash=False)
    got = packing.pack(docs, PATH).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 700
    check(got, packing.Capacity())


def test_sequences_are_few(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack(docs, PATH).groupBy().agg({"length": "sum", "sequence_id": "max"}).first()
    tokens, sequences = got["sum(length)"], got["max(sequence_id)"] + 1
    assert -(-tokens // 2048) <= sequences <= 1.01 * -(-tokens // 2048) + 1
