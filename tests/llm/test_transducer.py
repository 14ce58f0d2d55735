import random

import public_tokenizers
import pytest
from cases import AWKWARD, documents, text
from tokenizers import Tokenizer

from tidemark.llm import toktransducer as tt

PATH = public_tokenizers.path(tt.TOKENIZER)
PARTS = ["a", "s", "t", " ", "  ", "\n", "'", "'s", "'re", "'r", "'ll", "don't", "1", "23", "é", "ñ", "日本", "!", "...", "\t", " ", "<|endoftext|>", "\x1c", "the", "ing", "😀", " '", "\r\n", "\x85", "٣", "lll", "vve"]


@pytest.fixture(scope="module")
def both():
    return tt.Transducer(PATH), Tokenizer.from_file(PATH)


@pytest.mark.parametrize("chunk", [1 << 16, 7, 1])
def test_counts_equal_the_library(both, monkeypatch, chunk):
    monkeypatch.setattr(tt, "CHUNK", chunk)
    m, tok = both
    rng = random.Random(chunk)
    for _ in range(700):
        t = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        assert m.count(t) == len(tok.encode(t, add_special_tokens=False).ids), repr(t)


def test_neighbours_equal_plain_merging(both):
    m, _ = both
    rng = random.Random(1)
    ranks = {(m.bytes_of[a], m.bytes_of[b]): r for (a, b), r in m.rank.items()}

    def merged(parts):
        while len(parts) > 1:
            r, k = min((ranks.get(p, 1 << 30), k) for k, p in enumerate(zip(parts, parts[1:])))
            if r == 1 << 30:
                break
            parts = [*parts[:k], parts[k] + parts[k + 1], *parts[k + 2 :]]
        return parts

    ids = [i for i, b in m.bytes_of.items() if len(b) < 7]
    for _ in range(3000):
        a, b = rng.choice(ids), rng.choice(ids)
        x, y = m.bytes_of[a], m.bytes_of[b]
        assert m.may_follow(a, b) == (merged([bytes([c]) for c in x + y]) == [x, y])


def test_maps_compose_associatively(both):
    m, _ = both
    maps = [tt.chunk_map(m, t) for t in ("ab c", "dd'", "s  ", "x y\n", "zz", " q")]
    seen = lambda x: (x.head, x.state, x.tokens)
    left = tt.compose(m, tt.compose(m, maps[0], maps[1]), maps[2])
    right = tt.compose(m, maps[0], tt.compose(m, maps[1], maps[2]))
    assert seen(left) == seen(right)
    scan = tt.prefix_scan(m, maps)
    acc = maps[0]
    for k in range(1, len(maps)):
        acc = tt.compose(m, acc, maps[k])
        assert seen(scan[k]) == seen(acc)


def test_query(spark, both, monkeypatch):
    _, tok = both
    rows = AWKWARD + [(60, "x" * 70_000), (61, " " * 5000), (62, "word " * 20_000)]
    got = tt.token_counts(documents(spark, rows), PATH).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        want[i] = (len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 1024)
    for r in got:
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == want[r["doc_id"]]
    assert tt.token_counts(documents(spark, rows).limit(0), PATH).count() == 0
    # a full memory is compiled anew
    monkeypatch.setattr(tt, "MAX_STATES", 50)
    m = tt.Transducer(PATH)
    for k in range(20):
        t = text(k, 30)
        assert m.count(t) == len(tok.encode(t, add_special_tokens=False).ids)
