import math
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import AWKWARD, documents, text

from tidemark.llm import pitmanyor as py


@pytest.fixture(scope="module")
def rows():
    return [(1000 + k, text(k, 20 + k % 50)) for k in range(400)] + [(1500 + k, text(k, 30)) for k in range(60)] + AWKWARD


@pytest.mark.parametrize("frequent", [10**6, 50, 0])
def test_base_equals_brute_force(spark, rows, monkeypatch, frequent):
    monkeypatch.setattr(py, "FREQUENT", frequent)
    got = py.scores(documents(spark, rows).repartition(3)).collect()
    assert len(got) == len(rows)
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    trains = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 != 0
    c = Counter(w for i, t in rows if trains(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = {}
    for i, t in rows:
        w = tokens(t)
        want[i] = (len(w), sum(x in c for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
    for r in got:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:3]
        assert abs(r["base_score"] - want[r["doc_id"]][3]) < 1e-6
        assert r["held_out"] == (None if r["doc_id"] is None else not trains(r["doc_id"]))
        assert -math.inf < r["score"] < 0


def test_without_training_rows_and_empty(spark):
    held = [k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0][:3]
    got = py.scores(documents(spark, [(k, "some words") for k in held])).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in got] == [(0, 0, None)] * 3 and all(r["score"] < 0 for r in got)
    assert py.scores(documents(spark, AWKWARD).limit(0)).count() == 0


def seated(c, a, d, rng):
    t = np.minimum(c, 1)
    for k in range(1, int(c.max())):
        on = c > k
        t = t + (on & (rng.random(len(c)) < a / (a + k - d * t)))
    return t


def seeds(n, salt=0):
    return py.mixed(np.arange(n, dtype=np.uint64) + np.uint64(salt << 40))


def test_draws_are_binomial():
    for k, p in ((1, 0.3), (5, 0.01), (30, 0.9), (400, 0.2), (100_000, 1e-5)):
        n = 20_000
        x = py.drawn(np.full(n, k), np.full(n, p), py.uniform(seeds(n), 0), py.uniform(seeds(n), 1))
        sd = (k * p * (1 - p)) ** 0.5
        assert x.min() >= 0 and x.max() <= k and abs(x.mean() - k * p) < 4 * sd / n**0.5 and abs(x.std() - sd) < 0.04 * sd


def test_seating_has_the_right_mean():
    rng = np.random.default_rng(0)
    c = np.full(4000, 40)
    for a, d in ((0.5, 0.5), (3.0, 0.8)):
        one, many = seated(c, np.full(4000, a), d, rng).mean(), py.seat(c, np.full(4000, a), d, seeds(4000)).mean()
        assert abs(one - many) < 0.06 * one + 0.05
    t = py.seat(np.array([0, 1, 2, 10**6]), np.full(4, 0.1), 0.5, seeds(4))
    assert t[0] == 0 and t[1] == 1 and 1 <= t[2] <= 2 and t[3] <= 10**6


def test_letters_are_a_distribution():
    words = [w.encode() for w in text(1, 300).split()]
    key, owner, first = py.events(pa.array(words, pa.binary()))
    assert len(key) == sum(map(len, words)) + len(words) and len(first) == len(words)
    keys, n = np.unique(key, return_counts=True)
    letters, tables = py.sweep_letters(keys, n, py.Letters(), {}, 0)
    letters, tables = py.sweep_letters(keys, n, letters, tables, 1)
    for ctx in [*(keys[:40] >> np.uint32(8)), np.uint32(12345)]:
        p = letters.prob((np.uint32(ctx) << np.uint32(8)) | np.arange(256, dtype=np.uint32))
        assert abs(p.sum() - 1) < 1e-3 and (p > 0).all()
    assert owner[-1] == len(words) - 1
    of = lambda w: letters.log_words(*[py.events(pa.array([w], pa.binary()))[k] for k in (0, 2)])
    assert of(words[0])[0] / len(words[0]) > of(b"qqzzxxqq")[0] / 8


def tokens(t):
    return [*(t or "").encode().lower().split(), b""]


def trains(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 != 0


def brute(rows):
    """The sampler in plain dictionaries, one restaurant after the other."""
    pairs, vocabulary = Counter(), {w for _, t in rows for w in tokens(t)}
    for i, t in rows:
        if trains(i):
            pairs.update(zip([b"", *tokens(t)[:-1]], tokens(t)))
    customers = Counter()
    for (u, _), c in pairs.items():
        customers[u] += c
    h = {w: np.array([xxhash.xxh3_64_intdigest(w) >> 1], np.uint64) for w in vocabulary}
    ones = lambda x, n: sum(c == n for c in x)
    tables = dict.fromkeys(pairs, 1)
    by = lambda k: Counter({w: sum(t for p, t in tables.items() if p[k] == w) for w in {p[k] for p in tables}})
    d, d_word = py.discount(ones(pairs.values(), 1), ones(pairs.values(), 2)), py.discount(ones(by(1).values(), 1), ones(by(1).values(), 2))
    letters, levels, total, samples = py.Letters(), {}, 0.0, []
    for n in range(py.BURN_IN + py.SAMPLES):
        contexts, served, events, stay, spelt, now = by(0), by(1), Counter(), {}, {}, 0
        for w in vocabulary:
            key, _, first = py.events(pa.array([w], pa.binary()))
            spelt[w] = letters.log_words(key, first)[0]
            c = np.array([served[w]])
            t = int(py.seat(c, (py.THETA_WORD + d_word * total) * np.exp([spelt[w]]), d_word, py.mixed(h[w] + np.uint64(n)))[0])
            stay[w], now = max(c[0] - d_word * t, 0), now + t
            for k in key.tolist():
                events[k] += t
        total = float(now)
        size, weight = py.THETA_WORD + sum(stay.values()) + d_word * total, py.THETA_WORD + d_word * total
        p = {w: np.logaddexp(np.log(stay[w]) if stay[w] else -np.inf, np.log(weight) + spelt[w]) - np.log(size) for w in vocabulary}
        got = sorted((k, c) for k, c in events.items() if c)
        letters, levels = py.sweep_letters(np.array([k for k, _ in got], np.uint32), np.array([c for _, c in got]), letters, levels, n)
        for (u, w), c in pairs.items():
            if c > 1:
                a = (py.THETA_CONTEXT + d * contexts[u]) * np.exp([np.float32(p[w])], dtype=float)
                tables[u, w] = int(py.seat(np.array([c]), a, d, py.mixed(py.mixed(h[u] + np.uint64(n)) ^ h[w]))[0])
        if n >= py.BURN_IN:
            samples.append((dict(tables), by(0), p))
    out = {}
    for i, t in rows:
        s = 0.0
        for u, w in zip([b"", *tokens(t)[:-1]], tokens(t)):
            each = [(max(pairs[u, w] - d * t.get((u, w), 0), 0) + (py.THETA_CONTEXT + d * tu[u]) * math.exp(p[w])) / (py.THETA_CONTEXT + customers[u]) for t, tu, p in samples]
            s += math.log10(sum(each) / len(each))
        out[i] = s
    return out


def corpus():
    rng = np.random.default_rng(3)
    follow = {w: rng.permutation(40)[:6] for w in range(40)}

    def walk(seed):
        r, w = np.random.default_rng(seed), 0
        for _ in range(80):
            w = int(r.choice(follow[w])) if r.random() < 0.8 else int(r.integers(40))
            yield f"w{w}"

    return [(k, " ".join(walk(k))) for k in range(100)] + [(900 + k, text(k, 20)) for k in range(20)]


def scored(docs):
    return {r["doc_id"]: r["score"] for r in py.scores(docs).collect()}


def test_scores_equal_brute_force(spark, monkeypatch):
    """With all words in the book, some of them and none, in small blocks."""
    rows = corpus()
    want = brute(rows)
    monkeypatch.setattr(py, "BLOCK_TOKENS", 700)
    for most in (10**6, 45, 0):
        monkeypatch.setattr(py, "FREQUENT", most)
        got = scored(documents(spark, rows).repartition(3))
        for i, t in rows:  # a token's log probability is rounded to 1 / STEPS
            assert abs(got[i] - want[i]) < (0.51 / py.STEPS + 1e-6) * len(tokens(t)), (most, i, got[i], want[i])


def test_held_out_texts_and_layout_change_nothing(spark):
    rows = corpus()
    other = [(i, t if trains(i) else text(i, 70) + " w1 w2 w3") for i, t in rows]
    one, two = scored(documents(spark, rows).repartition(1)), scored(documents(spark, other).repartition(5))
    for i, t in rows:
        if trains(i):
            assert abs(one[i] - two[i]) < 1e-4 * abs(one[i])


def test_frequent_contexts_have_restaurants(spark):
    cycle = ["tick", "tock", "ding", "dong"]
    rows = [(k, " ".join((cycle * 20)[k % 4 : 60 + k % 4])) for k in range(200)]
    got = py.scores(documents(spark, rows).repartition(3)).collect()
    # without a context every fourth word has a quarter, -0.6
    assert all(r["score"] / r["n_tokens"] > -0.2 for r in got)


def test_better_than_the_base_on_held_out_texts(spark):
    got = py.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > 0.9 * got["sum(base_score)"]


def test_little_lies_on_disk_at_once(spark, rows, monkeypatch):
    """Buckets answer in turns that share no bucket, and parts of the buckets' news
    go as soon as they are read."""
    made, seen, saved = {}, {}, py.saved

    def watched(d, tag, *a, **k):
        back = saved(d, tag, *a, **k)
        if "told" in made:
            seen.setdefault(tag, {f for f in os.listdir(made["told"][0]._saved_at) if f.startswith("kind=")} if os.path.isdir(made["told"][0]._saved_at) else set())
        made.setdefault(tag, []).append(back)
        if tag == "answers":
            keys.append({r["key"] for r in back.select("key").distinct().collect()})
        return back

    keys = []
    monkeypatch.setattr(py, "saved", watched)
    assert py.scores(documents(spark, rows).repartition(3)).count() == len(rows)
    assert len(keys) == 2 and keys[0] and keys[1] and not keys[0] & keys[1]
    assert f"kind={py.MULTI}" in seen["wanted"] and not {f"kind={py.MULTI}", f"kind={py.WANTED}"} & seen["words"]
