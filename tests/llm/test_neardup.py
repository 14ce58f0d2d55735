import os
import random

import numpy as np
import pytest
from cases import AWKWARD, documents, edited, text

from tidemark.llm import neardup
from tidemark.llm.components import components


def sets(t):
    w = neardup.lower_words(t)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def brute(rows):
    s = {i: sets(t) for i, t in rows if i is not None}
    up = {i: i for i in s}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(s)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 85 * len(s[a] | s[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(s[i]), root(i), root(i) == i) for i in s}


def corpus():
    rng = random.Random(3)
    rows, n = list(AWKWARD), 1000
    shared = text(99, 60)
    for g in range(12):
        base = text(g, rng.randint(40, 200))
        for c in range(rng.randint(1, 9)):
            rows.append((n, edited(base, rng.choice([0, 0.004, 0.01, 0.02, 0.03]), n)))
            n += 1
    for k in range(40):  # many documents share a passage and are not alike
        rows.append((n + k, shared + " " + text(500 + k, rng.randint(20, 90))))
    base = text(77, 120)
    for k in range(60):  # one large group of near copies
        rows.append((2000 + k, edited(base, 0.012, k)))
    rows += [(3000, "Short One"), (3001, "short one"), (3002, "short\tONE "), (3003, "ÜBER x"), (3004, "über x")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [16, 2])
def test_components_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL", small)
    rows = corpus()
    got = neardup.near_duplicates(documents(spark, rows).repartition(5)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == want[r["doc_id"]], r["doc_id"]


def test_drop_keeps_one_of_each(spark):
    docs = documents(spark, [(3, "a b c d e f"), (1, "A b c d e f"), (2, "other words are in this one"), (None, "a b c d e f"), (4, ""), (5, None)])
    out = neardup.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "2", "4", "5", "None"]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_components_both_ways(spark):
    rng = random.Random(5)
    links = [(a, a + 1) for a in range(0, 60)] + [(200, k) for k in range(201, 260)] + [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(80)] + [(7, 7), (1, 0), (None, 3)]
    d = spark.createDataFrame(links, "a long, b long")
    one, many = (sorted(map(tuple, components(d, local_links=n).collect())) for n in (10**6, 0))
    assert one == many and dict(one)[60] == 0 and dict(one)[259] == 200
    assert components(d.limit(0)).count() == 0


def test_minhash_cost_is_the_root(spark):
    s = neardup.shingles(text(1, 300), neardup.WordHashes())
    assert neardup.N_MIN == 32 and neardup.PAIRS**2 * 4 == 256
    m = neardup.minhashes(s, neardup.N_MIN)
    assert len(set(m.tolist())) == neardup.N_MIN


def similar(rows, threshold):
    """First of the component of every id, by exact sets."""
    s = {i: sets(t) for i, t in rows}
    first = {i: i for i in s}
    for a in s:
        for b in s:
            if a < b and 100 * len(s[a] & s[b]) >= threshold * len(s[a] | s[b]):
                lo, hi = sorted((first[a], first[b]))
                first = {i: lo if f == hi else f for i, f in first.items()}
    return first


def banded():
    """Pairs whose similarity lies from 0.70 to 0.95, most of them alone."""
    rows = []
    for k in range(60):
        w = text(4000 + k, 100).split()
        cut = 5 + k % 24  # words of the end that differ: i = 96 - cut of 96 + cut
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(w[:-cut] + text(9000 + k, cut).split()))]
    return rows


@pytest.mark.parametrize("threshold", [85, 80, 75])
def test_threshold_is_a_parameter(spark, threshold):
    rows = banded()
    want = similar(rows, threshold)
    if threshold < 85:
        assert len(set(want.values())) < len(set(similar(rows, threshold + 5).values()))
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(documents(spark, rows), threshold).collect()}
    assert got == want
    kept = {r["doc_id"] for r in neardup.drop_near_duplicates(documents(spark, rows), threshold).collect()}
    assert kept == set(want.values())


def test_tables_and_signature_follow_the_threshold():
    assert [neardup.sub_keys(t) for t in (85, 80)] == [8, 10] and [neardup.sig_least(t) for t in (85, 80)] == [90, 81]


def test_large_group_of_several_components(spark, monkeypatch):
    """2,000 near copies, most alike and some alone or in small groups."""
    monkeypatch.setattr(neardup, "BLOCK", 100)
    base = text(5, 60)
    rng = random.Random(8)
    rows = [(k, edited(base, rng.choice([0.012, 0.012, 0.03]), k)) for k in range(600)]
    rows += [(600 + k, edited(rows[k % 600][1], 0.004, 5000 + k)) for k in range(1400)]
    want = brute(rows)
    assert len({c for _, c, _ in want.values()}) > 20
    for r in neardup.near_duplicates(documents(spark, rows).repartition(5)).collect():
        assert (r["n_shingles"], r["component_id"], r["kept"]) == want[r["doc_id"]], r["doc_id"]


def test_texts_of_one_id_join_their_groups(spark):
    x, y, z = text(1, 40), text(2, 40), text(3, 40)
    rows = [(5, x), (3, x), (5, y), (9, edited(y, 0.01, 4)), (7, z), (7, y), (8, z)]
    got = {(r["doc_id"], r["component_id"]) for r in neardup.near_duplicates(documents(spark, rows)).collect()}
    assert got == {(5, 3), (3, 3), (9, 3), (7, 3), (8, 3)}


@pytest.mark.parametrize("columns, shingles", [(4096, 500_000), (7, 2_000)])
def test_large_group_passes_on_few_pairs(spark, monkeypatch, columns, shingles):
    """Most of a large group's pairs pass the signature test; what its leaders
    find is fewer rows than it has members, not a share of its pairs."""
    monkeypatch.setattr(neardup, "COLUMNS", columns)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", shingles)
    rows = []
    base = text(5, 100)
    for k in range(500):  # one or two words are others: a similarity of 0.65 to 0.81 where no place is shared
        rng, w = random.Random(k), base.split()
        for place in rng.sample(range(6, 96, 10), 2 if k % 5 else 1):
            w[place] = f"other{k}"
        rows.append((k, " ".join(w)))
    made, saved = [], neardup.saved
    monkeypatch.setattr(neardup, "saved", lambda d, tag, *a: made.append((tag, saved(d, tag, *a))) or made[-1][1])
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(documents(spark, rows).repartition(5)).collect()}
    assert got == {i: c for i, (_, c, _) in brute(rows).items()}
    assert len(set(got.values())) > 100
    for tag, d in made:
        if tag in ("near", "tested", "links") and os.path.isdir(d._saved_at):
            assert d.count() <= 4 * len(rows), tag


def test_common_equals_sets():
    rng = random.Random(4)
    a, b = ([np.array(sorted(rng.sample(range(60), rng.randint(0, 30))), np.int64) for _ in range(n)] for n in (9, 7))
    want = [[len(set(x.tolist()) & set(y.tolist())) for y in b] for x in a]
    assert neardup.common(a, b).tolist() == want and neardup.common(a[:1], [b[0][:0]]).tolist() == [[0]]
