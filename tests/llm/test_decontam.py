import itertools
import random

import numpy as np
from cases import AWKWARD, documents, text

import corpus_pipeline
from tidemark.llm import decontam as dc
from tidemark.llm.queries import op7_spaced_seed_decontamination


def brute(docs, items):
    """All diagonals of all pairs that share a seed."""
    out = set()
    cache = dc.WordHashes()
    h = lambda t: [cache[w] for w in dc.lower_words(t)]
    for i, t in docs:
        a = h(t)
        for j, u in items:
            b = h(u)
            for d in range(-len(b) + 1, len(a)):
                hit = any(
                    0 <= p + d and p + dc.SPAN <= len(b) and p + d + dc.SPAN <= len(a) and all(b[p + o] == a[p + d + o] for o in m)
                    for m in dc.MASKS for p in range(max(0, -d), len(b)))
                if hit:
                    lo, hi = max(d, 0), min(d + len(b), len(a))
                    import numpy as np

                    s, n, good = dc.best_overlap(np.array([a[k] == b[k - d] for k in range(lo, hi)]))
                    if n >= dc.LEAST:
                        out.add((i, j, lo + s, lo + s - d, n, good))
    return out


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(1)
    items = [(k, text(900 + k, rng.randint(12, 40))) for k in range(8)] + [(20, "too short"), (21, None), (22, text(900, 14))]
    docs = []
    for k in range(40):
        w = text(k, rng.randint(5, 80)).split()
        own = rng.choice([t for _, t in items if t]).split()
        for p in range(len(own)):
            if rng.random() < rng.choice([0, 0.05, 0.15]):
                own[p] = "zz"
        cut = own[rng.randint(0, 4) :] if rng.random() < 0.6 else []
        at = rng.randint(0, len(w))
        docs.append((k + 100, " ".join(w[:at] + [x.upper() + "," for x in cut] + w[at:])))
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, lang string")
    got = [tuple(r) for r in dc.overlaps(documents(spark, docs + AWKWARD), b).collect()]
    want = brute(docs, [x for x in items if x[1]])
    assert set(got) == want and len(want) > 15 and len(got) == len(want)
    assert any(r[4] != r[5] for r in got)  # one with substitutions
    kept = dc.drop_contaminated(documents(spark, docs + AWKWARD), b)
    hit = {r[0] for r in got}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, _ in docs + AWKWARD if i not in hit)


def test_blocks_repeats_and_empty_tables(spark, monkeypatch):
    item = text(5, 30)
    b = spark.createDataFrame([(1, item), (2, item), (3, text(6, 30))], "item_id long, text string")
    docs = documents(spark, [(7, "x y " + item), (7, "x y " + item), (8, text(6, 30)), (9, text(9, 40))])
    whole = sorted(map(tuple, dc.overlaps(docs, b).collect()))
    assert [r[:2] for r in whole] == [(7, 1), (7, 1), (7, 2), (7, 2), (8, 3)]
    monkeypatch.setattr(dc, "BLOCK_WORDS", 40)
    assert sorted(map(tuple, dc.overlaps(docs, b).collect())) == whole
    assert dc.overlaps(docs.limit(0), b).count() == 0 and dc.overlaps(docs, b.limit(0)).count() == 0
    assert dc.drop_contaminated(docs, b.limit(0)).count() == 4


def test_masks_have_one_weight():
    assert all(len(m) == 8 and m[0] == 0 and m[-1] == dc.SPAN - 1 for m in dc.MASKS)


def seeded(same):
    return any(all(same[p + o] for o in m) for m in dc.MASKS for p in range(len(same) - dc.SPAN + 1))


def test_short_items_with_substitutions(spark, tmp_path):
    item = text(31, 15).split()
    places = [(p,) for p in range(15)] + list(itertools.combinations(range(15), 2))
    docs, want = [], set()
    for k, ps in enumerate(places):
        docs.append((k, " ".join(text(5000 + k, 30).split() + ["zz" if p in ps else w for p, w in enumerate(item)] + text(7000 + k, 30).split())))
        if seeded([p not in ps for p in range(15)]):
            want.add(k)
    d = documents(spark, docs)
    b = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = dc.overlaps(d, b, dc.SHARE).collect()
    assert {r["doc_id"] for r in got} == want and len(want) > 100 and set(range(15)) <= want
    lost = [k for k in want if dc.best_overlap(np.array([p not in places[k] for p in range(15)]))[1] < dc.LEAST]
    assert len(lost) > 40  # those that only the share of equal words finds
    for r in got:
        if r["doc_id"] in lost:
            assert (r["doc_start"], r["item_start"], r["n_words"], r["n_equal"]) == (30, 0, 15, 15 - len(places[r["doc_id"]]))
    assert {r["doc_id"] for r in dc.drop_contaminated(d, b, share=dc.SHARE).collect()} == set(range(len(places))) - want
    # as the query and the pipeline's stage ask it
    d.write.parquet(f"{tmp_path}/documents.parquet")
    b.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r["doc_id"] for r in op7_spaced_seed_decontamination(spark, str(tmp_path)).collect()} == want
    assert {r["doc_id"] for r in corpus_pipeline.decontaminate(spark, d, str(tmp_path)).collect()} == set(range(len(places))) - want
    # fewer than 80 % of the words, and an item that the document's end cuts
    few = documents(spark, [(1, " ".join(["zz"] * 4 + item[4:])), (2, " ".join(item[:12])), (3, " ".join(item[:11]))])
    assert {r["doc_id"] for r in dc.overlaps(few, b, dc.SHARE).collect()} == {2}


def test_every_run_of_a_diagonal(spark):
    item = text(32, 60).split()
    doc = item[:20] + ["zz"] * 20 + item[40:]
    b = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = sorted(tuple(r) for r in dc.overlaps(documents(spark, [(9, " ".join(doc))]), b).collect())
    assert got == [(9, 1, 0, 0, 20, 20), (9, 1, 40, 40, 20, 20)]
    # the best run is of 11 words, a lesser one of 13 with a substitution
    same = np.array([True] * 11 + [False] * 6 + [True] * 6 + [False] + [True] * 6)
    assert dc.best_overlap(same)[1] < dc.LEAST and dc.all_overlaps(same) == [(17, 13, 12)]


def test_contaminated_rows_without_id_are_dropped(spark):
    item = text(33, 40)
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents(spark, [(None, "a b " + item), (None, text(34, 40)), (5, item), (5, text(35, 40))])
    assert sorted(str(r["doc_id"]) for r in dc.drop_contaminated(docs, b).collect()) == ["5", "None"]
