import random
import re

import numpy as np
from cases import AWKWARD, documents, text

from tidemark.llm import quality


def brute(t):
    w = re.findall("[^\x20\x09-\x0d]+", t or "")
    grams = {}
    for k in range(len(w) - 4):
        grams.setdefault(tuple(w[k : k + 5]), []).append(k)
    inside = {p + j for at in grams.values() if len(at) > 1 for p in at for j in range(5)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t or "")), dup, len(inside)


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(100 + k, "".join(rng.choice(["a ", "b ", "c", " ", "\n", "#", "ü ", "d e f g h ", "\x0b", "&|"]) for _ in range(rng.randint(0, 120)))) for k in range(150)]
    rows += AWKWARD + [(300, "a\na\n a\na"), (301, "x " * 3000)]
    got = quality.judge(documents(spark, rows), quality.DecisionList([])).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        want.setdefault(i, brute(t))
    for r in got:
        c = want[r["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == c, r["doc_id"]
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        assert (r["base_failed"], r["kept"]) == (failed, not failed)


def test_sequential_covering_finds_the_rules():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    bad = (x["a"] > 0.8) & (x["b"] < 0.5) | (x["c"] > 0.95)
    rules = quality.cover(x, bad)
    hit = np.zeros(3000, bool)
    for r in rules.rules:
        hit |= quality._covers(r, x, 3000)
    assert (hit & bad).sum() > 0.95 * bad.sum() and (hit & ~bad).sum() <= 0.02 * bad.sum()
    assert quality.cover(x, np.zeros(3000, bool)).rules == []
    # labels without a pattern give no rule
    assert quality.cover({"a": rng.random(500)}, rng.random(500) < 0.5).rules == []


def test_learned_filter(spark):
    rows = [(k, text(k, 60) if k % 3 else " ".join(w + "%%%" for w in text(k, 60).split())) for k in range(180)]
    docs = documents(spark, rows + AWKWARD)
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0, "x") for k in range(120)] + [(None, 1, 0, "x"), (5, None, None, "x")], "doc_id long, quality int, toxic int, text string")
    rules = quality.fit(docs, labels)
    assert len(rules.describe()) == 1
    kept = quality.filter_documents(docs, rules)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k in range(180) if k % 3}
    assert quality.fit(docs, labels.limit(0)).rules == []
    assert quality.judge(docs.limit(0), rules).count() == 0


def test_no_python_in_the_plan(spark):
    plan = quality.judge(documents(spark, AWKWARD), quality.DecisionList([]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
